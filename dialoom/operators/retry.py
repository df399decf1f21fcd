"""What to try next with a rejected row, and the bounded loop that tries it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.operators.rules import Limits
from dialoom.plans.schemas import ACTION, REASON, RETRY_ACTIONS, any_true
from dialoom.sources.scratch import checkpointed, remove, scratch_path, scratch_scope

MAPPING_RULES = ("cultural_ref_coverage", "mapped_ref_terms_in_source", "mapped_ref_ko_hangul", "mapped_ref_type_consistency")
REWRITE_RULES = ("turn_index_order", "ascii_ratio", "speaker_ref_integrity", "mapped_ref_surface")
REWRITE_AXES = ("register_consistency", "persona_style_consistency", "naturalness", "property_preservation")

Repair = Callable[[DataFrame], DataFrame]


def has(stage: str, *rules: str) -> Column:
    return F.exists("reject_reasons", lambda r: (r["stage"] == f"stage3.{stage}") & r["rule"].isin(*rules))


def low(axis: str) -> Column:
    """Below 3; a missing score counts as 5, and so does 0."""
    q = F.col(f"quality.{axis}")
    return F.when(q.isNull() | (q == 0), False).otherwise(q < 3)


def _act(action: str, summary: str, hints: Column | None = None) -> Column:
    none = F.create_map().cast("map<string,string>")
    return F.struct(F.lit(action).alias("action"), F.lit(summary).alias("reason_summary"), (hints if hints is not None else none).alias("hints")).cast(ACTION)


def actions() -> Column:
    """array<ACTION> of a row. Nothing for rows without reasons; `none` for unsafe rows and duplicates; else mapping, structure and
    rewriting in this order; the aggregate only where nothing else is wrong."""
    mapping = has("phase2", *MAPPING_RULES) | has("phase4", "en_ko_mapping_cosine") | low("cultural_appropriateness")
    parity = has("phase2", "turn_count_parity")
    rewrite = has("phase2", *REWRITE_RULES) | has("phase4", "intra_kr_coherence") | any_true([low(a) for a in REWRITE_AXES])
    floor = has("phase5", "aggregate_floor") & ~mapping & ~parity & ~rewrite
    hint = lambda k, v: F.create_map(F.lit(k), v).cast("map<string,string>")
    listed = F.filter(F.array(
        F.when(mapping, _act("maps_ref_redo", "references failed a gate", hint("axis", F.lit("cultural_appropriateness")))),
        F.when(mapping, _act("websearch_cultural", "resolve references anew from the web")),
        F.when(parity, _act("stage1_redecompose", "numbers of turns differ", hint("rule", F.lit("turn_count_parity")))),
        F.when(rewrite, _act("stage2_rewrite", "order, script, register, style or naturalness below the floor", hint("axis", F.lit("register_consistency")))),
        F.when(floor, _act("stage2_rewrite", "aggregate below the floor", hint("aggregate", F.col("quality.aggregate").cast("string")))),
    ), lambda a: a.isNotNull())
    none = lambda why: F.array(_act("none", why))
    return (
        F.when(F.size("reject_reasons") <= 0, F.array().cast(f"array<{ACTION}>"))
        .when(has("phase3", "safety"), none("not safe: dropped"))
        .when(has("phase1", "near_dup", "semantic_dup"), none("duplicate: dropped"))
        .otherwise(F.when(F.size(listed) > 0, listed).otherwise(none("no signal to act on")))
    )


def derive(df: DataFrame) -> DataFrame:
    return df.withColumn("retry_actions", actions())


def queue(df: DataFrame) -> DataFrame:
    """Invalid rows with something to try."""
    return df.where(~F.col("valid") & F.exists("retry_actions", lambda a: a["action"] != "none"))


def cleared(df: DataFrame) -> DataFrame:
    """Rows before a new validation: no reasons, actions or aggregate; scores of axes stay."""
    return df.withColumns({
        "valid": F.lit(True), "reject_reasons": F.array().cast(f"array<{REASON}>"), "retry_actions": F.array().cast(f"array<{ACTION}>"),
        "quality": F.col("quality").withField("aggregate", F.lit(None).cast("double")),
    })


def repair(df: DataFrame, tools: dict[str, Repair], revalidate: Repair, limits: Limits = Limits()) -> DataFrame:
    """Rows of the queue after at most limits.max_iter passes. In a pass each open row takes its first action that is enabled, has a
    tool and was not tried on it before; rows are grouped by that action, mended, validated and given new actions. iter grows by one once.
    """
    usable = [a for a in RETRY_ACTIONS if a in tools and a in limits.actions]
    names = [c for c in df.columns]
    spark = df.sparkSession
    path = scratch_path(spark, "state")
    state = checkpointed(df.withColumns({"_tried": F.array().cast("array<string>"), "_open": F.lit(True)}), path)
    for _ in range(limits.max_iter):
        fresh = F.filter(F.transform("retry_actions", lambda a: a["action"]), lambda a: a.isin(*usable) & ~F.array_contains("_tried", a)) if usable else F.array().cast("array<string>")
        step = state.withColumn("_next", F.when(F.col("_open") & ~F.col("valid"), F.get(fresh, F.lit(0))))
        active = {r["_next"] for r in step.select("_next").distinct().collect()} - {None}  # at most one row an action
        if not active:
            break
        before, path = path, scratch_path(spark, "state")
        with scratch_scope(spark):  # a pass leaves one table, and that of the pass before goes
            parts = [step.where("_next is null").withColumn("_open", F.lit(False)).drop("_next")]
            for action in (a for a in usable if a in active):
                own = step.where(F.col("_next") == action).withColumn("_tried", F.concat("_tried", F.array("_next"))).drop("_next")
                parts.append(derive(revalidate(cleared(tools[action](own)))))
            state = parts[0]
            for p in parts[1:]:
                state = state.unionByName(p.select(*state.columns))
            state = checkpointed(state, path)
        remove(spark, before)
    return state.withColumn("iter", F.col("iter") + 1).select(*names)
