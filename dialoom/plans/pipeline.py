"""The layers one after another: decompose and map, draft and polish, validate and repair, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import dedup, dialogue, export, gates, lookup, mapping_checks, metrics, models, normalize, personas, retry, rules
from dialoom.plans.schemas import mirror, row_id, with_defaults
from dialoom.sources import jsonl
from dialoom.sources.scratch import checkpointed, scratch_path, scratch_scope

Model = Callable[[DataFrame], DataFrame]


@dataclass
class Models:
    """All pluggable calls; the defaults are the deterministic stand-ins."""

    decompose: Model | None = None
    generate: Model = models.echo_generator
    refine: Model | None = None
    resolve: Callable[[DataFrame], DataFrame] | None = None
    embed: Callable[[Column], Column] = models.embed
    safe: Callable[[Column], Column] = models.always_safe
    clean: Callable[[Column], Column] = gates.pii_pass
    judge: Model = field(default_factory=lambda: models.fixed_judge())


# ---- first layer


def decompose_and_map(raw: DataFrame, calls: Models, entries: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Raw rows to rows of the first layer. `calls.decompose` adds `payload` (normalize.PAYLOAD) and `failure`; rows whose call failed, and
    all rows where there is none, get the defaults."""
    if calls.decompose is None:
        got = raw.withColumn("payload", F.from_json(F.lit("{}"), normalize.PAYLOAD))
    else:
        got = checkpointed(calls.decompose(raw))
    rows = normalize.decompose(got, F.col("payload"))
    rows = lookup.map_refs(rows, entries, index, calls.embed if index is not None else None, calls.resolve)
    return with_defaults(rows.withColumn("mapped_refs", mapping_checks.validate(F.col("mapped_refs"))), "stage1")


def run_first(spark: SparkSession, source: str, out: str, calls: Models, entries: DataFrame, index: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """Rows that the output does not have yet are added to it; with overwrite all rows replace it."""
    raw = jsonl.read_strict(spark, source, "raw")
    raw = raw.withColumn("id", row_id(F.col("id"), F.col("original_index")))
    if not overwrite:
        raw = dialogue.unfinished(raw, jsonl.ids(spark, out))
    rows = checkpointed(decompose_and_map(raw, calls, entries, index))
    jsonl.write_rows(rows, out, "overwrite" if overwrite else "append")
    return rows


# ---- second layer


def draft_and_polish(rows: DataFrame, calls: Models, bank: DataFrame | None = None, mode: dialogue.Mode = dialogue.Mode(), seed: int = 0) -> DataFrame:
    """Rows of the first layer to rows of the second with `status` and `error`."""
    if mode.persona and bank is not None:
        chosen = personas.select_personas(rows, bank, seed).withColumnRenamed("id", "_pid")
        rows = rows.join(chosen, F.col("id") == F.col("_pid"), "left").drop("_pid")
    rows = with_defaults(rows, "stage2")
    drafted = checkpointed(dialogue.draft(rows, calls.generate, mode))
    saved = drafted.where("status = 'saved'").drop("status", "error")
    polished = checkpointed(dialogue.polish(saved, calls.refine, mode))
    names = [*with_defaults(polished, "stage2").columns]
    done = with_defaults(polished, "stage2", ["status", "error"])
    rest = with_defaults(drafted.where("status <> 'saved'"), "stage2", ["status", "error"])
    return mirror(done.unionByName(rest)).select("status", "error", *names)


def run_second(spark: SparkSession, source: str, out: str, calls: Models, bank: DataFrame | None = None, mode: dialogue.Mode = dialogue.Mode(), num_records: int | None = None, seed: int = 0) -> dict[str, int]:
    """Resumes: identifiers in the output and its queues are passed over; saved rows go to the output, others to their queues."""
    rows, _ = jsonl.read_rows(spark, source, "stage1")
    if num_records is not None:
        rows = rows.orderBy("_lineno").limit(num_records)
    queues = {"saved": out, "retry_error": dialogue.queue_path(out, "retry-errors"), "invalid": dialogue.queue_path(out, "invalid")}
    rows = dialogue.unfinished(rows.drop("_lineno"), *[jsonl.ids(spark, p) for p in queues.values()])
    parts = dialogue.route(checkpointed(draft_and_polish(rows, calls, bank, mode, seed)))
    counts = {}
    for status, part in parts.items():
        counts[status] = part.count()
        if counts[status]:
            jsonl.write_rows(part.drop("status") if status != "saved" else part.drop("status", "error"), queues[status], "append")
    return counts


def retry_source(spark: SparkSession, out: str) -> str:
    """The queue to run again: failed calls first, then invalid rows."""
    for kind in ("retry-errors", "invalid"):
        path = dialogue.queue_path(out, kind)
        if jsonl.ids(spark, path).limit(1).count():
            return path
    raise FileNotFoundError(f"no queue of {out} has rows")


def run_retry(spark: SparkSession, out: str, calls: Models, bank: DataFrame | None = None, mode: dialogue.Mode = dialogue.Mode(), seed: int = 0) -> dict[str, int]:
    """One queue of an output again, failed calls before invalid rows: what is saved now goes to the output, what fails again stays in the
    queue or moves to the other one. The queue is replaced last, so that a run that breaks off loses no row."""
    path = retry_source(spark, out)
    rows, _ = jsonl.read_rows(spark, path, "stage1")
    done = dialogue.unfinished(rows.drop("_lineno"), jsonl.ids(spark, out))
    parts = dialogue.route(checkpointed(draft_and_polish(done, calls, bank, mode, seed)))
    queues = {"retry_error": dialogue.queue_path(out, "retry-errors"), "invalid": dialogue.queue_path(out, "invalid")}
    counts = {status: part.count() for status, part in parts.items()}
    if counts["saved"]:
        jsonl.write_rows(parts["saved"].drop("status", "error"), out, "append")
    own = next(status for status, queue in queues.items() if queue == path)
    other = next(status for status in queues if status != own)
    if counts[other]:
        jsonl.write_rows(parts[other].drop("status"), queues[other], "append")
    jsonl.replace_rows(parts[own].drop("status"), path)
    return counts


# ---- third layer


def find_duplicates(df: DataFrame, embed: Callable[[Column], Column], limits: rules.Limits, order: str = "_ord") -> DataFrame:
    """Rows with a reason for each near-duplicate of an earlier row, named after the pivot's id."""
    text = dedup.row_text(F.col("scene.narrative_en"), F.col("source_dialogue"))
    slim = checkpointed(df.select(F.col(order), F.col("id").alias("_pid"), embed(text).alias("v")))
    labels = dedup.semantic_dedup(slim.select(F.col(order), "v"), order, "v", limits.semantic_cosine)
    # written first: where few rows are near others they are sent to the rest, and wide rows stay where they are
    near = checkpointed(labels.where("label <> 'kept'"))
    named = checkpointed(near.join(slim.select(F.col(order).alias("pivot"), "_pid"), "pivot").select(F.col(order).alias("_o"), "label", "_pid"))
    out = df.join(named, F.col(order) == F.col("_o"), "left")
    found = F.when(F.col("label").isNotNull(), rules.reason("stage3.phase1", F.concat(F.col("label"), F.lit("_dup")), F.concat(F.lit("near "), F.col("_pid"))))
    return rules.reject(out, found).drop("_o", "label", "_pid")


def revalidate(df: DataFrame, calls: Models, limits: rules.Limits) -> DataFrame:
    """Rules, guardrails, coherence and judge; each only on what is still valid."""
    done = []
    for gate in (
        lambda x: rules.apply(x, limits=limits), lambda x: gates.guard(x, calls.safe, calls.clean),
        lambda x: gates.coherence(x, calls.embed, limits), lambda x: checkpointed(gates.judge(x, calls.judge, limits)),
    ):
        df = gate(df)
        done.append(df.where(~F.col("valid")))
        df = df.where("valid")
    for part in done:
        df = df.unionByName(part)
    return df


def validate(df: DataFrame, calls: Models, limits: rules.Limits = rules.Limits(), order: str = "_ord") -> DataFrame:
    """First pass over all rows: duplicates, rules, guardrails, coherence; judge on the valid ones; then what to try."""
    rows, spark = with_defaults(df, "stage3", [order]), df.sparkSession
    path = scratch_path(spark, "judged")
    with scratch_scope(spark):  # vectors and labels of duplicates go
        rows = find_duplicates(rows, calls.embed, limits, order)
        rows = gates.coherence(gates.guard(rules.apply(rows, limits=limits), calls.safe, calls.clean), calls.embed, limits)
        judged = checkpointed(gates.judge(rows, calls.judge, limits), path)
    return retry.derive(judged)


def repair_tools(calls: Models, entries: DataFrame, index: DataFrame | None, bank: DataFrame | None = None, mode: dialogue.Mode = dialogue.Mode()) -> dict[str, retry.Repair]:
    """The four ways to mend rows. Each returns the rows with the same columns."""

    def keep(df: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
        fresh = new.select(F.col("id").alias("_nid"), *[F.col(c).alias(f"_n_{c}") for c in columns])
        out = df.join(fresh, F.col("id") == F.col("_nid"), "left")
        return out.withColumns({c: F.coalesce(f"_n_{c}", F.col(c)) for c in columns}).select(*df.columns)

    def redo_refs(df: DataFrame) -> DataFrame:
        new = lookup.map_refs(df, entries, index, calls.embed if index is not None else None, calls.resolve)
        return keep(df, new.withColumn("mapped_refs", mapping_checks.validate(F.col("mapped_refs"))), ["mapped_refs"])

    def from_web(df: DataFrame) -> DataFrame:
        """Past the dictionary, and generic terms too."""
        if calls.resolve is None:
            return df
        flat = df.select("id", F.posexplode("dialogue_decomposed.cultural_refs").alias("pos", "r"), "source_dialogue")
        flat = flat.select("id", "pos", F.col("r.term").alias("term"), F.col("r.type").alias("type"), lookup.context(F.col("r.term"), F.col("source_dialogue")).alias("context"))
        mapped = lookup.map_terms(flat, entries.limit(0), resolve=calls.resolve)
        lists = mapped.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "mapped"))), lambda x: x["mapped"]).alias("mapped_refs"))
        return keep(df, lists, ["mapped_refs"])

    def rewrite(df: DataFrame) -> DataFrame:
        new = draft_and_polish(with_defaults(df, "stage1"), calls, bank, mode).where("status = 'saved'")
        return keep(df, new, ["final_dialogue", "korean_dialogue", "step3_korean_dialogue", "translation_meta"])

    def again(df: DataFrame) -> DataFrame:
        raw = df.select("id", "original_index", F.transform("source_dialogue", lambda t: t["text"]).alias("dialogue"), F.transform("source_dialogue", lambda t: t["speaker"]).alias("speakers"), F.col("scene.narrative_en").alias("narrative"))
        got = calls.decompose(raw) if calls.decompose else raw.withColumn("payload", F.from_json(F.lit("{}"), normalize.PAYLOAD))
        return keep(df, normalize.decompose(got, F.col("payload")), ["source_dialogue", "speakers", "scene", "dialogue_decomposed"])

    return {"maps_ref_redo": redo_refs, "websearch_cultural": from_web, "stage2_rewrite": rewrite, "stage1_redecompose": again}


def run_third(spark: SparkSession, source: str, out: str, calls: Models, limits: rules.Limits = rules.Limits(), tools: dict[str, retry.Repair] | None = None) -> dict[str, int]:
    """Reads rows of the second layer and writes accepted, rejected, retry_queue (as it was before repairs), repaired, reject_details,
    parse_errors and dataset_metrics. Returns six counts, observed while the rows are written."""
    rows, errors = jsonl.read_rows(spark, source, "stage2")
    first = checkpointed(validate(mirror(rows), calls, limits, "_lineno").drop("_lineno"))
    queued = checkpointed(retry.queue(first))
    mended = retry.repair(queued, tools or {}, lambda x: revalidate(x, calls, limits), limits) if tools else queued.limit(0)
    mended = checkpointed(mended)
    whole = checkpointed(first.join(mended.select("id"), "id", "left_anti").select(*first.columns).unionByName(mended))
    accepted, rejected = whole.where("valid"), whole.where(~F.col("valid"))
    counts: dict[str, int] = {}
    for name, part in (("accepted", accepted), ("rejected", rejected), ("retry_queue", queued), ("repaired", mended), ("reject_details", export.reject_diary(whole)), ("parse_errors", errors)):
        seen = Observation()
        valid = F.count_if("valid") if "valid" in part.columns else F.count_if(F.lit(False))
        jsonl.write_rows(part.observe(seen, F.count(F.lit(1)).alias("n"), valid.alias("valid")), f"{out}/{name}")
        counts |= {name: seen.get["n"], f"{name}_valid": seen.get["valid"]}
    metrics.write_report(metrics.compute(accepted, rejected), f"{out}/dataset_metrics")
    return {k: int(counts[k] or 0) for k in export.COUNTS}


# ---- fourth layer


def run_fourth(spark: SparkSession, accepted: str, out: str) -> int:
    rows, _ = jsonl.read_rows(spark, accepted, "stage3")
    sft = checkpointed(export.sft(rows.drop("_lineno")))
    jsonl.write_rows(sft, f"{out}/sft")
    return sft.count()


