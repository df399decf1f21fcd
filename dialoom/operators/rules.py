"""Ordered rules on rewritten dialogues; the first that fails gives the reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import JOINER, ascii_ratio, has_hangul_block
from dialoom.plans.schemas import REASON, TURN

STAGE = "stage3.phase2"


@dataclass(frozen=True)
class Limits:
    ascii_ratio_max: float = 0.40
    aggregate_floor: float = 3.5
    axis_floor: int = 2
    coherence_floor: float = 0.55
    semantic_cosine: float = 0.92
    max_iter: int = 3
    weights: dict[str, float] = field(default_factory=lambda: {"property_preservation": 0.20, "naturalness": 0.20, "cultural_appropriateness": 0.35, "register_consistency": 0.125, "persona_style_consistency": 0.125})
    actions: tuple[str, ...] = ("stage1_redecompose", "maps_ref_redo", "stage2_rewrite", "websearch_cultural")

    @classmethod
    def from_dict(cls, given: dict) -> Limits:
        """From a nested configuration; short names of axes are spelt out, unknown ones stay and weigh nothing."""
        names = {"property": "property_preservation", "cultural": "cultural_appropriateness", "register": "register_consistency", "persona_style": "persona_style_consistency"}
        own = {k: v for k, v in given.items() if k in cls.__dataclass_fields__ and k not in ("weights", "actions")}
        if given.get("weights"):
            own["weights"] = {names.get(k, k): float(v) for k, v in given["weights"].items()}
        if given.get("actions"):
            own["actions"] = tuple(given["actions"])
        return cls(**own)


#: A rule is a column: null where the row passes, else the detail.
Rule = tuple[str, Callable[[Limits], Column]]


def variants() -> Column:
    """array<array<TURN>>: final_dialogue, and korean_dialogue where it differs; empty ones are left out."""
    a, b = F.col("final_dialogue"), F.col("korean_dialogue")
    none = F.array().cast(f"array<{TURN}>")
    both = F.array(F.coalesce(a, none), F.when(F.coalesce(a, none) == F.coalesce(b, none), none).otherwise(F.coalesce(b, none)))
    return F.filter(both, lambda v: F.size(v) > 0)


def _text(v: Column) -> Column:
    return F.array_join(F.transform(v, lambda t: F.coalesce(t["text"], F.lit(""))), JOINER)


def _fails(test: Column, detail: Column) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), detail)


def _listed(x: Column) -> Column:
    return F.array_join(x, ", ")


def turn_count_parity(_: Limits) -> Column:
    n = F.size("source_dialogue")
    return _fails(F.exists(variants(), lambda v: F.size(v) != n), F.concat(F.lit("source turns: "), n.cast("string"), F.lit("; rewritten: "), _listed(F.transform(variants(), lambda v: F.size(v).cast("string")))))


def turn_index_order(_: Limits) -> Column:
    return _fails(F.exists(variants(), lambda v: F.exists(F.transform(v, lambda t, i: t["index"] != i), lambda x: x)), F.lit("indices are not 0 to n - 1"))


def speaker_ref_integrity(_: Limits) -> Column:
    names = F.transform("speakers", lambda s: s["name_en"])
    missing = lambda x: F.filter(x, lambda n: ~F.array_contains(names, n))
    new, old = missing(F.transform("persona", lambda p: p["speaker_name_en"])), missing(F.transform("speaker_personas", lambda p: p["speaker_ref"]))
    bad = F.when(F.coalesce(F.size("persona"), F.lit(0)) > 0, new).otherwise(F.coalesce(old, F.array().cast("array<string>")))
    return _fails(F.size(bad) > 0, F.concat(F.lit("no such speaker: "), _listed(bad)))


def ascii_share(limits: Limits) -> Column:
    return _fails(F.exists(variants(), lambda v: ascii_ratio(_text(v)) > limits.ascii_ratio_max), F.lit(f"more than {limits.ascii_ratio_max:g} of the text is ASCII"))


def mapped_ref_surface(_: Limits) -> Column:
    gone = F.filter("mapped_refs", lambda m: (F.coalesce(m["ko"], F.lit("")) != "") & F.exists(variants(), lambda v: ~F.contains(_text(v), m["ko"])))
    return _fails(F.size(gone) > 0, F.concat(F.lit("not in the text: "), _listed(F.transform(gone, lambda m: m["ko"]))))


def _mapped_terms() -> Column:
    return F.transform("mapped_refs", lambda m: F.lower(m["term"]))


def cultural_ref_coverage(_: Limits) -> Column:
    gone = F.filter("dialogue_decomposed.cultural_refs", lambda r: ~F.array_contains(_mapped_terms(), F.lower(r["term"])))
    return _fails(F.size(gone) > 0, F.concat(F.lit("not mapped: "), _listed(F.transform(gone, lambda r: r["term"]))))


def mapped_ref_ko_hangul(_: Limits) -> Column:
    bad = F.filter("mapped_refs", lambda m: ~has_hangul_block(m["ko"]))
    return _fails(F.size(bad) > 0, F.concat(F.lit("no Hangul: "), _listed(F.transform(bad, lambda m: F.coalesce(m["ko"], F.lit(""))))))


def mapped_ref_type_consistency(_: Limits) -> Column:
    """Of references with equal terms the last cultural reference counts."""

    def wanted(m):
        same = F.filter("dialogue_decomposed.cultural_refs", lambda r: F.lower(r["term"]) == F.lower(m["term"]))
        return F.get(F.reverse(same), F.lit(0))["type"]

    bad = F.filter("mapped_refs", lambda m: F.coalesce(wanted(m) != m["type"], F.lit(False)))
    return _fails(F.size(bad) > 0, F.concat(F.lit("another type: "), _listed(F.transform(bad, lambda m: m["term"]))))


def mapped_ref_terms_in_source(_: Limits) -> Column:
    """Off unless it is asked for."""
    source = F.lower(_text(F.col("source_dialogue")))
    bad = F.filter("mapped_refs", lambda m: ~F.contains(source, F.lower(m["term"])))
    return _fails(F.size(bad) > 0, F.concat(F.lit("not in the source: "), _listed(F.transform(bad, lambda m: m["term"]))))


RULES: tuple[Rule, ...] = (
    ("turn_count_parity", turn_count_parity),
    ("turn_index_order", turn_index_order),
    ("speaker_ref_integrity", speaker_ref_integrity),
    ("ascii_ratio", ascii_share),
    ("mapped_ref_surface", mapped_ref_surface),
    ("cultural_ref_coverage", cultural_ref_coverage),
    ("mapped_ref_ko_hangul", mapped_ref_ko_hangul),
    ("mapped_ref_type_consistency", mapped_ref_type_consistency),
)
EXTRA: tuple[Rule, ...] = (("mapped_ref_terms_in_source", mapped_ref_terms_in_source),)


def reason(stage: str, rule: str | Column, detail: Column) -> Column:
    name = F.lit(rule) if isinstance(rule, str) else rule
    return F.struct(F.lit(stage).alias("stage"), name.alias("rule"), detail.alias("detail"), F.create_map().cast("map<string,string>").alias("extra")).cast(REASON)


def first_failure(rules: tuple[Rule, ...] = RULES, limits: Limits = Limits(), stage: str = STAGE) -> Column:
    """The reason of the first rule that fails, or null."""
    return F.coalesce(*[F.when(detail.isNotNull(), reason(stage, name, detail)) for name, rule in rules for detail in (rule(limits),)])


def reject(df: DataFrame, found: Column) -> DataFrame:
    """Valid rows with a reason become invalid and carry it; others stay as they are."""
    out = df.withColumn("_reason", F.when(F.col("valid"), found))
    none = F.array().cast(f"array<{REASON}>")
    out = out.withColumn("reject_reasons", F.when(F.col("_reason").isNotNull(), F.concat(F.coalesce("reject_reasons", none), F.array("_reason"))).otherwise(F.coalesce("reject_reasons", none)))
    return out.withColumn("valid", F.col("valid") & F.col("_reason").isNull()).drop("_reason")


def apply(df: DataFrame, rules: tuple[Rule, ...] = RULES, limits: Limits = Limits()) -> DataFrame:
    return reject(df, first_failure(rules, limits))


@dataclass(frozen=True)
class DocumentFilter:
    """A score of a text and what score keeps it."""

    score: Callable[[Column], Column]
    keep: Callable[[Column], Column]

    def __call__(self, text: Column) -> Column:
        return self.keep(self.score(text))


ASCII_FILTER = DocumentFilter(ascii_ratio, lambda s: s <= Limits().ascii_ratio_max)
HANGUL_FILTER = DocumentFilter(lambda t: has_hangul_block(t).cast("double"), lambda s: s > 0)
