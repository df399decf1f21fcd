"""Flags on mapped references."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import has_hangul, strip
from dialoom.plans.schemas import FLAG, MAPPED_REF

# Types whose counterpart needs Hangul, those of them where its lack is a warning only, and words that do not belong to a type.
NEEDS_HANGUL = ("brand", "service", "food", "holiday", "pop_culture", "event")
WARN_ONLY = ("pop_culture",)
OFF_DOMAIN = {
    "brand": ("캐릭터", "게임", "애니메이션", "원신", "genshin", "캐릭", "만화"),
    "service": ("캐릭터", "게임", "애니메이션", "원신", "만화"),
    "food": ("캐릭터", "게임", "애니메이션", "원신", "만화"),
    "other": ("캐릭터", "게임", "원신"),
    "holiday": ("게임", "원신", "애니메이션"),
    "event": ("게임", "원신", "애니메이션"),
}
_JOINED = "[A-Za-z가-힣]+_[A-Za-z가-힣]+"


def _flag(code: str, severity: Column, message: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), severity.alias("severity"), message.alias("message"))


def _listed(x: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(x, "', '"), F.lit("']"))


def flags(term: Column, ko: Column, kind: Column, notes: Column) -> Column:
    """array<FLAG>. An empty or unchanged counterpart is the only flag of its reference."""
    ko, notes, kind = F.coalesce(ko, F.lit("")), F.coalesce(notes, F.lit("")), F.coalesce(F.nullif(kind, F.lit("")), F.lit("other"))
    low = F.lower(strip(ko))
    missing = (low == "") | (low == F.lower(strip(F.coalesce(term, F.lit("")))))
    latin = F.when(kind.isin(*NEEDS_HANGUL) & ~has_hangul(ko), _flag("non_hangul_ko", F.when(kind.isin(*WARN_ONLY), "warn").otherwise("error"), F.concat(F.lit('a "'), kind, F.lit('" has no Hangul: '), ko)))
    parts = F.concat(F.regexp_extract_all(ko, F.lit(_JOINED), F.lit(0)), F.regexp_extract_all(notes, F.lit(_JOINED), F.lit(0)))
    joined = F.when(F.size(parts) > 0, _flag("corrupted_token", F.lit("warn"), F.concat(F.lit("joined by underscores: "), _listed(F.slice(parts, 1, 3)))))
    banned = F.element_at(F.create_map(*[c for k, words in OFF_DOMAIN.items() for c in (F.lit(k), F.array(*map(F.lit, words)))]), kind)
    hay = F.lower(F.concat(ko, F.lit(" "), notes))
    hits = F.filter(banned, lambda w: F.contains(hay, w))
    off = F.when(F.size(hits) > 0, _flag("out_of_domain_leak", F.lit("warn"), F.concat(F.lit('words that do not suit a "'), kind, F.lit('": '), _listed(hits))))
    same = F.array(_flag("ko_empty_or_same", F.lit("error"), F.lit("empty, or the same as the term")))
    return F.when(missing, same).otherwise(F.filter(F.array(latin, joined, off), lambda f: f.isNotNull())).cast(f"array<{FLAG}>")


def validate(mapped_refs: Column) -> Column:
    """The references with their flags in `validation`."""
    return F.transform(mapped_refs, lambda m: m.withField("validation", flags(m["term"], m["ko"], m["type"], m["notes"]))).cast(f"array<{MAPPED_REF}>")


def verify_flagged(refs: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(term, ko, type, notes, validation) where a judge has seen the flagged rows only: `judge` adds `rejected` (boolean; null where it
    failed, which lets the reference pass) and `reason`; a rejection becomes the flag llm_rejected."""
    flagged, rest = refs.where(F.size("validation") > 0), refs.where(F.size("validation") == 0)
    seen = judge(flagged)
    more = F.array(_flag("llm_rejected", F.lit("error"), F.coalesce("reason", F.lit(""))).cast(FLAG))
    seen = seen.withColumn("validation", F.when(F.coalesce("rejected", F.lit(False)), F.concat("validation", more)).otherwise(F.col("validation")))
    return seen.select(*refs.columns).unionByName(rest)
