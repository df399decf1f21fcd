"""Gates after the rules: safety and personal data, coherence of neighbouring turns, and scores of a judge."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.text import JOINER
from dialoom.functions.vectors import cosine
from dialoom.operators.rules import Limits, reason, reject, variants
from dialoom.plans.schemas import AXES

#: A model call: a table in, the same table with further columns out. Calls see filtered rows only.
Model = Callable[[DataFrame], DataFrame]


# ---- guardrails


def guard_text() -> Column:
    """Narrative, source, final and legacy turns; a mirrored dialogue counts twice."""
    texts = [F.transform(c, lambda t: F.coalesce(t["text"], F.lit(""))) for c in ("source_dialogue", "final_dialogue", "korean_dialogue")]
    head = F.when(F.coalesce("scene.narrative_en", F.lit("")) != "", F.array("scene.narrative_en")).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(head, *[F.coalesce(t, F.array().cast("array<string>")) for t in texts]), JOINER)


PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(^|[^0-9A-Za-z.])(\+?[0-9]{1,2}[ .-]?)?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}($|[^0-9])",
    "ssn": r"(^|[^0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}($|[^0-9-])",
    "ip": r"(^|[^0-9.])((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])($|[^0-9.])",
    "iban": r"(^|[^A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}($|[^A-Za-z0-9])",
    "crypto": r"(^|[^A-Za-z0-9])(bc1[a-z0-9]{25,39}|[13][a-km-zA-HJ-NP-Z1-9]{25,34})($|[^A-Za-z0-9])",
}
CARD = r"(?:^|[^0-9])([0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7})(?:$|[^0-9])"


def luhn(digits: Column) -> Column:
    """True if the check digit of a string of digits is right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.try_cast("int"))
    own = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2))
    return F.coalesce(F.aggregate(own, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0))) % 10 == 0, F.lit(False))


#: What every match of a kind holds, as an expression that finds it without trying the whole pattern at each character.
PII_HINTS = {
    "email": "@", "phone": r"[0-9][ .-][0-9]{4}", "ssn": r"[0-9]-[0-9]{2}-[0-9]", "ip": r"[0-9]\.[0-9]{1,3}\.[0-9]", "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}",
    "crypto": r"[13][a-zA-Z0-9]{25}", "card": r"[0-9]{4}[ -]?[0-9]{4}",
}
#: One pass: a text without any of these holds no kind.
PII_ANY = r"@|[0-9](?:[ .-][0-9]|[0-9]{4})|[A-Z]{2}[0-9]{2}|[13][a-zA-Z0-9]{25}"


def pii_kinds(text: Column) -> Column:
    """array<string>: kinds of personal data in a text; names and places are no such kind. One pass tells whether a text can hold any, and a
    hint of each kind whether its pattern is tried."""
    text = F.coalesce(text, F.lit(""))
    cards = F.transform(F.regexp_extract_all(text, F.lit(CARD), F.lit(1)), lambda c: F.regexp_replace(c, "[ -]", ""))
    found = {k: text.rlike(p) for k, p in PII_PATTERNS.items()} | {"card": F.exists(cards, lambda c: F.length(c).between(13, 19) & luhn(c))}
    hint = lambda k: F.contains(text, F.lit("@")) if k == "email" else text.rlike(PII_HINTS[k])
    kinds = F.filter(F.array(*[F.when(hint(k) & p, F.lit(k)) for k, p in found.items()]), lambda k: k.isNotNull())
    return F.when(text.rlike(PII_ANY), kinds).otherwise(F.array().cast("array<string>"))


def pii_pass(text: Column) -> Column:
    return F.size(pii_kinds(text)) == 0


def guard(df: DataFrame, safe: Callable[[Column], Column], clean: Callable[[Column], Column] = pii_pass) -> DataFrame:
    """Both flags on every row; valid rows are rejected for safety first, then for personal data."""
    out = df.withColumn("_text", guard_text())
    out = out.withColumn("quality", F.col("quality").withField("safety_pass", F.coalesce(safe(F.col("_text")), F.lit(False))).withField("pii_pass", clean(F.col("_text")))).drop("_text")
    found = F.coalesce(F.when(~F.col("quality.safety_pass"), reason("stage3.phase3", "safety", F.lit("not safe"))), F.when(~F.col("quality.pii_pass"), reason("stage3.phase3", "pii", F.lit("personal data"))))
    return reject(out, found)


# ---- coherence


def adjacent_cosine(vectors: Column) -> Column:
    """Mean cosine of neighbours; 1 below two vectors."""
    n = F.size(vectors)
    pairs = F.zip_with(F.slice(vectors, 1, F.greatest(n - 1, F.lit(0))), F.slice(vectors, 2, F.greatest(n - 1, F.lit(0))), cosine)
    return F.when(n < 2, F.lit(1.0)).otherwise(F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) / (n - 1))


def coherence(df: DataFrame, embed: Callable[[Column], Column], limits: Limits = Limits()) -> DataFrame:
    """quality.intra_kr_coherence (four places) of the rewrite; valid rows below the floor are rejected by the unrounded value. Rows
    without a rewrite are noted as passed over."""
    own = F.get(variants(), F.lit(0))
    out = df.withColumn("_c", F.when(own.isNotNull(), adjacent_cosine(F.transform(own, lambda t: embed(t["text"])))))
    note = F.create_map(F.lit("intra_kr_coherence"), F.lit("skipped_no_kr"))
    old = F.coalesce("quality.judge_reasoning", F.create_map().cast("map<string,string>"))
    q = F.col("quality").withField("intra_kr_coherence", F.round("_c", 4)).withField("judge_reasoning", F.when(F.col("_c").isNull(), F.map_concat(F.map_filter(old, lambda k, _: k != "intra_kr_coherence"), note)).otherwise(F.col("quality.judge_reasoning")))
    out = out.withColumn("quality", q)
    found = F.when(F.col("_c") < limits.coherence_floor, reason("stage3.phase4", "intra_kr_coherence", F.concat(F.lit("coherence "), F.round("_c", 3).cast("string"))))
    return reject(out, found).drop("_c")


def turn_coherence(turns: DataFrame, group: str, order: str, vector: str) -> DataFrame:
    """(group, coherence) of a table of turns: adjacent_cosine by a window."""
    w = Window.partitionBy(group).orderBy(order)
    near = turns.select(group, F.col(vector).alias("v"), F.lag(vector).over(w).alias("p"))
    return near.groupBy(group).agg(F.coalesce(F.avg(F.when(F.col("p").isNotNull(), cosine(F.col("p"), F.col("v")))), F.lit(1.0)).alias("coherence"))


# ---- judge and reward


def judge_inputs() -> dict[str, Column]:
    """What a judge and a reward model are given."""
    text = lambda turns: F.array_join(F.transform(turns, lambda t: F.concat(t["speaker"], F.lit(": "), t["text"])), "\n")
    short = lambda s: F.when(F.length(s) > 120, F.concat(F.substring(s, 1, 117), F.lit("..."))).otherwise(s)
    d = F.col("dialogue_decomposed")
    return {
        "en": text(F.col("source_dialogue")),
        "ko": text(F.coalesce(F.get(variants(), F.lit(0)), F.col("final_dialogue"))),
        "register": d["overall_register"],
        "emotion": d["overall_emotion"]["type"],
        "intensity": d["overall_emotion"]["intensity"],
        "speech_acts": d["speech_acts"],
        "refs": F.array_join(F.transform("mapped_refs", lambda m: F.concat(m["term"], F.lit(" -> "), m["ko"])), ", "),
        "persona": F.array_join(F.transform("persona", lambda e: F.concat(e["speaker_name_en"], F.lit(": "), F.coalesce(e["retrieved_persona"]["name"], F.lit("")), F.lit(", "), F.coalesce(e["retrieved_persona"]["age"].cast("string"), F.lit("")), F.lit(", "), F.coalesce(short(e["retrieved_persona"]["summary_text"]), F.lit("")))), "\n"),
    }


def weighted_mean(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """Sum of weight x score over the sum of weights, of the scores that are there; 0 without any. Three places."""
    use = [(scores[a], w) for a, w in weights.items() if a in scores]
    add = lambda parts: reduce(lambda a, b: a + b, parts, F.lit(0.0))
    top = add(F.when(s.isNotNull(), s * w).otherwise(0.0) for s, w in use)
    under = add(F.when(s.isNotNull(), F.lit(w)).otherwise(0.0) for s, w in use)
    return F.when(under > 0, F.round(top / under, 3)).otherwise(0.0)


def judge(df: DataFrame, scores: Model, limits: Limits = Limits()) -> DataFrame:
    """Valid rows only are scored. `scores` adds `axes` (map<string,int>), `reasoning` (map<string,string>), `reward` (map<string,double>),
    `judge_error` and `reward_error` (string; null where the call worked). The first of judge_error, reward_error, axis_floor,
    aggregate_floor rejects."""
    inputs = F.struct(*[c.alias(n) for n, c in judge_inputs().items()])
    rest = df.where(~F.col("valid"))
    seen = scores(df.where("valid").withColumn("judge_input", inputs))
    worked = F.col("judge_error").isNull() & F.col("reward_error").isNull()
    q = F.col("quality")
    for a in AXES:
        q = q.withField(a, F.when(worked, F.coalesce(F.try_element_at("axes", F.lit(a)), F.col(f"quality.{a}"))).otherwise(F.col(f"quality.{a}")))
    total = weighted_mean({a: F.try_element_at("axes", F.lit(a)) for a in AXES}, limits.weights)
    q = q.withField("aggregate", F.when(worked, total).otherwise(F.col("quality.aggregate"))).withField("reward", F.when(worked, F.col("reward")).otherwise(F.col("quality.reward"))).withField("judge_reasoning", F.when(worked, F.col("reasoning")).otherwise(F.col("quality.judge_reasoning")))
    seen = seen.withColumn("quality", q)
    low = F.filter(F.array(*[F.when(F.col(f"quality.{a}") < limits.axis_floor, F.lit(a)) for a in AXES]), lambda a: a.isNotNull())
    stage = "stage3.phase5"
    found = F.coalesce(
        F.when(F.col("judge_error").isNotNull(), reason(stage, "judge_error", F.col("judge_error"))),
        F.when(F.col("reward_error").isNotNull(), reason(stage, "reward_error", F.col("reward_error"))),
        F.when(F.size(low) > 0, reason(stage, "axis_floor", F.concat(F.lit(f"below {limits.axis_floor}: "), F.array_join(low, ", ")))),
        F.when(F.col("quality.aggregate") < limits.aggregate_floor, reason(stage, "aggregate_floor", F.concat(F.col("quality.aggregate").cast("string"), F.lit(f" below {limits.aggregate_floor:g}")))),
    )
    return reject(seen, found).select(*df.columns).unionByName(rest)
