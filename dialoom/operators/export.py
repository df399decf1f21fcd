"""Chat-format training rows and a report of what was accepted and rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from dialoom.plans.schemas import AXES, MESSAGE, schema

#: What a run of the third layer counts.
COUNTS = ("accepted", "rejected", "retry_queue", "repaired", "repaired_valid", "parse_errors")
REJECT_DIARY = ("id", "source_dialogue", "reject_reasons", "retry_actions", "mapped_refs")


def sft(df: DataFrame, system: str = "") -> DataFrame:
    """(messages, metadata): the source asked for, the rewrite answered; scores of the axes that are there."""
    text = lambda c: F.array_join(F.transform(c, lambda t: F.concat(t["speaker"], F.lit(": "), t["text"])), "\n")
    say = lambda role, x: F.struct(F.lit(role).alias("role"), x.alias("content"))
    own = F.when(F.size("final_dialogue") > 0, F.col("final_dialogue")).otherwise(F.col("korean_dialogue"))
    messages = F.array(*([say("system", F.lit(system))] if system else []), say("user", text(F.col("source_dialogue"))), say("assistant", text(own))).cast(f"array<{MESSAGE}>")
    scores = F.map_filter(F.map_from_entries(F.array(*[F.struct(F.lit(a).alias("key"), F.struct(F.col(f"quality.{a}").alias("score")).alias("value")) for a in AXES])), lambda _, v: v["score"].isNotNull())
    age = F.get(F.filter(F.transform("speakers", lambda s: s["age_group_hint"]), lambda a: a != "unknown"), F.lit(0))
    meta = F.struct(F.col("id").alias("source_id"), F.lit("dialogue").alias("domain"), F.lit(None).cast("string").alias("target_platform"), age.alias("target_age_group"), F.lit("").alias("target_community"), F.lit("neutral").alias("target_gender_style"), scores.alias("quality_score"))
    return df.where("valid").select(messages.alias("messages"), meta.cast(schema("sft")["metadata"].dataType).alias("metadata"))


def reject_diary(df: DataFrame) -> DataFrame:
    return df.where(~F.col("valid")).select(*REJECT_DIARY)


def summary(df: DataFrame, queued: DataFrame, repaired: DataFrame, errors: DataFrame) -> DataFrame:
    """One row of six counts."""
    parts = (
        df.agg(F.count_if("valid").alias("accepted"), F.count_if(~F.col("valid")).alias("rejected")), queued.agg(F.count(F.lit(1)).alias("retry_queue")),
        repaired.agg(F.count(F.lit(1)).alias("repaired"), F.count_if("valid").alias("repaired_valid")), errors.agg(F.count(F.lit(1)).alias("parse_errors")),
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


def top_rejects(df: DataFrame, n: int = 10) -> DataFrame:
    """(stage, rule, n, example): the most frequent reasons with the id of one row."""
    flat = df.select("id", F.explode("reject_reasons").alias("r"))
    return flat.groupBy("r.stage", "r.rule").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("example")).orderBy(F.desc("n"), "stage", "rule").limit(n)


def html_report(metrics: dict) -> str:
    """A page of nested lists of a report's figures."""
    from html import escape

    def block(x) -> str:
        if isinstance(x, dict):
            return "<ul>" + "".join(f"<li><b>{escape(str(k))}</b>: {block(v)}</li>" for k, v in x.items()) + "</ul>"
        return escape(f"{x:.4f}" if isinstance(x, float) else str(x))

    return f"<!doctype html><meta charset=utf-8><title>Report</title><h1>Report</h1>{block(metrics)}"


