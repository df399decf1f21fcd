"""Aggregate expressions with fixed definitions: nearest rank, entropy, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Buckets that a group's values are ordered in.
BUCKETS = 64


def half_even(x: Column, places: int = 0) -> Column:
    return F.bround(x, places)


def nearest_rank(df: DataFrame, value: str, percents: tuple[float, ...] = (0.5, 0.95), by: list[str] | None = None) -> DataFrame:
    """One row a group: mean, p50, p95 ..., n. Percentile p is the value of rank round-half-even(p (n - 1)) in ascending order, from 0.

    Values are counted first, so that what is ordered is one row a distinct value. A group's values lie in BUCKETS buckets whose edges are
    approximate percentiles, so that no task orders a whole group; sums over earlier buckets make the ranks exact, wherever the edges are.
    """
    by = by or []
    rows = df.where(F.col(value).isNotNull())
    # the group as one string that is never null
    group = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")).withColumn("_group", group)
    cuts = [i / BUCKETS for i in range(1, BUCKETS)]
    edges = counts.groupBy("_group").agg(F.percentile_approx(F.col(value).cast("double"), cuts).alias("_edges"))
    number = F.size(F.filter("_edges", lambda e: e < F.col(value).cast("double")))
    placed = counts.join(edges, "_group").withColumn("_bucket", number).drop("_edges")
    sums = placed.groupBy("_group", "_bucket").agg(F.sum("_c").alias("_sum"))
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_group", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"), F.sum("_sum").over(Window.partitionBy("_group")).alias("_n"))
    ordered = Window.partitionBy("_group", "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranks = placed.withColumn("_to", F.sum("_c").over(ordered)).join(sums, ["_group", "_bucket"]).withColumn("_to", F.col("_to") + F.col("_before"))
    picks = [F.min(F.when(F.col("_to") > half_even(F.lit(p) * (F.col("_n") - 1)), F.col(value))).cast("double").alias(f"p{round(p * 100)}") for p in percents]
    total = F.sum(F.col(value).cast("double") * F.col("_c")) / F.sum("_c")
    out = ranks.groupBy(*by).agg(F.coalesce(total, F.lit(0.0)).alias("mean"), *picks, F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("n"))
    return out.fillna(0.0)


def entropy(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """Shannon entropy in bits of the values of `key`; no row where there is none (0 without groups)."""
    by = by or []
    counts = df.where(F.col(key).isNotNull()).groupBy(*by, key).agg(F.count(F.lit(1)).alias("_c"))
    # sum of c log c and of c give the entropy in one pass
    h = F.log2(F.sum("_c")) - F.sum(F.col("_c") * F.log2("_c")) / F.sum("_c")
    return counts.groupBy(*by).agg(F.coalesce(F.greatest(h, F.lit(0.0)), F.lit(0.0)).alias("entropy"))
