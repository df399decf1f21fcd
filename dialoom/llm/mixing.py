"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are cut into blocks. Block i (from 1) of a source of weight w is released at slot floor((i - 1) / w) and due by slot
ceil(i / w); each slot takes the released block that is due first. Then at any slot the number of a source's blocks differs from
its weight times the slots by less than one, at any size of the input. A schedule repeats after a number of slots, its resolution: one
period is worked out, a table of bounded size, and every block finds its slot by its number.

Given weights: the resolution is a common denominator of the sources' shares where there is one up to MOST_SLOTS, so that a period holds
the weights exactly and nothing adds up. Where there is none (`exact_resolution`), and for weights that follow the sources' sizes, the targets are
the shares rounded to multiples of 1 / resolution, four times the number of blocks within RESOLUTION and MOST_SLOTS, or MOST_SLOTS as soon as
a source would have less than a slot; the bound of one block is to these. A share is moved by at most half of such a multiple, so from unrounded
weights a source is off by one block more after 2 x MOST_SLOTS slots or later. Sources of less than a slot of the longest period, however
many, share one entry; their blocks are numbered in it as a table, interleaved by weight, without a bound for each.

No row is dropped or repeated: where a source has run out, its slots stay empty and the others follow on in the same order, so
that the weights hold for every prefix until the first source runs out (`in_mixture`), and among the sources that are left after it.

Defined results: a null source is a source of its own; sources without a weight (or of weight 0) come after all blocks that are
scheduled; rows that repeat are rows; an empty table gives no rows; null sizes and texts do not matter.
"""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import boxed, literal_rows, settle, spread_rank, table

#: Rows of a block; slots of a period, least and most; rows of a bucket in which ranks are counted.
BLOCK_ROWS, RESOLUTION, MOST_SLOTS, RANK_ROWS = 32, 10_000, 200_000, 500
#: Target weights follow the sources' shares to this power, unless they are given.
TEMPERATURE = 0.7


def whole_weights(weights: dict[str | None, float], resolution: int = RESOLUTION) -> dict[str | None, int]:
    """Weights as numbers of slots that add up to `resolution`: largest remainders, every positive weight one slot at least."""
    own = {s: Fraction(w) for s, w in weights.items() if w > 0}
    if not own:
        return {}
    total = sum(own.values())
    exact = {s: w / total * resolution for s, w in own.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    name = lambda s: (s is not None, s or "")
    rest = resolution - sum(out.values())
    for s in sorted(out, key=lambda s: (-(exact[s] - math.floor(exact[s])), name(s)))[: max(rest, 0)]:
        out[s] += 1
    while sum(out.values()) > resolution:
        s = max(out, key=lambda s: (out[s], name(s)))
        out[s] -= min(out[s] - 1, sum(out.values()) - resolution)
    return out


def exact_resolution(weights: dict[str | None, float], most: int) -> int | None:
    """The least multiple, from RESOLUTION on, of the least common denominator of the sources' shares; None if it is beyond `most`.
    A share is taken for a fraction of a denominator up to `most` if that is what its double stands for."""
    own = [Fraction(w) for w in weights.values() if w > 0]
    total = sum(own)
    common = 1
    shares = []
    for w in own:
        share = (w / total).limit_denominator(most)
        if abs(share - w / total) > share * Fraction(1, 1 << 48):
            return None
        shares.append(share)
        common = math.lcm(common, share.denominator)
        if common > most:
            return None
    if sum(shares) != 1:
        return None
    fits = -(-RESOLUTION // common) * common
    return fits if fits <= most else common


def period(slots: dict[str | None, int]) -> list[tuple[str | None, int]]:
    """(source, number of its block in the period) of each slot, by earliest deadline among what is released."""
    total = sum(slots.values())
    order = sorted(slots, key=lambda s: (s is not None, s or ""))
    waiting = [(0, n, 0) for n in range(len(order))]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    out = []
    for now in range(total):
        while waiting and waiting[0][0] <= now:
            _, n, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // slots[order[n]]), n, i))
        _, n, i = heapq.heappop(ready)
        out.append((order[n], i))
        if i + 1 < slots[order[n]]:
            heapq.heappush(waiting, ((i + 1) * total // slots[order[n]], n, i + 1))
    return out


def target_weights(counts: dict[str | None, int], temperature: float = TEMPERATURE) -> dict[str | None, float]:
    return {s: float(n) ** temperature for s, n in counts.items()}


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source", order: list[str] | None = None, block_rows: int = BLOCK_ROWS, resolution: int | None = None) -> DataFrame:
    """(row: the row as a struct, block: its number in the source, from 0, slot: of the block, null without a weight, place: in the block,
    in_mixture: before the first source runs out). Within a source rows are shuffled by a hash of `order`."""
    spark = docs.sparkSession
    order = order or [c for c in ("doc_id", "text") if c in docs.columns] or docs.columns
    rows = boxed(docs, _source=F.col(source).cast("string"), _o=F.shiftrightunsigned(F.xxhash64(*order), 1))
    sources = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("n"))
    if weights:
        given = literal_rows(spark, json.dumps([{"s": s, "w": float(w)} for s, w in weights.items() if w > 0]), "s: string, w: double")
        sources = sources.join(F.broadcast(given), F.col("_source").eqNullSafe(F.col("s")), "left").select("_source", "n", "w")
    else:
        sources = sources.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE)))
    sources = settle(sources, "sources")
    sums = sources.agg(F.sum("w").alias("w"), F.sum("n").alias("n"), F.count("w").alias("weighted"), F.min("w").alias("least"), F.sum(F.ceil(F.col("n") / block_rows)).alias("blocks")).first()
    given_sources = {s: w for s, w in (weights or {}).items() if w > 0}
    if not resolution and given_sources and sums["weighted"] == len(given_sources):  # else shares are of those that occur
        resolution = exact_resolution(given_sources, MOST_SLOTS)
    least = float(sums["least"] or 1)
    if not resolution:
        resolution = max(RESOLUTION, min(MOST_SLOTS, 4 * int(sums["blocks"] or 0)))
        if least * (resolution - 1) < float(sums["w"] or 0):
            resolution = MOST_SLOTS
    # sources of a slot a period at least, so no more than `resolution`, have slots of their own; the others that have a weight share one entry
    whole = float(sums["w"] or 0) * (1 - 1e-9)
    large = F.coalesce(F.col("w") * (resolution if least * resolution >= whole else resolution - 1) >= whole, F.lit(False))
    own = {r["_source"]: int(r["n"]) for r in sources.where(large).select("_source", "n").collect()}
    entries = {s: (weights or target_weights(own))[s] for s in own}
    small = sources.where(F.col("w").isNotNull() & ~large)
    rest = None
    if sums["weighted"] > len(own):
        rest = "rest"
        while rest in own:
            rest += "+"
        share = small.agg(F.sum("w")).first()[0]
        entries[rest] = float(f"{share:.12g}")  # whatever the order of the sum
    slots = whole_weights(entries, resolution)
    total = sum(slots.values())
    at_slot = {(s, i): at for at, (s, i) in enumerate(period(slots))}
    slot_of = lambda s, b: b // slots[s] * total + at_slot[s, b % slots[s]]
    # the slots at which sources have no block left
    ends = [slot_of(s, -(-n // block_rows)) for s, n in own.items()]
    # buckets follow a source's own size, so that all are of about RANK_ROWS rows: one row for each of the largest sources, and for
    # the others what the largest of them can have
    listed = sources.orderBy(F.desc("n"), "_source").limit(RESOLUTION).select("_source", "n").collect()
    buckets = lambda n: max(1, min(1 << 16, -(-n // RANK_ROWS)))
    sizes = own | {r["_source"]: int(r["n"]) for r in listed}
    per = literal_rows(spark, json.dumps([{"ps": s, "pn": slots.get(s) if s in own else None, "nb": buckets(n)} for s, n in sizes.items()]), "ps: string, pn: bigint, nb: bigint")
    rows = rows.join(F.broadcast(per), F.col("_source").eqNullSafe(F.col("ps")), "left")
    others = buckets(int(listed[-1]["n"])) if listed else 1
    bucket = F.shiftright(F.shiftright(F.col("_o"), 47) * F.coalesce("nb", F.lit(others)), 16).cast("int")
    ranked = spread_rank(rows, ["_source"], F.col("_o"), bucket, "_rank")
    ranked = ranked.select("_row", "_source", "pn", F.floor(F.col("_rank") / block_rows).cast("long").alias("block"), (F.col("_rank") % block_rows).cast("int").alias("place"))
    ranked = ranked.withColumn("_entry", F.col("_source")).withColumn("_number", F.col("block"))
    if rest is not None:
        shared, end = _shared(small, share, block_rows)
        ends.append(slot_of(rest, end))
        mine = (F.col("_source").eqNullSafe(F.col("_ss"))) & (F.col("block") == F.col("_sb"))
        ranked = ranked.join(shared, mine, "left")
        ranked = ranked.select("_row", F.when(F.col("_sn").isNull(), F.col("_source")).otherwise(rest).alias("_entry"), F.when(F.col("_sn").isNull(), F.col("pn")).otherwise(slots[rest]).alias("pn"), "block", "place", F.coalesce("_sn", "block").alias("_number"))
    horizon = min(ends, default=0)
    # at most `resolution` rows: small whatever the input
    schedule = literal_rows(spark, json.dumps([{"s": s, "i": i, "at": at} for (s, i), at in at_slot.items()]), "s: string, i: bigint, at: bigint")
    placed = ranked.join(F.broadcast(schedule), F.col("_entry").eqNullSafe(F.col("s")) & (F.expr("_number % pn") == F.col("i")), "left")
    slot = (F.floor(F.col("_number") / F.col("pn")) * total + F.col("at")).cast("long")
    return placed.select(F.col("_row").alias("row"), "block", slot.alias("slot"), "place", F.coalesce(slot < horizon, F.lit(False)).alias("in_mixture"))


def _shared(small: DataFrame, share: float, block_rows: int) -> tuple[DataFrame, int]:
    """(_ss: source, _sb: block, _sn: the block's number in the entry that the sources `small` share), and the number at which the first
    of them has no block left. Blocks are in the order of (block + u) / weight, where u in [0, 1) is a hash of the source: so each
    source has its share of every stretch of the entry, though not to within a block."""
    u = F.shiftrightunsigned(F.xxhash64("_source"), 11) / F.lit(float(1 << 53))
    blocks = F.ceil(F.col("n") / block_rows).cast("long")
    key = lambda b: (b + u) / F.col("w")
    made = small.select(F.col("_source").alias("_ss"), "w", u.alias("u"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("_sb"))
    made = made.select("_ss", "_sb", ((F.col("_sb") + F.col("u")) / F.col("w")).alias("_k"), F.lit(0).alias("_all"))
    # a bucket of this width holds about RANK_ROWS blocks at most
    bucket = F.floor(F.least(F.col("_k") * (share / RANK_ROWS), F.lit(float((1 << 31) - 1)))).cast("int")
    made = settle(spread_rank(made, ["_all"], F.struct("_k", "_ss", "_sb"), bucket, "_sn").select("_ss", "_sb", "_sn", "_k"), "shared")
    first = small.agg(F.min(key(blocks))).first()[0]
    return made.drop("_k"), made.where(F.col("_k") < first).count()


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source") -> DataFrame:
    """docs, all rows and only their own columns, in the order of the mixture: one range exchange by (slot, block, place)."""
    rows = mix(docs, weights, source).withColumn("slot", F.coalesce("slot", F.lit(1 << 62)))
    return rows.repartitionByRange("slot", "block", "place").sortWithinPartitions("slot", "block", "place").select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(table(spark, sf_dir, "documents").select("doc_id", "source"), order=["doc_id"])
    return rows.select("row.doc_id", "row.source", "block", "slot", "place", "in_mixture")


QUERIES = {"op5_mixing": op5_mixing}
SQL: dict[str, str] = {}
