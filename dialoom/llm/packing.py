"""Packing token sequences by bin completion over lengths.

Pieces are counted by length: a table of at most `capacity` rows whatever the input. The plan is made on these counts by branch and bound:
around the largest length left, the undominated fillings of the rest of the sequence are enumerated, best fit first as incumbent, and
cut off by the waste that they must leave; a filling is used as often as the counts allow. If the plan has more sequences than the lower
bound, the other fillings of each node are tried, later nodes first, while the bound of what is left allows fewer, at any number of lengths.
Then each piece finds its place by its rank among the pieces of its length.

Defined results: a null text counts as empty and is one piece, the end mark; rows that repeat are packed each; an empty table
gives no rows. Only documents longer than the capacity are cut: full pieces, and before them one that may be shorter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import settle, spread_rank, table
from dialoom.llm.tokens import Encoder, shared_encoder, vocabulary_path

CAPACITY, END = 2048, 0
#: Nodes of the search for one filling, nodes of the search over fillings after the first plan, and fillings that a node branches into.
#: Beyond them the incumbent stands, and the plan says that it is not proven.
FILL_NODES, PLAN_NODES, BRANCHES = 3_000, 400, 3
#: Rows of a bucket in which ranks are counted, and bits of an order below its buckets.
RANK_ROWS, ORDER_BITS = 2_000, 40

Filling = tuple[tuple[int, int], ...]


def fillings(counts: dict[int, int], sizes: list[int], room: int, most: int = BRANCHES) -> list[Filling]:
    """Up to `most` undominated fillings ((length, copies), ...) of `room`, least waste first. sizes: lengths in use, descending."""
    found: dict[Filling, int] = {}
    nodes = 0
    chosen: list[list[int]] = []

    def note(waste: int) -> None:
        if waste:  # dominated if a longer piece that is left could stand for one of them
            for size, _ in chosen:
                for s in sizes:
                    if s <= size:
                        break
                    if s <= size + waste and counts[s] > next((n for c, n in chosen if c == s), 0):
                        return
        found[tuple((s, n) for s, n in chosen)] = waste

    def go(i: int, left: int) -> None:
        nonlocal nodes
        nodes += 1
        if nodes > FILL_NODES and found or len(found) >= most and not max(sorted(found.values())[:most]):
            return
        while i < len(sizes) and sizes[i] > left:
            i += 1
        if i == len(sizes) or not left:
            note(left)
            return
        worst = sorted(found.values())[most - 1] if len(found) >= most else left + 1
        extra = sum(min(counts[s] * s, left) for s in sizes[i : i + 8])
        if extra < left:
            extra = sum(counts[s] * s for s in sizes[i:])
        if left - extra >= worst:
            return
        s = sizes[i]
        for n in range(min(counts[s], left // s), -1, -1):  # the first descent is the best fit, the incumbent
            if n:
                chosen.append([s, n])
            elif sum(counts[x] * x for x in sizes[i + 1 : i + 400]) == 0:
                break
            go(i + 1, left - n * s)
            if n:
                chosen.pop()
            if nodes > FILL_NODES and found or found and not min(found.values()) and len(found) >= most:
                return

    import sys

    sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000))
    go(0, room)
    if not found:
        found[()] = room
    return sorted(found, key=lambda f: (found[f], [-s for s, _ in f]))[:most]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound. For each k up to half the capacity: pieces of more than capacity - k share no sequence with one of k or more, those
    above half share none with each other, and what of the pieces from k to half does not fit beside these needs sequences of its own."""
    sizes = np.array(sorted(counts), np.int64)
    n = np.array([counts[s] for s in sizes.tolist()], np.int64)
    if not len(sizes):
        return 0
    number, tokens = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * sizes)])
    half = np.searchsorted(sizes, capacity // 2, side="right")
    k = np.concatenate([[0], sizes[:half]])
    alone = np.searchsorted(sizes, capacity - k, side="right")  # pieces from here on are above capacity - k
    low = np.searchsorted(sizes, k)
    large = number[-1] - number[half]
    room = (number[alone] - number[half]) * capacity - (tokens[alone] - tokens[half])
    over = np.maximum(0, -(-((tokens[half] - tokens[low]) - room) // capacity))
    return int(large + over.max())


@dataclass(frozen=True)
class Plan:
    """steps: (pieces of a sequence as ((length, copies), ...), number of such sequences), using every piece once; bound: a number of sequences
    that no plan can go below; proven: whether this plan is known to be one of the shortest."""

    steps: list[tuple[Filling, int]]
    bound: int
    proven: bool

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.steps)


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Branch and bound over fillings, at any number of lengths. The first descent takes the best filling of each node; the others of a
    node are enumerated when the search comes back to it, the latest nodes first, and a node is given up when its bound reaches the incumbent.
    The search ends with the tree, at the lower bound, or after PLAN_NODES nodes beyond the first descent; only then is the plan not proven."""
    start = {s: n for s, n in counts.items() if n > 0}
    bound = least_sequences(start, capacity)
    best: list[tuple[Filling, int]] | None = None
    best_n = 0
    # (steps so far, sequences so far, fillings of the next sequence not tried yet; None: not enumerated yet, first one taken already)
    stack: list[tuple[list, int, list[Filling] | None]] = []
    left, steps, used = start, [], 0
    nodes = 0
    ended = False

    def options(left: dict[int, int], most: int) -> tuple[int, list[Filling]]:
        first = max(left)
        rest = {s: n - (s == first) for s, n in left.items()}
        sizes = sorted((s for s, n in rest.items() if n and s <= capacity - first), reverse=True)
        return first, fillings(rest, sizes, capacity - first, most)

    def take(left: dict[int, int], first: int, filling: Filling) -> tuple[dict[int, int], tuple[Filling, int], int]:
        own = dict(filling)
        own[first] = own.get(first, 0) + 1
        times = min(left[s] // n for s, n in own.items())
        return {s: k for s, n in left.items() if (k := n - times * own.get(s, 0))}, (tuple(sorted(own.items(), reverse=True)), times), times

    while True:
        while left and (best is None or used + least_sequences(left, capacity) < best_n):  # descend
            if best is not None:
                nodes += 1
            first, tries = options(left, 1)
            stack.append((steps, used, None))
            left, step, times = take(left, first, tries[0])
            steps, used = [*steps, step], used + times
            if nodes > PLAN_NODES:
                break
        if not left and (best is None or used < best_n):
            best, best_n = steps, used
        if best is not None and best_n <= bound or nodes > PLAN_NODES:
            break
        while stack:  # come back
            steps, used, tries = stack.pop()
            left = dict(start)
            for filling, times in steps:
                for s, n in filling:
                    left[s] -= times * n
            left = {s: n for s, n in left.items() if n}
            if used + least_sequences(left, capacity) >= best_n:
                continue
            nodes += 1
            first, every = options(left, BRANCHES)
            tries = every[1:] if tries is None else tries
            if tries:
                if len(tries) > 1:
                    stack.append((steps, used, tries[1:]))
                left, step, times = take(left, first, tries[0])
                steps, used = [*steps, step], used + times
                break
            if nodes > PLAN_NODES:
                break
        else:
            ended = True
        if ended or nodes > PLAN_NODES:
            break
    return Plan(best or [], bound, best_n <= bound)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Filling, int]]:
    return best_plan(counts, capacity).steps


class Places:
    """Where the piece of a length with a rank goes."""

    def __init__(self, steps: list[tuple[Filling, int]]):
        taken: dict[int, int] = {}
        rows, base = [], 0
        for filling, times in steps:
            offset = 0
            for size, copies in filling:
                at = taken.get(size, 0)
                rows.append((size, at, times, base, offset))
                taken[size] = at + copies * times
                offset += copies * size
            base += times
        rows.sort()
        self.size, self.start, self.times, self.base, self.offset = np.array(rows, np.int64).reshape(-1, 5).T
        self.n = base

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.int64(1) << 44
        i = np.searchsorted(self.size * far + self.start, size * far + rank, side="right") - 1
        own = rank - self.start[i]
        return self.base[i] + own % self.times[i], self.offset[i] + own // self.times[i] * size


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, key: str = "doc_id", text: str = "text", carry: str | None = None, keep: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every document with its end mark, and the long column `carry` of its document. With `keep`
    a Python worker holds its encoder from task to task: less time, but about 100 MB a worker that other stages then lack."""
    path = vocabulary or vocabulary_path()

    def cut(batches):
        import pyarrow as pa

        encoder = shared_encoder(path) if keep else Encoder(path)
        mark = np.array([end], encoder.kind).tobytes()
        for b in batches:
            cols: list[list[int | None]] = [[], [], [], [], [], []]
            for k, t, c0 in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                ids = np.frombuffer(encoder.encode_bytes(t.as_py()) + mark, encoder.kind).astype("<u4")
                first = len(ids) % capacity or capacity
                for p, at in enumerate([0, *range(first, len(ids), capacity)]):
                    own = ids[at : first if p == 0 else at + capacity]
                    for c, v in zip(cols, (k, p, at, len(own), zlib.crc32(own.tobytes()), c0)):
                        c.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["k", "piece", "start", "length", "ids_crc32", "c"])

    own = F.col(carry) if carry else F.lit(None)
    made = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), own.cast("long").alias("c")).mapInArrow(cut, "k long, piece int, start long, length long, ids_crc32 long, c long")
    return made.select(F.col("k").alias(key), "piece", "start", "length", "ids_crc32", *([F.col("c").alias(carry)] if carry else []))


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, key: str = "doc_id", text: str = "text", carry: str | None = None, in_order: bool = False, report: bool = False, keep: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece, and the long column `carry` of its document; with `report`
    also plan_sequences, plan_bound (no plan has fewer) and plan_proven (this one is known to be a shortest), the same in all rows.

    With in_order, `carry` is a non-negative order of the documents in which at most a few thousand share the bits above ORDER_BITS: pieces
    of a length are placed in that order, and sequences are numbered by the earliest of their pieces. The plan is the same. `keep`: see `pieces`.
    """
    made = settle(pieces(docs, capacity, end, vocabulary, key, text, carry, keep), "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    found = best_plan(counts, capacity)
    places = made.sparkSession.sparkContext.broadcast(Places(found.steps))
    told = {"plan_sequences": F.lit(found.sequences).cast("long"), "plan_bound": F.lit(found.bound).cast("long"), "plan_proven": F.lit(found.proven)} if report else {}
    if in_order:
        # pieces of a length follow the order, whose upper bits are its buckets
        rows = made.withColumn("_o", F.struct(F.coalesce(carry, F.lit(-1)).alias("c"), F.xxhash64(key, "piece", "start", "ids_crc32").alias("h")))
        bucket = F.greatest(F.shiftright(F.col("_o.c"), ORDER_BITS), F.lit(-1)).cast("int") + 1
    else:
        buckets = max(1, min(1 << 16, -(-sum(counts.values()) // RANK_ROWS)))
        rows = made.withColumn("_o", F.shiftrightunsigned(F.xxhash64(key, "piece", "start", "ids_crc32"), 1))
        bucket = F.shiftright(F.shiftright(F.col("_o"), 47) * buckets, 16).cast("int")
    ranked = spread_rank(rows, ["length"], F.col("_o"), bucket, "_rank")

    @F.pandas_udf("sequence_id long, offset long")
    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = places.value
        for size, rank in batches:
            yield pd.DataFrame(dict(zip(("sequence_id", "offset"), own.find(size.to_numpy(np.int64), rank.to_numpy(np.int64)))))

    out = ranked.withColumn("_place", placed("length", "_rank")).select(key, "piece", "start", "length", "ids_crc32", F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"), *([carry] if carry else []))
    if not in_order:
        return out.withColumns(told)
    # sequences are numbered by the earliest of their pieces
    out = settle(out, "placed")
    first = out.groupBy("sequence_id").agg(F.min(F.coalesce(carry, F.lit(-1))).alias("first")).withColumn("all", F.lit(0))
    number = spread_rank(first, ["all"], F.struct("first", "sequence_id"), F.greatest(F.shiftright(F.col("first"), ORDER_BITS), F.lit(-1)).cast("int") + 1, "number").select("sequence_id", "number")
    return out.join(number, "sequence_id").select(*[F.col("number").alias(c) if c == "sequence_id" else F.col(c) for c in out.columns]).withColumns(told)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), report=True, keep=True)


QUERIES = {"op6_packing": op6_packing}
SQL: dict[str, str] = {}
