"""Hard negatives by inverted lists: for an anchor and each of its positives, the rows of other labels that score in a window below it.

Scores are inner products of whole numbers, floor(scale * x). Every row lies in the list of its nearest centroid; a list knows its radius,
so that |q| times the radius around q times the centroid bounds the scores in it. Lists are visited by upper bound, those outside
the window are skipped, and a search ends when the bound falls strictly below the k-th score, so the result is exact.

Defined results: rows without an identifier, label or vector, with a null or non-finite component or one that scaled exceeds MOST in size
take no part, as anchor, positive or negative. Of rows that repeat an identifier the one of the least label and vector counts. Equal scores go
by the smaller identifier. Vectors of different sizes never meet; zero vectors score 0. Anchors without positives, or
without rows in a window, give no rows, as an empty table does. Further columns of any name are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import scratch_path, scratch_scope, settle, table

#: Rows of a list, about; lists at most; rows that centroids are fitted on, about; rounds of the fit; rows of a block, about.
LIST_ROWS, MOST_LISTS, FITTED, FIT_ROUNDS, BLOCK = 64, 1024, 20_000, 8, 8192
#: Greatest scaled component: products of vectors of up to 8,192 components are exact in doubles.
MOST = 1 << 20
INFINITE = float("inf")


def whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))


def usable(vector: str, scale: int) -> Column:
    inside = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= MOST / scale), F.lit(False)))
    return F.coalesce(F.col(vector).isNotNull() & inside, F.lit(False))


def padded(vectors: pd.Series, width: int = 0) -> np.ndarray:
    """(rows, width or the greatest size): rows of components, filled up with zeros."""
    sizes = [len(v) for v in vectors]
    out = np.zeros((len(sizes), max([width, *sizes])))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(rows, centers): squared distances, about; either side may be wider."""
    w = min(x.shape[1], centers.shape[1])
    return (x * x).sum(1)[:, None] - 2 * (x[:, :w] @ centers[:, :w].T) + (centers * centers).sum(1)[None]


def fit(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of a sample by Lloyd's rounds, in the order of their place along the direction in which they differ most."""
    rng = np.random.default_rng(12)
    centers = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)] if len(sample) else np.zeros((1, 0))
    for _ in range(FIT_ROUNDS if len(centers) > 1 else 0):
        near = _squares(sample, centers).argmin(1)
        sums, counts = np.zeros_like(centers), np.bincount(near, minlength=len(centers))
        np.add.at(sums, near, sample)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    if len(centers) > 2 and centers.shape[1]:
        middle = centers - centers.mean(0)
        centers = centers[np.argsort(middle @ np.linalg.svd(middle, full_matrices=False)[2][0], kind="stable")]
    return centers


def in_lists(centers: np.ndarray, v: str) -> Column:
    """struct<list, far>: the nearest centroid and the distance to it."""

    @F.pandas_udf("list int, far double")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = padded(batch, centers.shape[1])
            near = _squares(x, centers).argmin(1) if len(x) else np.zeros(0, int)
            own = np.pad(centers, ((0, 0), (0, x.shape[1] - centers.shape[1])))[near]
            yield pd.DataFrame({"list": near, "far": np.sqrt(((x - own) ** 2).sum(1))})

    return place(v)


class Bounds:
    """Of all lists, by number: centroid, radius and group. Groups are what queries are sent to: some small lists, or one large one."""

    def __init__(self, centers: np.ndarray, radius: np.ndarray, group: np.ndarray):
        self.centers, self.radius, self.group = centers, radius, group

    def of(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, lists): lower and upper bounds of the scores of a query in a list, by Cauchy and Schwarz, widened by the rounding."""
        return bounds(q, self.centers, self.radius)

    def visits(self, q: np.ndarray, low: list, high: list, floor: list, first: bool) -> list[list[int]]:
        """For each query the groups with a list that may hold a score between low and high that is not below floor, in one of its windows;
        if `first`, only those of each window's best list."""
        lower, upper = self.of(q)
        out = []
        for n in range(len(q)):
            best = np.minimum(upper[n][None], np.asarray(high[n], float)[:, None])
            open_ = (self.group >= 0)[None] & (best >= np.maximum(np.asarray(low[n], float), np.asarray(floor[n], float))[:, None]) & (lower[n][None] <= np.asarray(high[n], float)[:, None])
            if first:
                # of lists that reach the top of a window the one of the highest bound
                rank = np.where(open_, upper[n][None], -np.inf)
                found = np.unique(self.group[rank.argmax(1)[open_.any(1)]])
            else:
                found = np.unique(self.group[open_.any(0)])
            out.append(found.tolist())
        return out


def bounds(q: np.ndarray, centers: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = min(q.shape[1], centers.shape[1])
    middle, length = q[:, :w] @ centers[:, :w].T, np.sqrt((q * q).sum(1))[:, None]
    reach = length * radius[None]
    slack = 1e-9 * (np.abs(middle) + reach + length * np.sqrt((centers * centers).sum(1))[None]) + 1e-6
    return middle - reach - slack, middle + reach + slack


class Lists:
    """The lists, or parts of lists, of a block: rows of one size of vectors, list by list."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, lists: np.ndarray, far: np.ndarray, x: np.ndarray, centers: np.ndarray):
        order = np.lexsort((ids, lists))
        self.ids, self.labels, lists = ids[order], labels[order], lists[order]
        numbers, starts = np.unique(lists, return_index=True)
        self.cuts = np.append(starts, len(lists))
        self.centers = centers[numbers]
        self.radius = np.maximum.reduceat(far[order], starts) * (1 + 1e-9) + 1e-6 if len(ids) else np.zeros(0)
        self.x = x[order]

    def search(self, anchor: int, label: int, q: np.ndarray, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int, same: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window its first k (ids, scores): of the label or of others, by score and then identifier. floor: scores that k others are
        known to have."""
        lower, upper = (b[0] for b in bounds(q[None], self.centers, self.radius))
        bar = np.maximum(low, floor)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(low)
        near = np.argsort(-upper, kind="stable")
        at, step = 0, 4
        while at < len(near):
            # a window is done when no list that is left can reach its bar: bounds only fall from here
            live = [w for w in range(len(low)) if upper[near[at]] >= bar[w]]
            if not live:
                break
            lists = [t for t in near[at : at + step] if any(upper[t] >= bar[w] and lower[t] <= high[w] for w in live)]
            at, step = at + step, step * 2
            if not lists:
                continue
            rows = np.concatenate([np.arange(self.cuts[t], self.cuts[t + 1]) for t in lists])
            rows = rows[(self.labels[rows] == label) & (self.ids[rows] != anchor) if same else self.labels[rows] != label]
            scores = self.x[rows] @ q
            for w in live:
                fits = (scores >= bar[w]) & (scores <= high[w])
                ids, own_scores = np.concatenate([best[w][0], self.ids[rows[fits]]]), np.concatenate([best[w][1], scores[fits]])
                top = np.lexsort((ids, -own_scores))[:k]
                best[w] = ids[top], own_scores[top]
                if len(top) == k:
                    bar[w] = max(bar[w], own_scores[top[-1]])
        return best


#: What a query carries: the pairs it asks for, each one's window of scores, and the score that enough others have.
WINDOWS = (("pair", "bigint"), ("low", "double"), ("high", "double"), ("floor", "double"))


def searching(centers: np.ndarray, k: int, same: bool):
    """Rows of blocks, first those of lists (side 0), then queries (side 1), which stream past: (anchor, pair, found, score)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here: int | None = None
        held: list[pd.DataFrame] = []
        ready: dict[int, Lists] | None = None
        codes: dict[str, int] = {}
        for b in batches:
            for (number, side), part in b.groupby(["block", "side"], sort=True):
                if number != here:
                    here, held, ready = number, [], None
                if side == 0:
                    held.append(part[["id", "label", "v", "list", "far"]])
                    continue
                if ready is None:
                    ready, codes = {}, {}
                    rows = pd.concat(held) if held else part.iloc[:0]
                    for label in rows["label"].unique():
                        codes[label] = len(codes)
                    for dim, own in rows.groupby(rows["v"].map(len)):
                        wide = np.pad(centers, ((0, 0), (0, max(0, dim - centers.shape[1]))))
                        ready[dim] = Lists(own["id"].to_numpy(), own["label"].map(codes).to_numpy(), own["list"].to_numpy(), own["far"].to_numpy(), padded(own["v"], dim), wide)
                    held = []
                out: list[tuple[np.ndarray, ...]] = []
                for id_, label, v, pair, low, high, floor in part[["id", "label", "v", *[c for c, _ in WINDOWS]]].itertuples(index=False, name=None):
                    if len(v) not in ready:
                        continue
                    got = ready[len(v)].search(id_, codes.get(label, -1), np.asarray(v, float), np.asarray(low), np.asarray(high), np.asarray(floor), k, same)
                    out += [(np.full(len(ids), id_), np.full(len(ids), p), ids, scores.astype(np.int64)) for p, (ids, scores) in zip(pair, got) if len(ids)]
                if out:
                    yield pd.DataFrame(dict(zip(("anchor", "pair", "found", "score"), map(np.concatenate, zip(*out)))))

    return run


def hard_negatives(
    vectors: DataFrame, asked: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label", lists: int | None = None, block: int = BLOCK
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `asked`, a condition on (id, label), picks the anchors; `window` is in hundredths of the positive's score. Centroids are fitted on about
    FITTED rows (at most MOST_LISTS), all rows are indexed. Lists are sent to tasks in blocks: groups of neighbouring small
    lists, or pieces by hash of a large one. An anchor asks the group of its best list first; the k-th score there says which other groups are asked.
    Of equal rows of a label only the first few identifiers can be chosen; others are no candidates, so that copies fill no list.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("v", scale))
    rows = rows.withColumn("v", whole(F.col("v"), scale))
    if rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("s")).select("id", "s.label", "s.v")
    result = scratch_path(spark, "negatives")
    with scratch_scope(spark):
        some = max(positives + 1, negatives)
        equal = Window.partitionBy(F.xxhash64("label", "v"), "label", "v").orderBy("id")  # limited before the exchange too
        candidates = settle(rows.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= some).drop("n"), "candidates")
        total = candidates.count()
        sample = candidates.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(max(1, math.ceil(total / FITTED)))) == 0).select("v").toPandas()["v"]
        centers = fit(padded(sample), lists or max(1, min(MOST_LISTS, total // LIST_ROWS)))
        placed = settle(candidates.withColumn("p", in_lists(centers, "v")).select("id", "label", "v", "p.list", "p.far"), "lists")
        known = {r["list"]: r for r in placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}  # MOST_LISTS rows at most
        radius, group = np.zeros(len(centers)), np.full(len(centers), -1)
        places, blocks, room = [], 0, 0
        for number in sorted(known):
            n = known[number]["n"]
            radius[number] = known[number]["far"] * (1 + 1e-9) + 1e-6
            pieces = max(1, -(-n // block))
            if n > room or pieces > 1:  # a new block, or as many as a large list needs
                first, room = blocks, block - n if pieces == 1 else 0
                blocks += pieces
            else:
                room -= n
            group[number] = first
            places.append((number, first, pieces))
        index = Bounds(centers, radius, group)
        where = F.broadcast(spark.createDataFrame(places, "list int, first int, pieces int"))  # a row a list
        sizes = F.broadcast(spark.createDataFrame(sorted({(first, pieces) for _, first, pieces in places}), "first int, pieces int"))
        spread = F.pmod(F.xxhash64("id"), F.col("pieces").cast("long"))
        dealt = placed.join(where, "list").select((F.col("first") + spread).cast("int").alias("block"), F.lit(0).alias("side"), "id", "label", "v", "list", "far", *[F.array().cast(f"array<{t}>").alias(c) for c, t in WINDOWS])

        def visits(first: bool) -> Column:
            @F.pandas_udf("array<int>")
            def groups(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
                for v, low, high, floor in batches:
                    out: list[list[int]] = []
                    for at in range(0, len(v), 512):
                        cut = slice(at, at + 512)
                        out += index.visits(padded(v[cut], centers.shape[1]), list(low[cut]), list(high[cut]), list(floor[cut]), first)
                    yield pd.Series(out, dtype=object)

            return groups("v", "low", "high", "floor")

        def answers(asks: DataFrame, k: int, same: bool) -> DataFrame:
            """(anchor, pair, found, score): of rows (id, label, v, pair, low, high, floor, first: a group)."""
            sent = asks.join(sizes, "first").select(F.explode(F.sequence(F.col("first"), F.col("first") + F.col("pieces") - 1)).alias("block"), F.lit(1).alias("side"), "id", "label", "v", F.lit(0).alias("list"), F.lit(0.0).alias("far"), *[c for c, _ in WINDOWS])
            return dealt.union(sent).repartition("block").sortWithinPartitions("block", "side").mapInPandas(searching(centers, k, same), "anchor long, pair long, found long, score long")

        def ranked(found: DataFrame, k: int) -> DataFrame:
            best = Window.partitionBy("anchor", "pair").orderBy(F.desc("score"), "found")
            return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

        def searched(asks: DataFrame, k: int, same: bool, tag: str) -> DataFrame:
            """(anchor, pair, rank, found, score) for rows (id, label, v, pair, low, high)."""
            found = ranked(answers(asks.withColumn("first", F.explode(visits(True))), k, same), k)
            if len({first for _, first, _ in places}) == 1:
                return found
            found = settle(found, tag)
            floors = found.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("pair", F.col("score").cast("double")))).alias("floors"))  # a few a row
            more = asks.join(floors.withColumnRenamed("anchor", "id"), "id", "left").withColumn("floor", F.transform("pair", lambda p: F.coalesce(F.element_at("floors", p), F.lit(-INFINITE)))).drop("floors")
            # what has been asked answers again: so a window's rows come from one pass
            return ranked(answers(more.withColumn("first", F.explode(visits(False))), k, same), k)

        anchors = settle(rows.where(asked), "anchors")
        nothing = [F.array(F.lit(x).cast(t)).alias(c) for (c, t), x in zip(WINDOWS, (-1, -INFINITE, INFINITE, -INFINITE))]
        pairs = settle(searched(anchors.select("id", "label", "v", *nothing), positives, True, "first-positives"), "positives")
        # whole numbers: the least score of the window, and the greatest
        low, high = F.expr(f"-floor(-score * {window[0]} / 100d)"), F.expr(f"floor(score * {window[1]} / 100d)")
        asks = pairs.withColumns({"low": low.cast("double"), "high": high.cast("double"), "floor": F.lit(-INFINITE)}).where("low <= high").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(F.col("found").alias("pair"), "low", "high", "floor"))).alias("w"))
        asks = anchors.join(asks.withColumnRenamed("anchor", "id"), "id").select("id", "label", "v", *[F.col(f"w.{c}").alias(c) for c, _ in WINDOWS])
        chosen = searched(asks, negatives, False, "first-negatives").select("anchor", F.col("pair").alias("positive"), "rank", F.col("found").alias("negative"), "score")
        scores = pairs.select("anchor", F.col("found").alias("positive"), F.col("score").alias("positive_score"))
        out = chosen.join(scores, ["anchor", "positive"]).select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        return settle(out, "negatives", result)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("id") % 100 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
SQL = {
    "op12_hard_negatives": """with r as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * x::double) for x in embedding] as v from embeddings
    where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    s as materialized (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as s from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
    p as (select * from s where same qualify row_number() over (partition by a order by s desc, b) <= 5),
    n as (select p.a, p.b as p, s.b as n, p.s as ps, s.s as ns, row_number() over (partition by p.a, p.b order by s.s desc, s.b) as k from p join s on s.a = p.a and not s.same and 30 * p.s <= 100 * s.s and 100 * s.s <= 90 * p.s)
    select a as anchor_id, p as positive_id, k::int as rank, n as negative_id, ps as positive_score, ns as negative_score from n where k <= 10"""
}
