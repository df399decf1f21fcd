"""Operators on embedding vectors: near-duplicates by int8 tile products, and nearest neighbours by stable projections.

Both: null vectors, vectors without length, with null or non-finite components, and rows without an identifier take no
part. Vectors of different sizes never meet. Of rows that repeat an identifier the one with the least (label and) vector counts. Equal scores
are ranked by identifier; of equal vectors the least identifier names the component. Empty tables give no rows; further columns of the
input, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import balanced_join, connected_components, settle, table


def usable(vector: str) -> Column:
    """True for vectors that can take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# ---- cells of projected space, which both operators deal vectors by

#: Dimensions of a projection; rows that the cuts are fitted on, about, chosen by a hash of the identifier; rounds of cuts at most, each of which doubles the cells.
PROJECTED, FITTED, MOST_CUTS = 8, 20_000, 10


def _orthonormal(dim: int) -> np.ndarray:
    """Orthonormal directions: a projected distance is never above the distance."""
    return np.linalg.qr(np.random.default_rng(20_011).standard_normal((dim, min(dim, PROJECTED))))[0]


def _stable(dim: int) -> np.ndarray:
    """Directions of normal components: a squared projected distance is the squared distance times a chi-square variable."""
    return np.random.default_rng(7 + dim).standard_normal((dim, PROJECTED))


def _projection(directions: Callable[[int], np.ndarray]) -> Callable[[str], Column]:
    """array<double> of PROJECTED components of the unit vector."""

    @F.pandas_udf("array<double>")
    def flat(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            out = np.zeros((len(v), PROJECTED))
            sizes = v.map(len)
            for dim in sizes.unique():
                at = np.flatnonzero(sizes == dim)
                own = _unit(_matrix(v.iloc[at])) @ directions(dim)
                out[at, : own.shape[1]] = own
            yield pd.Series(list(out))

    return flat


class Cells:
    """Cells of projected space by a tree of median cuts: node i is cut along axis[i] at cut[i], its sides are nodes 2 i + 1 and 2 i + 2."""

    def __init__(self, points: np.ndarray, cuts: int):
        self.cuts = cuts
        self.axis, self.cut = np.zeros(2**cuts - 1, np.int64), np.full(2**cuts - 1, np.inf)
        own = {0: points.reshape(-1, PROJECTED)}
        for node in range(2**cuts - 1):
            at = own.pop(node)
            if len(at) and np.ptp(at, axis=0).max() > 0:
                self.axis[node] = axis = int(np.argmax(np.ptp(at, axis=0)))
                x = at[:, axis]
                middle = np.median(x)
                self.cut[node] = middle if middle > x.min() else x[x > middle].min()
            right = at[:, self.axis[node]] >= self.cut[node]
            own[2 * node + 1], own[2 * node + 2] = at[~right], at[right]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.cuts):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.cut[node])
        return node - (2**self.cuts - 1)

    def column(self, flat: str) -> Column:
        @F.pandas_udf("int")
        def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield pd.Series(self.of(_matrix(x).reshape(-1, PROJECTED)))

        return cell(flat)


def fitted(rows: DataFrame, total: int, cells: float) -> Cells:
    """About as many cells of the `total` rows (id, flat), 2 ** MOST_CUTS at most, fitted on a sample of about FITTED rows."""
    cuts = min(MOST_CUTS, max(0, math.ceil(math.log2(max(1, cells)))))
    if not cuts:
        return Cells(np.zeros((0, PROJECTED)), 0)
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(math.ceil(total / FITTED))) == 0).select("flat")  # one row in so many
    return Cells(_matrix(some.toPandas()["flat"]), cuts)


def boxes(placed: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cell, rows, least and greatest components) of each cell of rows (cell, flat): one row a cell."""
    ends = [f(F.col("flat")[i]) for f in (F.min, F.max) for i in range(PROJECTED)]
    found = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.array(*ends).alias("ends")).orderBy("cell").collect()
    ends = np.array([r["ends"] for r in found]).reshape(-1, 2, PROJECTED)
    return np.array([r["cell"] for r in found], np.int64), np.array([r["rows"] for r in found], np.int64), ends[:, 0], ends[:, 1]


# ---- near-duplicates

#: Rows of a tile.
TILE_ROWS = 1024


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, length of scale x codes, length of the error), for each unit vector. The lengths are rounded up."""
    scale = np.abs(u).max(axis=1) / 127
    codes = np.rint(u / scale[:, None])
    near = codes * scale[:, None]
    up = 1 + 1e-9
    return codes.astype(np.int8), scale, np.sqrt((near * near).sum(1)) * up, np.sqrt(((u - near) ** 2).sum(1)) * up + 1e-12


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the pairs with cosine >= threshold. The int8 product and the bound of its error name the pairs that may
    reach it; only these are computed in double precision."""
    qa, sa, na, ea = quantise(a)
    qb, sb, nb, eb = quantise(b)
    exact = np.float32 if a.shape[1] <= 1000 else np.float64  # products of codes are whole numbers below 2 ** 24
    rough = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64) * sa[:, None] * sb[None, :]
    slack = na[:, None] * eb[None, :] + ea[:, None] * nb[None, :] + ea[:, None] * eb[None, :] + 1e-9
    i, j = np.nonzero(rough + slack >= threshold)
    keep = np.zeros(len(i), bool)
    for k in range(0, len(i), 200_000):
        p, q = i[k : k + 200_000], j[k : k + 200_000]
        keep[k : k + 200_000] = (a[p] * b[q]).sum(1) >= threshold
    return i[keep], j[keep]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that suffice to connect what the links connect."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for p, q in zip(i.tolist(), j.tolist()):
        a, b = root(p), root(q)
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((p, q))
    return out


def near_duplicates(vectors: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", label: str = "label", tile_rows: int = TILE_ROWS) -> DataFrame:
    """(key, n_links, component_id, kept), one row for each row of the input with an identifier.

    Equal vectors of a label are one class with a count. Classes are cut into tiles: by cells of a projection on PROJECTED orthonormal
    directions, large cells by hash into tiles of about `tile_rows`. Cells whose boxes are further apart than the threshold allows never
    meet; no link is lost by that. A task compares two tiles and returns counts of links and a spanning forest, never the pairs;
    components come from the forests.
    """
    gap = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")).where("id is not null")
    everything = rows
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
    if repeated:  # of several rows the least usable one, else any
        good = F.coalesce(F.col("label").isNotNull() & usable("v"), F.lit(False))
        rows = rows.groupBy("id").agg(F.min(F.struct((~good).alias("bad"), "label", "v")).alias("s")).select("id", "s.label", "s.v")
    part = rows.where(F.col("label").isNotNull() & usable("v"))

    classes = part.groupBy("label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = settle(classes.withColumn("flat", _projection(_orthonormal)("v")).withColumn("dim", F.size("v")), "classes")
    labels = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.max("n"), F.lit(0)).alias("largest")).first()
    classes = classes.withColumn("cell", fitted(classes, labels["total"], labels["largest"] / tile_rows).column("flat"))
    names, _, low, high = boxes(classes)
    place = ["label", "dim", "cell"]
    counts = classes.groupBy(*place).agg(F.count(F.lit(1)).alias("rows"))
    tiles = counts.select(*place, F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / tile_rows).cast("int"))).alias("cut"), F.ceil(F.col("rows") / tile_rows).cast("int").alias("cuts"))
    tiles = settle(tiles, "tiles")
    other = tiles.select("label", "dim", F.col("cell").alias("cell_b"), F.col("cut").alias("cut_b"))
    # only cells that can meet are joined: a table of one row a cell says which, 2 ** MOST_CUTS at most
    near = []
    for k, name in enumerate(names):
        apart = np.maximum(np.maximum(low[k:] - high[k], low[k] - high[k:]), 0)
        near.append((int(name), names[k:][(apart * apart).sum(1) <= gap * gap].tolist()))
    near = vectors.sparkSession.createDataFrame(near, "cell int, near array<int>")
    ask = tiles.join(F.broadcast(near), "cell").select(*place, "cut", F.explode("near").alias("cell_b"))
    pairs = ask.join(other, ["label", "dim", "cell_b"]).where("cell_b > cell or cut_b >= cut")
    pairs = pairs.withColumn("pair", F.xxhash64("label", "dim", "cell", "cut", "cell_b", "cut_b"))
    sides = pairs.select("label", "dim", "cell", "cut", "pair", F.lit(0).alias("side")).union(
        pairs.where("cell_b <> cell or cut_b <> cut").select("label", "dim", F.col("cell_b").alias("cell"), F.col("cut_b").alias("cut"), "pair", F.lit(1).alias("side"))
    )
    cut = F.pmod(F.xxhash64("id"), F.col("cuts").cast("long")).cast("int")
    placed = classes.join(counts.select(*place, F.ceil(F.col("rows") / tile_rows).cast("int").alias("cuts")), place).withColumn("cut", cut).drop("cuts")
    dealt = placed.join(sides, [*place, "cut"]).select("pair", "side", "id", "n", "v")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
        same = not len(b)
        b = a if same else b
        out: list[tuple[int, int | None, int]] = []
        if len(a) and len(b):
            ua = _unit(_matrix(a["v"]))
            ub = ua if same else _unit(_matrix(b["v"]))
            i, j = tile_links(ua, ub, threshold)
            if same:
                i, j = i[i != j], j[i != j]
            ia, ib = a["id"].to_numpy(), b["id"].to_numpy()
            linked = np.bincount(i, b["n"].to_numpy()[j], len(a)).astype(np.int64)
            out += [(int(ia[k]), None, int(linked[k])) for k in np.flatnonzero(linked)]
            if not same:
                linked = np.bincount(j, a["n"].to_numpy()[i], len(b)).astype(np.int64)
                out += [(int(ib[k]), None, int(linked[k])) for k in np.flatnonzero(linked)]
            shift = 0 if same else len(a)
            out += [(int(ia[p]), int(ib[q - shift]), 0) for p, q in _forest(i, j + shift, len(a) + len(b))]
        return pd.DataFrame(out, columns=["id", "other", "links"])

    found = settle(dealt.groupBy("pair").applyInPandas(compare, "id long, other long, links long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("other is not null").select(F.col("id").alias("src"), F.col("other").alias("dst")))
    known = classes.join(links, "id", "left").join(component, "id", "left")
    # equal vectors may be many: their rows meet their class by a balanced join on a hash, which equality then confirms
    print_of = F.xxhash64("label", F.transform("v", lambda x: F.when(x == 0, 0.0).otherwise(x.cast("double")))).alias("print")
    known = known.select(print_of, F.col("label").alias("own_label"), F.col("v").alias("own_v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    met = balanced_join(part.select("id", "label", "v", print_of), known, "print").where("label = own_label and v = own_v")
    rest = rows.where(~(F.col("label").isNotNull() & usable("v"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = met.select("id", "n_links", "component_id").union(rest)
    if repeated:
        out = balanced_join(everything.select("id"), out, "id")
    return out.select(F.col("id").alias(key), F.col("n_links").cast("long").alias("n_links"), "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


# ---- nearest neighbours

#: Rows of a leaf, probability that the stopping test asks for.
LEAF, SURE = 128, 0.99
#: Rows of a block of vectors, on average.
BLOCK = 8192


def chi_square(x: np.ndarray, m: int) -> np.ndarray:
    """P(chi-square with m degrees <= x), for even m."""
    half = np.maximum(x, 0) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def passes(reach: np.ndarray, cosine: np.ndarray | float, sure: float) -> np.ndarray:
    """The stopping test: True where a vector as near as `cosine` would, with probability `sure`, have a squared projected distance below
    `reach`. Cosines are off by rounding; equal vectors are not to fail for that."""
    return chi_square(reach / (np.maximum(2 - 2 * cosine, 0) + 1e-12), PROJECTED) >= sure


class KdTree:
    """Leaves of a kd-tree over projected points: row numbers in tree order, leaf bounds and the leaves' boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(points))
        cuts = [0]
        stack = [(0, len(points))]
        leaves = []
        while stack:
            a, b = stack.pop()
            if b - a <= leaf:
                leaves.append((a, b))
                continue
            own = order[a:b]
            axis = int(np.argmax(np.ptp(points[own], axis=0)))
            mid = (b - a) // 2
            order[a:b] = own[np.argpartition(points[own, axis], mid)]
            stack += [(a, a + mid), (a + mid, b)]
        leaves.sort()
        self.order, self.bounds = order, leaves
        self.low = np.array([points[order[a:b]].min(0) for a, b in leaves])
        self.high = np.array([points[order[a:b]].max(0) for a, b in leaves])

    def reach(self, q: np.ndarray) -> np.ndarray:
        """Squared distance from a projected query to each leaf's box."""
        d = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return (d * d).sum(1)


class Block:
    """A block of vectors with its kd-tree over their projections; answers any number of batches of queries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.spread = _stable(x.shape[1])
        u = _unit(x)
        self.tree = KdTree(u @ self.spread)
        order = self.tree.order
        self.ids, self.x, self.u = ids[order], x[order], u[order]
        self.norms = np.sqrt((self.x * self.x).sum(1))

    def search(self, asked: np.ndarray, q: np.ndarray, k: int, sure: float = SURE, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, neighbour, cosine): the k best of the block for each query, nearest leaves first, until the test holds: a vector
        nearer than the k-th would, with probability `sure`, have had a projection nearer than all that are left. `floor`: a cosine that
        k others are known to have, minus infinity if none is; what lies below it is left out."""
        uq = _unit(q)
        flat = uq @ self.spread
        out_q, out_i, out_s = [], [], []
        for n in range(len(q)):
            reach = self.tree.reach(flat[n])
            near = np.argsort(reach, kind="stable")
            best_at, best = np.zeros(0, np.int64), np.zeros(0)
            step, least = 4, -np.inf if floor is None else floor[n]
            for r in range(0, len(near), step):
                bar = max(least, best[k - 1] if len(best) >= k else -np.inf)
                if bar > -np.inf and passes(reach[near[r]], bar, sure):
                    break
                at = np.concatenate([np.arange(*self.tree.bounds[t]) for t in near[r : r + step]])
                at = at[self.ids[at] != asked[n]]
                own = self.u[at] @ uq[n]
                at, own = at[own >= least - 1e-9], own[own >= least - 1e-9]
                best_at, best = np.concatenate([best_at, at]), np.concatenate([best, own])
                if len(best) > k:
                    edge = np.partition(best, len(best) - k)[len(best) - k] - 1e-9  # ties are settled on exact scores
                    best_at, best = best_at[best >= edge], best[best >= edge]
                sort = np.argsort(-best, kind="stable")
                best_at, best = best_at[sort], best[sort]
            exact = (self.x[best_at] * q[n]).sum(1) / (self.norms[best_at] * np.sqrt((q[n] * q[n]).sum()))
            top = np.lexsort((self.ids[best_at], -exact))[:k]
            out_q.append(np.full(len(top), asked[n]))
            out_i.append(self.ids[best_at][top])
            out_s.append(exact[top])
        return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", sure: float = SURE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score). The top of the kd-tree is cut into cells, large cells by hash into blocks with trees of their own.

    A query is answered by its own cell first; its k-th cosine there then says, by the same stopping test, which other cells' boxes are
    near enough to be asked, and bounds the search in them. A query that finds fewer than k in its cell asks all cells. A block's tree is
    made once for each of the two passes; queries stream past it. Of each query k rows a block go on to the last ranking. Of equal vectors
    only the k + 1 of least identifier can be among a query's k nearest: the others are no candidates, so that copies fill no cell.
    """
    ok = usable(vector) & F.col(key).isNotNull()
    rows, asked = (t.where(ok).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")) for t in (vectors, queries))
    if rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    asked = asked.groupBy("id").agg(F.min("v").alias("v"))
    equal = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")  # limited before the exchange too
    rows = rows.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1).drop("n")
    rows, asked = (t.withColumn("flat", _projection(_stable)("v")) for t in (rows, asked))
    rows = settle(rows, "candidates")
    total = rows.count()
    cells = fitted(rows, total, total / block)
    rows, asked = (t.withColumn("cell", cells.column("flat")) for t in (rows, asked))
    names, sizes, low, high = boxes(rows)
    cuts = -(-sizes // block)
    blocks = [(int(c), int(first), int(n)) for c, first, n in zip(names, np.cumsum(cuts) - cuts, cuts)]
    places = F.broadcast(vectors.sparkSession.createDataFrame(blocks, "cell int, first int, cuts int"))  # one row a cell

    def answers(asks: DataFrame) -> DataFrame:
        """(query_id, vec_id, score) of rows (id, v, floor, cell)."""
        left = rows.join(places, "cell").select((F.col("first") + F.pmod(F.xxhash64("id"), F.col("cuts").cast("long"))).cast("int").alias("block"), F.lit(0).alias("side"), "id", "v", F.lit(0.0).alias("floor"))
        right = asks.join(places, "cell").select(F.explode(F.sequence(F.col("first"), F.col("first") + F.col("cuts") - 1)).alias("block"), F.lit(1).alias("side"), "id", "v", "floor")
        dealt = left.union(right).repartition("block").sortWithinPartitions("block", "side")
        return dealt.mapInPandas(search, "query_id long, vec_id long, score double")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here: int | None = None
        held: list[pd.DataFrame] = []
        trees: dict[int, Block] | None = None
        for b in batches:
            for (number, side), part in b.groupby(["block", "side"], sort=True):
                if number != here:
                    here, held, trees = number, [], None
                if side == 0:
                    held.append(part[["id", "v"]])
                    continue
                if trees is None:
                    trees = {}
                    if held:
                        x = pd.concat(held)
                        for dim, own in x.groupby(x["v"].map(len)):
                            trees[dim] = Block(own["id"].to_numpy(), _matrix(own["v"]))
                    held = []
                for dim, own in part.groupby(part["v"].map(len)):
                    if dim in trees:
                        yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), trees[dim].search(own["id"].to_numpy(), _matrix(own["v"]), k, sure, own["floor"].to_numpy()))))

    @F.pandas_udf("array<int>")
    def others(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for flat, own, floor in batches:
            points, own, floor, out = _matrix(flat).reshape(-1, PROJECTED), own.to_numpy(), floor.to_numpy(), []
            for at in range(0, len(points), 256):  # so many queries by all cells at a time
                q = points[at : at + 256, None, :]
                d = np.maximum(np.maximum(low[None] - q, q - high[None]), 0)
                bar = floor[at : at + 256, None]
                near = ~((bar > -np.inf) & passes((d * d).sum(2), np.maximum(bar, -1), sure)) & (names[None] != own[at : at + 256, None])
                out += [names[x].tolist() for x in near]
            yield pd.Series(out, dtype=object)

    def ranked(found: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    none = F.lit(float("-inf"))
    found = ranked(answers(asked.select("id", "v", none.alias("floor"), "cell")))
    if cells.cuts:
        found = settle(found, "nearest")
        floors = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        more = asked.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", none))
        asks = more.select("id", "v", "floor", F.explode(others("flat", "cell", "floor")).alias("cell"))
        found = ranked(found.select("query_id", "vec_id", "score").union(answers(asks)))
    return found


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 50 = 0"), 5)


QUERIES = {"op7_embedding_dedup": op7_embedding_dedup, "op10_nearest": op10_nearest}
SQL = {
    "op7_embedding_dedup": """with recursive e as (select vec_id, label, embedding::double[] as v, label is not null and embedding is not null and (list_max(embedding) > 0 or list_min(embedding) < 0) as ok from embeddings),
    l as (select a.vec_id as a, b.vec_id as b from e a join e b on a.label = b.label and a.vec_id <> b.vec_id and a.ok and b.ok where list_cosine_similarity(a.v, b.v) >= 0.98),
    r as (select vec_id as a, vec_id as b from e union select r.a, l.b from r join l on r.b = l.a),
    c as (select a, min(b) as component_id from r group by a), n as (select a, count(*) as n from l group by a)
    select e.vec_id, coalesce(n.n, 0) as n_links, c.component_id, e.vec_id = c.component_id as kept from e join c on c.a = e.vec_id left join n on n.a = e.vec_id"""
}
