"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A text is the multiset of its runs of five words (lower case, cut at white space); similarity is the weighted Jaccard, the sum of least
over the sum of greatest counts. Each shingle carries Poisson processes, one for each level of its weight: level 0 is the weight from 0
to 1, level j from 2 ** (j-1) to 2 ** j; a level's rate is its width, and its points carry a mark that halves the level again and again,
so that a weight inside takes the points with marks below it. Points hit signature components at random, the earliest point of a component
is its value, and two texts agree in a component with a probability that is their weighted Jaccard. Points later than all that a
signature still needs are never made.

Signatures are banded. In a band's bucket every document is compared with the bucket's head, and those that it does not
link are compared with the rest until each pair of the bucket is linked, in one component, or known to differ. Comparisons use the whole
multisets, and the threshold is a fraction that is tested in whole numbers.

Rows are compared by their texts, not by identifier: different texts under one identifier are texts of their own.

Defined results: null texts and texts without words link with nothing and are kept; a text of one to four words is one shingle; equal rows
are one text; of a tie the least identifier is the group's; null identifiers are dropped from the result of `classes`, and kept by
`keep_one`; further columns are carried by `keep_one`, whatever their names, and ignored by `classes`; an empty table gives no rows.
Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import balanced_join, boxed, connected_components, settle, table

WORDS, SIMILAR = 5, 0.8
#: Components of a signature; a band is ROWS of them. A pair of similarity 0.8 shares no band with probability 3e-6.
BANDS, ROWS = 24, 4
COMPONENTS = BANDS * ROWS

_M = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _M(30))
    x = x * _M(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _M(27))
    x = x * _M(0x94D049BB133111EB)
    return x ^ (x >> _M(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1)"""
    return ((x >> _M(11)).astype(np.float64) + 0.5) / float(1 << 53)


_memory: dict[str, int] = {}


def _word_hashes(text: str) -> np.ndarray:
    import xxhash

    out = []
    for w in text.lower().split():
        h = _memory.get(w)
        if h is None:
            if len(_memory) >= 400_000:
                _memory.clear()
            h = _memory[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        out.append(h)
    return np.array(out, np.uint64)


def shingles(text: str | None, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit shingle, count), shingles ascending."""
    h = _word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(h):
        return h, np.zeros(0, np.int64)
    m = max(1, len(h) - n + 1)
    own = np.full(m, min(n, len(h)), np.uint64)
    for i in range(min(n, len(h))):
        own = _mix((own ^ h[i : i + m]) * _M(0x9E3779B97F4A7C15) + _M(i + 1))
    return np.unique(own, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], components: int = COMPONENTS) -> np.ndarray:
    """(documents x components) ids of the earliest points; rows of empty bags are zero."""
    n = len(bags)
    time = np.full(n * components, np.inf)
    name = np.zeros(n * components, np.uint64)
    total = np.array([c.sum() for _, c in bags], np.float64)
    shingle = np.concatenate([s for s, _ in bags]) if n else np.zeros(0, np.uint64)
    count = np.concatenate([c for _, c in bags]) if n else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(n), [len(s) for s, _ in bags])
    # the levels of each weight
    levels = [(shingle, doc, count, 0, 0, 1)]
    top = int(count.max()) if len(count) else 0
    j, low = 1, 1
    while low < top:
        at = np.flatnonzero(count > low)
        levels.append((shingle[at], doc[at], count[at], j, low, low))
        j, low = j + 1, 2 * low
    # all components have a point by this time almost surely; where not, the horizon is widened for the rest
    reach = np.where(total > 0, components * (np.log(components) + 3) / np.maximum(total, 1), 0.0)
    begun = np.zeros(n)
    todo = total > 0
    while todo.any():
        for own, at_doc, own_count, j, low, width in levels:
            keep = np.flatnonzero(todo[at_doc])
            seed = _mix(own[keep] + _M((0xA0761D6478BD642F * (j + 1)) & 0xFFFFFFFFFFFFFFFF))
            d, c = at_doc[keep], own_count[keep]
            now = np.zeros(len(keep))
            step = 0
            while len(seed):
                step += 1
                r = _mix(seed + _M((0xE7037ED1A0B428DB * step) & 0xFFFFFFFFFFFFFFFF))
                now = now - np.log(_uniform(r)) / width
                on = now <= reach[d]
                seed, d, c, now, r = seed[on], d[on], c[on], now[on], r[on]
                # a mark halves the level down to single units; units below the weight count
                hit = np.ones(len(r), bool)
                r = _mix(r + _M(0x8EBC6AF09C88C6E3))
                if width > 1:
                    hit = low + (r & _M(width - 1)).astype(np.int64) < c
                    r = _mix(r)
                hit &= now > begun[d]
                cell = d[hit] * components + (r[hit] >> _M(20)).astype(np.int64) % components
                t = now[hit]
                order = np.argsort(-t, kind="stable")  # the earliest is written last
                cell, t, r2 = cell[order], t[order], r[hit][order]
                better = t < time[cell]
                cell, t, r2 = cell[better], t[better], r2[better]
                time[cell] = t
                name[cell] = r2
        begun = np.where(todo, reach, begun)
        todo &= np.isinf(time.reshape(n, components)).any(1)
        reach = np.where(todo, 2 * reach, reach)
    return name.reshape(n, components)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of least counts, sum of both bags' counts)"""
    total = int(a[1].sum() + b[1].sum())
    if not len(a[0]) or not len(b[0]):
        return 0, total
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    return int(np.minimum(a[1][same], b[1][at[same]]).sum()), total


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets; 0 if one is empty."""
    both, total = overlap(a, b)
    return both / (total - both) if both else 0.0


def _chunks(ids, texts, more, most: int = 2_000_000, rows: int = 4_000) -> Iterator[tuple[list, list, list]]:
    """Parts of at most about `most` characters and `rows` rows."""
    own: tuple[list, list, list] = ([], [], [])
    size = 0
    for x in zip(ids, texts, more):
        for c, v in zip(own, x):
            c.append(v)
        size += len(x[1])
        if size >= most or len(own[0]) >= rows:
            yield own
            own, size = ([], [], []), 0
    if own[0]:
        yield own


def _signed(rows: DataFrame) -> DataFrame:
    """(id, raw, print, size, buckets) of rows (id, text, raw): a fingerprint of the words, their shingles' number, a bucket for each
    band. Without words the print is null and there are no buckets."""

    def made(batches):
        import xxhash

        for b in batches:
            for ids, texts, raws in _chunks(b["id"], b["text"], b["raw"]):
                bags = [shingles(t) for t in texts]
                prints = [xxhash.xxh3_128_digest(" ".join(t.lower().split()).encode("utf-8", "surrogatepass")) if len(s[0]) else None for t, s in zip(texts, bags)]
                sig = signatures(bags).reshape(len(bags), BANDS, ROWS)
                h = np.full((len(bags), BANDS), 17, np.uint64)
                h *= np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    h = _mix(h * _M(31) + sig[:, :, r])
                h = h.view(np.int64)
                yield pd.DataFrame({"id": ids, "raw": raws, "print": prints, "size": [int(c.sum()) for _, c in bags], "buckets": [x if p else x[:0] for p, x in zip(prints, h)]})

    return rows.mapInPandas(made, "id long, raw binary, print binary, size long, buckets array<long>")


def _bags(asked: DataFrame) -> DataFrame:
    """(node, shingle: array<long>, n: array<int>) of rows (node, print, text), those whose text has the print."""

    def made(batches):
        import xxhash

        for b in batches:
            for nodes, texts, prints in _chunks(b["node"], b["text"], b["print"]):
                out = []
                for node, t, p in zip(nodes, texts, prints):
                    if xxhash.xxh3_128_digest(" ".join(t.lower().split()).encode("utf-8", "surrogatepass")) == bytes(p):
                        s, n = shingles(t)
                        out.append((node, s.view(np.int64), n.astype(np.int32)))
                yield pd.DataFrame(out, columns=["node", "shingle", "n"])

    return asked.mapInPandas(made, "node long, shingle array<long>, n array<int>")


def _bag(shingle, n) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(shingle, np.int64).view(np.uint64), np.asarray(n)


def _reaches(shared, total, similar: Fraction):
    """shared / (total - shared) >= similar, in whole numbers: the same for a pair by itself and in a tile."""
    return (similar.numerator + similar.denominator) * shared >= similar.numerator * total


#: Pairs of one document that meet one copy of its bag.
SALT_ROWS = 256


def _verified(pairs: DataFrame, bags: DataFrame, similar: Fraction) -> DataFrame:
    """The pairs (src, dst, rows) whose whole multisets are as similar as that. `rows` bounds how many pairs src has: its bag is dealt in
    one copy for each SALT_ROWS of them, so that no task gets all pairs of one document."""

    @F.pandas_udf("boolean")
    def near(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, an, b, bn in batches:
            out = []
            for w, x, y, z in zip(a, an, b, bn):
                both, total = overlap(_bag(w, x), _bag(y, z))
                out.append(bool(both) and _reaches(both, total, similar))
            yield pd.Series(out, dtype=bool)

    copies = F.ceil(F.col("rows") / SALT_ROWS).cast("int")
    asks = pairs.groupBy(F.col("src").alias("node")).agg(F.max(copies).alias("copies"))
    left = bags.join(asks, "node").select(F.col("node").alias("src"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.col("shingle").alias("s1"), F.col("n").alias("n1"))
    salted = pairs.select("src", F.col("dst").alias("node"), F.pmod(F.xxhash64("dst"), copies).cast("int").alias("salt"))
    right = salted.join(bags, "node").select("src", F.col("node").alias("dst"), "salt", F.col("shingle").alias("s2"), F.col("n").alias("n2"))
    return left.join(right, ["src", "salt"]).where(near("s1", "n1", "s2", "n2")).select("src", "dst")


def tile_overlap(a: list[tuple[np.ndarray, np.ndarray]], b: list[tuple[np.ndarray, np.ndarray]], cells: int = 8_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(shared, total) counts of all pairs of two tiles: the k-th copy of a shingle is a column of its own, so that least counts are a
    product of 0/1 matrices, made in slices of columns of at most `cells` cells; columns of one side only are left out."""

    def units(bags):
        row = np.repeat(np.arange(len(bags)), [int(c.sum()) for _, c in bags])
        s = np.concatenate([np.repeat(x, c) for x, c in bags])
        k = np.concatenate([np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c) for _, c in bags])
        return row, _mix(s + _M(0x9E3779B97F4A7C15) * k.astype(np.uint64))

    (ra, ca), (rb, cb) = units(a), units(b)
    shared = np.intersect1d(ca, cb)
    sides = []
    for r, c in ((ra, ca), (rb, cb)):
        at = np.searchsorted(shared, c)
        at[at == len(shared)] = 0
        ok = shared[at] == c if len(shared) else np.zeros(len(c), bool)
        order = np.argsort(at[ok], kind="stable")
        sides.append((r[ok][order], at[ok][order]))
    both = np.zeros((len(a), len(b)), np.float32)
    width = max(64, cells // max(len(a), len(b), 1))
    for low in range(0, len(shared), width):
        part = []
        for (r, c), n in zip(sides, (len(a), len(b))):
            i, j = np.searchsorted(c, [low, low + width])
            m = np.zeros((n, min(width, len(shared) - low)), np.float32)
            m[r[i:j], c[i:j] - low] = 1
            part.append(m)
        both += part[0] @ part[1].T
    sa, sb = (np.array([int(c.sum()) for _, c in x], np.int64) for x in (a, b))
    return both.astype(np.int64), sa[:, None] + sb[None, :]


#: Buckets up to this size are compared pair by pair; larger ones in tiles of so many shingles, and so many documents, on average.
SMALL, TILE_SHINGLES, TILE_ROWS = 16, 150_000, 800


def _tiled(large: DataFrame, bags: DataFrame, similar: Fraction) -> DataFrame:
    """Links (src, dst) between components within the buckets `large` (bucket, node, component, size, shingles). Each document has a home,
    its largest bucket; homes are cut into tiles, and tiles that share a bucket are compared in one task, which returns a spanning forest."""
    home = large.groupBy("node", "component").agg(F.min(F.struct((-F.col("size")).alias("s"), F.col("bucket").alias("b")))["b"].alias("home"), F.first("shingles").alias("shingles"))
    cuts = home.groupBy("home").agg(F.greatest(F.ceil(F.sum("shingles") / TILE_SHINGLES), F.ceil(F.count(F.lit(1)) / TILE_ROWS)).cast("long").alias("cuts"))
    tile = F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("cuts")))
    tiles = settle(balanced_join(home, cuts, "home").select("node", "component", tile.alias("tile")), "tiles")
    meets = large.join(tiles.select("node", "tile"), "node").select("bucket", "tile").distinct()
    pairs = meets.select("bucket", F.col("tile").alias("a")).join(meets.select("bucket", F.col("tile").alias("b")), "bucket").where("a <= b").select("a", "b").distinct()
    pairs = pairs.withColumn("pair", F.xxhash64("a", "b"))
    sides = pairs.select(F.col("a").alias("tile"), "pair", F.lit(0).alias("side")).union(pairs.where("a <> b").select(F.col("b").alias("tile"), "pair", F.lit(1).alias("side")))
    dealt = tiles.join(bags, "node").join(sides, "tile").select("pair", "side", "component", "shingle", "n")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
        b = b if len(b) else a
        out = []
        if len(a):
            both, total = tile_overlap([_bag(x, n) for x, n in zip(a["shingle"], a["n"])], [_bag(x, n) for x, n in zip(b["shingle"], b["n"])])
            i, j = np.nonzero((both > 0) & _reaches(both, total, similar) & (a["component"].to_numpy()[:, None] != b["component"].to_numpy()[None, :]))
            up: dict[int, int] = {}

            def root(x: int) -> int:
                while up.get(x, x) != x:
                    x = up[x]
                return x

            ca, cb = a["component"].tolist(), b["component"].tolist()
            for p, q in zip(i.tolist(), j.tolist()):
                x, y = root(ca[p]), root(cb[q])
                if x != y:
                    up[max(x, y)] = min(x, y)
                    out.append((ca[p], cb[q]))
        return pd.DataFrame(out, columns=["src", "dst"]).astype("int64")

    return dealt.groupBy("pair").applyInPandas(compare, "src long, dst long")


def _grouped(docs: DataFrame, similar: float, key: str, text: str) -> DataFrame:
    """(id, raw, component, group_id) of every row with an identifier. raw: md5 of the text; component: null where a text links with none."""
    ratio = Fraction(similar).limit_denominator(1_000_000)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), body.alias("text"), F.unhex(F.md5(body.cast("binary"))).alias("raw")).where("id is not null")
    # a node of the graph is a class of texts of the same words; its number is that of one of its rows, fixed once they are written
    signed = settle(_signed(rows).withColumn("row", F.monotonically_increasing_id()), "signed")
    worded = signed.where("print is not null")
    least = F.min(F.struct(F.col("row").alias("node"), "id", "size", "buckets")).alias("s")
    heads = settle(worded.groupBy("print").agg(least, F.min("id").alias("least")).select("print", "s.node", "s.id", F.col("s.size").alias("shingles"), "s.buckets", "least"), "heads")
    spread = heads.select("node", "shingles", F.explode("buckets").alias("bucket"))
    first = spread.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = settle(balanced_join(spread, first, "bucket"), "members")
    pairs = members.where("node <> head").groupBy(F.col("head").alias("src"), F.col("node").alias("dst")).agg(F.max("size").alias("rows"))
    asked = rows.join(members.select("node").distinct().join(heads.select("node", "id", "print"), "node"), "id")
    bags = settle(_bags(asked.select("node", "print", "text")), "bags")
    component = connected_components(_verified(pairs, bags, ratio))
    placed = settle(members.join(component.withColumnRenamed("id", "node"), "node", "left").select("bucket", "node", "head", "size", "shingles", F.coalesce("component", "node").alias("component")), "placed")
    # buckets whose documents are not all of one component yet: the others are open
    several = placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("bucket", F.lit(True).alias("open"))
    mixed = settle(balanced_join(placed, several, "bucket").drop("open"), "mixed")
    small = mixed.where(F.col("size") <= SMALL)
    one = small.select("bucket", F.col("node").alias("src"), F.col("component").alias("c1"), (F.col("node") == F.col("head")).alias("h1"))
    two = small.select("bucket", F.col("node").alias("dst"), F.col("component").alias("c2"), (F.col("node") == F.col("head")).alias("h2"))
    # a pair with a bucket's head has been compared
    left_over = one.join(two, "bucket").where("src < dst and c1 <> c2 and not h1 and not h2").select("src", "dst", F.lit(1).alias("rows")).distinct()
    of = placed.select("node", "component").distinct()
    linked = _verified(settle(left_over, "open"), bags, ratio)
    linked = linked.join(of.select(F.col("node").alias("src"), F.col("component").alias("a")), "src").join(of.select(F.col("node").alias("dst"), F.col("component").alias("b")), "dst")
    more = linked.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(_tiled(mixed.where(F.col("size") > SMALL), bags, ratio))
    # what the second pass links are components of the first
    joined = connected_components(more).select(F.col("id").alias("component"), F.col("component").alias("root"))
    merged = balanced_join(component, joined, "component").select("id", "root")
    own = joined.select(F.col("component").alias("id"), "root").union(merged).groupBy("id").agg(F.min("root").alias("root"))
    final = component.join(own, "id", "full").select(F.col("id").alias("node"), F.coalesce("root", "component").alias("component"))
    nodes = heads.select("print", "node", "least").join(final, "node", "left").select("print", F.coalesce("component", "node").alias("component"), "least")
    nodes = settle(nodes, "nodes")
    named = balanced_join(nodes, nodes.groupBy("component").agg(F.min("least").alias("group_id")), "component").select("print", "component", "group_id")
    out = balanced_join(worded.select("id", "raw", "print"), named, "print").select("id", "raw", "component", "group_id")
    return out.union(signed.where("print is null").select("id", "raw", F.lit(None).cast("long"), "id"))


def classes(docs: DataFrame, similar: float = SIMILAR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, group_id): for every row with an identifier, the least identifier of its component of similar texts."""
    return _grouped(docs, similar, key, text).select(F.col("id").alias(key), "group_id")


def keep_one(docs: DataFrame, similar: float = SIMILAR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, that of the least identifier, and of several texts under it the one of the least md5;
    texts without words and rows without identifier all stay, equal rows of an identifier once."""
    found = _grouped(docs, similar, key, text).where(F.col("id") == F.col("group_id"))
    wordless = F.when(F.col("component").isNull(), F.col("raw"))
    kept = found.groupBy("id", "component", wordless.alias("own")).agg(F.min("raw").alias("raw")).select(F.col("id").alias("_kept"), F.col("raw").alias("_as")).distinct()
    rows = boxed(docs, _id=F.col(key).cast("long"), _raw=F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    named = rows.where("_id is not null").join(kept, (F.col("_id") == F.col("_kept")) & (F.col("_raw") == F.col("_as")), "left_semi").dropDuplicates(["_id", "_raw"])
    return named.union(rows.where("_id is null")).select("_row.*")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = classes(docs).select("doc_id", "group_id", (F.col("doc_id") == F.col("group_id")).alias("kept"))
    nameless = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("group_id"), F.lit(True).alias("kept"))
    return found.union(nameless)


QUERIES = {"op9_near_dedup": op9_near_dedup}
SQL = {
    "op9_near_dedup": """with recursive w as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') as w from documents),
    s as (select doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i+4], ' ') end as g from w, unnest(range(1, greatest(len(w) - 3, 2))) as t(i) where len(w) > 0),
    c as (select doc_id, md5(g) as g, count(*) as n from s group by all), z as (select doc_id, sum(n) as n from c group by doc_id),
    p as (select a.doc_id as a, b.doc_id as b, sum(least(a.n, b.n)) as k from c a join c b on a.g = b.g and a.doc_id <> b.doc_id group by all),
    l as (select p.a, p.b from p join z x on x.doc_id = p.a join z y on y.doc_id = p.b where 9 * k >= 4 * (x.n + y.n)),
    r as (select doc_id as a, doc_id as b from documents union select r.a, l.b from r join l on r.b = l.a),
    m as (select a, min(b) as g from r group by a)
    select a as doc_id, g as group_id, a is not distinct from g as kept from m"""
}
