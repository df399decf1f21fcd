"""Figures of a data set. Each is a small table; `compute` puts them into one row of structs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.stats import entropy, nearest_rank
from dialoom.functions.text import blank_tokens, joined_turns
from dialoom.functions.vectors import norm
from dialoom.sources.scratch import checkpointed


def rewrite_text() -> Column:
    own = F.when(F.size("final_dialogue") > 0, F.col("final_dialogue")).otherwise(F.col("korean_dialogue"))
    return joined_turns(own)


def ngrams(tokens: Column, n: int) -> Column:
    """array<array<string>>: runs of n tokens."""
    whole = F.transform(tokens, lambda t, i: F.slice(tokens, i + 1, n))
    return F.filter(whole, lambda g: F.size(g) == n)


def distinct_n(df: DataFrame, tokens: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(n, distinct_ngrams, total, ratio): n-grams of the whole table, never across rows. Counted first, then summed, so a frequent n-gram
    is one row for each task."""
    rows = df.select(tokens.alias("_t"))
    both = None
    for n in sizes:
        part = rows.select(F.lit(n).alias("n"), F.explode(ngrams(F.col("_t"), n)).alias("g"))
        both = part if both is None else both.union(part)
    counts = both.groupBy("n", "g").agg(F.count(F.lit(1)).alias("c"))
    found = counts.groupBy("n").agg(F.count(F.lit(1)).alias("distinct_ngrams"), F.sum("c").alias("total"))
    every = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, sizes))).alias("n"))
    out = every.join(found, "n", "left").fillna(0)
    return out.select("n", F.col("distinct_ngrams").cast("long").alias("distinct_ngrams"), F.col("total").cast("long").alias("total"), F.when(F.col("total") > 0, F.col("distinct_ngrams") / F.col("total")).otherwise(0.0).alias("ratio"))


def embedding_diversity(df: DataFrame, vector: str) -> DataFrame:
    """(n, diversity): mean over pairs of 1 - cosine, without making pairs. With unit vectors u (zero vectors count as cosine 0 to all), the sum of
    cosines over ordered pairs is |sum u|^2 - n+, where n+ is the number of vectors with length. Null below two vectors."""
    own = df.select(F.col(vector).alias("v"), norm(F.col(vector)).alias("l")).where("v is not null")
    parts = own.where("l > 0").select("l", F.posexplode("v").alias("pos", "x"))
    sums = parts.groupBy("pos").agg(F.sum(F.col("x").cast("double") / F.col("l")).alias("s"))
    total = sums.agg(F.coalesce(F.sum(F.col("s") * F.col("s")), F.lit(0.0)).alias("q"))
    counts = own.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l") > 0).alias("p"))
    n = F.col("n")
    return counts.crossJoin(total).select("n", F.when(n >= 2, 1 - (F.col("q") - F.col("p")) / (n * (n - 1))).alias("diversity"))  # one row each


#: Bigrams of a tile, about, and the least rows; tiles of a chunk; pairs of rows that are in memory at once.
TILE_GRAMS, TILE_ROWS, CHUNK, AT_ONCE = 6_000_000, 2_048, 4, 1 << 20
#: A bigram in this part of a tile's rows is a column of a matrix, at most so many; any other is a list of rows.
DENSE, COLUMNS = 0.03, 1_024


class Tile:
    """Rows that are sets of numbers, laid out by number, to be met by any other rows."""

    def __init__(self, sets: list[np.ndarray], weights: np.ndarray):
        sizes = np.array([len(s) for s in sets], np.int64)
        grams = np.concatenate(sets)
        at = np.argsort(grams, kind="stable")
        self.rows = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[at]
        self.grams, self.since = np.unique(grams[at], return_index=True)
        self.counts = np.diff(np.append(self.since, len(grams)))
        self.sizes, self.weights = sizes.astype(np.float64), weights.astype(np.float64)
        often = np.flatnonzero(self.counts > max(1, DENSE * len(sets)))
        often = often[np.argsort(-self.counts[often], kind="stable")][:COLUMNS]
        self.column = np.full(len(self.grams), -1, np.int32)
        self.column[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), len(sets)), np.float32)
        for c, g in enumerate(often):
            self.matrix[c, self.rows[self.since[g] : self.since[g] + self.counts[g]]] = 1

    def similarity(self, sets: list[np.ndarray], weights: np.ndarray) -> float:
        """The sum of Jaccard similarities over all pairs of one of these rows and one of the tile's, times both weights."""
        step, total = max(1, AT_ONCE // len(self.sizes)), 0.0
        for first in range(0, len(sets), step):
            total += self._sum(sets[first : first + step], np.asarray(weights[first : first + step], np.float64))
        return total

    def _sum(self, sets: list[np.ndarray], weights: np.ndarray) -> float:
        n, sizes = len(self.sizes), np.array([len(s) for s in sets], np.int64)
        grams, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        by = np.argsort(grams, kind="stable")
        grams, row = grams[by], row[by]
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        hit = self.grams[at] == grams
        at, row = at[hit], row[hit]
        column = self.column[at]
        wide = column >= 0
        own = np.zeros((len(sets), len(self.matrix)), np.float32)
        own[row[wide], column[wide]] = 1
        at, row = at[~wide], row[~wide]
        counts = self.counts[at]
        since = np.repeat(self.since[at] - (np.cumsum(counts) - counts), counts)
        met = self.rows[since + np.arange(len(since))]
        shared = np.bincount(np.repeat(row * n, counts) + met, minlength=len(sets) * n).reshape(len(sets), n) + own @ self.matrix
        whole = sizes[:, None] + self.sizes
        whole -= shared
        shared /= whole
        return float(weights @ shared @ self.weights)


def tile_similarity(rows_a: list[np.ndarray], rows_b: list[np.ndarray] | None) -> float:
    """The sum of Jaccard similarities over the pairs of a row of one list and one of the other, or over the pairs within one list."""
    tile, one = Tile(rows_a, np.ones(len(rows_a))), np.ones(len(rows_a if rows_b is None else rows_b))
    return (tile.similarity(rows_a, one) - len(rows_a)) / 2 if rows_b is None else tile.similarity(rows_b, one)


def bigram_jaccard_diversity(df: DataFrame, key: str, tokens: Column, tile_rows: int | None = None, tile_grams: int = TILE_GRAMS) -> DataFrame:
    """(pairs, diversity): mean of 1 - Jaccard of bigram sets over the pairs of rows with bigrams.

    Rows of equal sets are one row with a weight. Rows are cut into tiles by hash, of about tile_grams bigrams. A task holds one tile, laid out
    by bigram, and reads a chunk of later tiles past it: frequent bigrams are counted by a product of matrices, any other by the list of its
    rows, so a pair of rows costs what it shares. A task returns sums; neither a bigram in all rows nor a pair is ever a row of a table. The
    work is that of all pairs, and a row is sent to half of the tiles. Bigrams are compared by a hash of 64 bits.
    """
    import pyarrow as pa

    words = F.col("_t")
    joined = F.filter(F.zip_with(words, F.slice(words, 2, F.size(words)), lambda x, y: F.concat(x, F.lit(" "), y)), lambda g: g.isNotNull())
    grams = F.array_sort(F.array_distinct(F.transform(joined, lambda g: F.xxhash64(g))))
    sets = df.select(tokens.alias("_t")).select(grams.alias("g")).where(F.size("g") > 0).groupBy(F.xxhash64("g").alias("k"), F.xxhash64(F.lit(7), F.col("g")).alias("k2"), F.size("g").alias("k3"))
    rows = checkpointed(sets.agg(F.any_value("g").alias("g"), F.count(F.lit(1)).alias("w")).select("k", "g", "w"))
    size = rows.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("g").cast("long")), F.lit(0)).alias("grams")).first()
    n = size["n"]
    tiles = max(1, -(-size["rows"] // (tile_rows or max(TILE_ROWS, size["rows"] // 8))), -(-size["grams"] // tile_grams))
    placed = rows.select("g", "w", F.pmod(F.xxhash64("k", F.lit(1)), F.lit(tiles)).cast("int").alias("tile"))
    chunk = (F.col("tile") / CHUNK).cast("int")
    held = placed.withColumn("chunk", F.explode(F.sequence(chunk, F.lit((tiles - 1) // CHUNK)))).select(F.col("tile").alias("first"), "chunk", F.lit(0).alias("side"), "tile", "g", "w")
    read = placed.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("tile")))).select("first", chunk.alias("chunk"), F.lit(1).alias("side"), "tile", "g", "w")
    tasks = sum(min(tiles, c + CHUNK) for c in range(0, tiles, CHUNK))  # a chunk meets its own tiles and those before
    task = (F.col("chunk") * (F.col("chunk") + 1) / 2 * CHUNK + F.col("first")).cast("int")
    dealt = held.union(read).repartitionById(tasks, task).sortWithinPartitions("first", "chunk", "side")

    def compare(batches):
        at = side = tile = None
        sets: list[np.ndarray] = []
        weights: list[np.ndarray] = []
        total = 0.0
        for b in batches:
            first, chunk, side_, own, w = (b.column(c).to_numpy() for c in ("first", "chunk", "side", "tile", "w"))
            lists = b.column("g")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            turn = np.flatnonzero(np.diff(first) | np.diff(chunk) | np.diff(side_) | np.diff(own)) + 1
            for lo, hi in zip([0, *turn], [*turn, len(first)]):
                part = [flat[offsets[i] : offsets[i + 1]] for i in range(lo, hi)]
                if side_[lo] == 0:
                    if at != (first[lo], chunk[lo]):
                        at, tile, sets, weights = (first[lo], chunk[lo]), None, [], []
                    sets += [p.copy() for p in part]  # batches go
                    weights.append(w[lo:hi])
                elif at == (first[lo], chunk[lo]):
                    if tile is None:
                        tile, sets = Tile(sets, np.concatenate(weights)), []
                    near = tile.similarity(part, w[lo:hi])
                    # a tile meets itself: each pair twice, and each row itself
                    total += (near - float(w[lo:hi].sum())) / 2 if own[lo] == first[lo] else near
        yield pa.RecordBatch.from_pydict({"j": [total]})

    total = dealt.mapInArrow(compare, "j double").agg(F.coalesce(F.sum("j"), F.lit(0.0)).alias("j"))
    pairs = n * (n - 1) // 2
    return total.select(F.lit(pairs).cast("long").alias("pairs"), (1 - F.col("j") / pairs if n >= 2 else F.lit(0.0)).alias("diversity"))


def rewards(df: DataFrame) -> DataFrame:
    """(key, mean, p50, p95, n) of each reward."""
    flat = df.select(F.explode(F.col("quality.reward")).alias("key", "value"))
    return nearest_rank(flat, "value", by=["key"])


def coverage_entropies(df: DataFrame) -> DataFrame:
    """(field, entropy) of register, emotion, speech acts, setting, relationship, age groups and speakers' registers, in one pass."""
    d = F.col("dialogue_decomposed")
    values = {
        "register": F.array(d["overall_register"]), "emotion": F.array(d["overall_emotion"]["type"]), "speech_act": d["speech_acts"], "setting": F.array("scene.setting"),
        "relationship": F.array("scene.relationship_type"), "age_group": F.transform("speakers", lambda s: s["age_group_hint"]), "speaker_register": F.transform("speakers", lambda s: s["register"]),
    }
    flat = df.select(F.explode(F.flatten(F.array(*[_named(v, n) for n, v in values.items()]))).alias("r")).select("r.*")
    return entropy(flat, "value", by=["field"])


def _named(values: Column, name: str) -> Column:
    return F.transform(values, lambda x: F.struct(F.lit(name).alias("field"), x.alias("value")))


def cultural_refs(df: DataFrame) -> DataFrame:
    """(total, distinct_terms, ratio, type_entropy)."""
    flat = df.select(F.explode("dialogue_decomposed.cultural_refs").alias("r")).select("r.*")
    counts = flat.groupBy("term").agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_terms"))
    ratio = F.when(F.col("total") > 0, F.round(F.col("distinct_terms") / F.col("total"), 4)).otherwise(0.0)
    return counts.withColumn("ratio", ratio).crossJoin(entropy(flat, "type").withColumnRenamed("entropy", "type_entropy"))  # one row each


def mapped_refs(df: DataFrame) -> DataFrame:
    """(total, distinct_ko, retrieved_share, by_source, by_type)."""
    flat = df.select(F.explode("mapped_refs").alias("r")).select("r.*")
    whole = flat.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(F.when(F.col("ko") != "", F.col("ko"))).alias("distinct_ko"), F.coalesce(F.avg(F.coalesce("retrieved", F.lit(False)).cast("double")), F.lit(0.0)).alias("retrieved_share"))
    for c in ("source", "type"):
        counts = flat.groupBy(c).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(c, "n")))).alias(f"by_{c}"))  # a closed domain
        whole = whole.crossJoin(counts)
    return whole


def lengths(df: DataFrame) -> DataFrame:
    """(field, mean, p50, p95, n) of characters and tokens of the rewrite, source turns and mapped references."""
    text = rewrite_text()
    values = {"chars": F.length(text), "tokens": F.size(blank_tokens(text)), "turns": F.size("source_dialogue"), "mapped_refs": F.size("mapped_refs")}
    flat = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), v.cast("long").alias("value")) for n, v in values.items()])).alias("r")).select("r.*")
    return nearest_rank(flat, "value", by=["field"])


def rejects(df: DataFrame) -> DataFrame:
    """(rule, n): reasons by stage:rule."""
    return df.select(F.explode("reject_reasons").alias("r")).groupBy(F.concat_ws(":", "r.stage", "r.rule").alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def retries(df: DataFrame) -> DataFrame:
    """(by_iter, by_action, retried, valid_after_retry)."""
    out = df.agg(F.count_if(F.col("iter") > 0).alias("retried"), F.coalesce(F.count_if((F.col("iter") > 0) & F.col("valid")) / F.nullif(F.count_if(F.col("iter") > 0), F.lit(0)), F.lit(0.0)).alias("valid_after_retry"))
    tables = {"by_iter": df.select(F.col("iter").cast("string").alias("k")), "by_action": df.select(F.explode("retry_actions").alias("a")).select(F.col("a.action").alias("k"))}
    for name, t in tables.items():
        counts = t.groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n")))).alias(name))  # a closed domain
        out = out.crossJoin(counts)
    return out


def _as_map(table: DataFrame, key: str, *values: str) -> DataFrame:
    value = F.struct(*values) if len(values) > 1 else F.col(values[0])
    return table.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), value.alias("value"))))).alias("m"))


def compute(accepted: DataFrame, rejected: DataFrame, vector: str | None = None) -> DataFrame:
    """One row. Diversity, lengths and entropies are of the accepted rows, rejects and retries of all."""
    every = accepted.unionByName(rejected)
    tokens = blank_tokens(rewrite_text())
    if vector:
        diversity = embedding_diversity(accepted, vector).select(F.struct("n", "diversity").alias("m"))
    else:
        diversity = bigram_jaccard_diversity(accepted, "id", tokens).select(F.struct("pairs", "diversity").alias("m"))
    one = lambda t: t.select(F.struct(*t.columns).alias("m"))
    parts = {
        "rows": one(every.agg(F.count_if("valid").alias("accepted"), F.count_if(~F.col("valid")).alias("rejected"), F.count(F.lit(1)).alias("total"))),
        "rewards": _as_map(rewards(accepted), "key", "mean", "p50", "p95", "n"), "diversity": diversity, "distinct_n": _as_map(distinct_n(accepted, tokens), "n", "ratio"),
        "entropies": _as_map(coverage_entropies(accepted), "field", "entropy"), "cultural_refs": one(cultural_refs(accepted)), "mapped_refs": one(mapped_refs(accepted)),
        "lengths": _as_map(lengths(accepted), "field", "mean", "p50", "p95", "n"), "rejects": _as_map(rejects(every), "rule", "n"), "retries": one(retries(every)),
    }
    out: DataFrame | None = None
    for name, t in parts.items():
        t = t.withColumnRenamed("m", name)
        out = t if out is None else out.crossJoin(t)  # one row each
    return out


def write_report(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)

