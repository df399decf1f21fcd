"""Cultural references to their counterparts: dictionary, then vectors, then a pluggable resolver for what is left."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.text import lookup_key, strip
from dialoom.functions.vectors import dot, norm
from dialoom.operators import mapping_checks
from dialoom.plans.schemas import MAPPED_REF

# Terms too generic to map; how near and how much nearer than the next a hit must be.
GENERIC = (
    "god", "heaven", "hell", "birthday", "wedding", "funeral", "anniversary", "dinner", "lunch", "breakfast", "brunch", "meal", "snack", "friend", "family", "mom", "dad",
    "brother", "sister", "parent", "weekend", "morning", "evening", "night", "phone", "car", "house", "school", "work", "office", "home", "holiday",
)
TOP, NEAR, MARGIN = 2, 0.78, 0.05
#: Bytes of the vector index that one broadcast may hold (beside the vectors 200 an entry are reckoned); rows of a tile of a larger one.
BROADCAST_BYTES, BLOCK = 32_000_000, 4_096

#: (term, type, context) -> the columns (ko, notes) for each row; rows with null ko count as unresolved.
Resolver = Callable[[DataFrame], DataFrame]


def without_generic(refs: Column) -> Column:
    return F.filter(refs, lambda r: ~F.lower(strip(r["term"])).isin(*GENERIC))


def context(term: Column, dialogue: Column) -> Column:
    """The first two turns that hold the term, as "speaker: text", with " | " between them."""
    hits = F.filter(dialogue, lambda t: F.contains(F.lower(t["text"]), F.lower(term)))
    return F.array_join(F.transform(F.slice(hits, 1, 2), lambda t: F.concat(t["speaker"], F.lit(": "), t["text"])), " | ")


def passage(en: Column, kind: Column, ko: Column) -> Column:
    """What is embedded of a dictionary entry."""
    return F.concat(en, F.lit(". A "), kind, F.lit(" referring to "), ko)


def search_text(term: Column, kind: Column, about: Column) -> Column:
    """What a web search is asked, with at most 150 characters of context."""
    near = F.replace(F.substring(F.coalesce(about, F.lit("")), 1, 150), F.lit('"'), F.lit("'"))
    return F.concat(F.lit('"'), term, F.lit('" '), kind, F.when(near != "", F.concat(F.lit(" "), near)).otherwise(""))


def build_index(entries: DataFrame, embed: Callable[[Column], Column]) -> DataFrame:
    """(entry columns, vector) of the entries without an error flag; vectors have unit length."""
    flags = mapping_checks.flags(F.col("en"), F.col("ko"), F.col("type"), F.col("notes"))
    clean = entries.where(~F.exists(flags, lambda f: f["severity"] == "error"))
    v = clean.withColumn("_v", embed(passage(F.col("en"), F.col("type"), F.col("ko"))))
    return v.withColumn("vector", F.transform("_v", lambda x: x / (norm(F.col("_v")) + 1e-9))).drop("_v")


def nearest(queries: DataFrame, index: DataFrame, key: str = "term", vector: str = "vector", top: int = 3, threshold: float = 0.65, order: str = "ord", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, rank, similarity, index columns): the `top` entries of each query at or above the threshold, by dot product, ties by `order`.

    The index's size in bytes is checked: up to broadcast_bytes it goes to every task, beyond that queries and index meet as tiles.
    """
    size = index.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size(vector)), F.lit(0)).alias("d")).first()
    best = Window.partitionBy(key).orderBy(F.desc("similarity"), F.col(order))
    if size["n"] * (8 * size["d"] + 200) <= broadcast_bytes:
        entries = index.withColumnRenamed(vector, "_iv")
        meet = queries.select(key, F.col(vector).alias("_qv")).join(F.broadcast(entries))
        found = meet.withColumn("similarity", dot(F.col("_qv"), F.col("_iv"))).where(F.col("similarity") >= threshold).drop("_qv", "_iv")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    found = tiled_hits(queries.select(F.col(key).alias("q"), F.col(vector).alias("v")), index.select(F.col(order).alias("o"), F.col(vector).alias("v")), top, threshold)
    few = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("similarity"), "o"))).where(F.col("rank") <= top)
    return few.withColumnRenamed("q", key).join(index.drop(vector), F.col("o") == F.col(order)).select(key, *[c for c in index.columns if c != vector], "similarity", "rank")


def tiled_hits(queries: DataFrame, index: DataFrame, top: int, threshold: float, block: int = BLOCK) -> DataFrame:
    """(q, o, similarity): of every tile the `top` entries (o, v) of each of its queries (q, v) at or above the threshold.

    Both sides are cut into slices along one fixed direction, and slices into tiles of about `block` rows by hash. With lengths up to a and b and
    a product of t, two vectors lie at most sqrt(a^2 + b^2 - 2t) apart, along any direction too: tiles whose slices are further apart never
    meet. The others do in a task of their own, as one matrix product; no key holds more than a tile of either side.
    """
    own = lambda rows, k: rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).select(k, F.transform("v", lambda x: x.cast("double")).alias("v"))
    length = lambda rows: rows.agg(F.coalesce(F.max(norm(F.col("v"))), F.lit(0.0))).first()[0]
    sides = {"q": own(queries, "q"), "o": own(index, "o")}
    far = {k: length(rows) for k, rows in sides.items()}
    reach = math.sqrt(max(0.0, far["q"] ** 2 + far["o"] ** 2 - 2 * threshold)) + 1e-6
    width = max(reach / 4, 1e-3, (far["q"] + far["o"]) / 1_000)  # a few hundred slices at most
    along = F.aggregate(F.transform("v", lambda x, i: x * F.sin(i + 1)), F.lit(0.0), lambda s, x: s + x) / F.sqrt(F.aggregate(F.transform("v", lambda x, i: F.pow(F.sin(i + 1), 2)), F.lit(0.0), lambda s, x: s + x))
    tiles, placed = {}, {}
    for k, rows in sides.items():
        sliced = rows.withColumn("slice", F.floor(along / width).cast("int"))
        cuts = sliced.groupBy("slice").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("cuts"))  # one row a slice
        tiles[k] = cuts.select(F.col("slice").alias(f"{k}_slice"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias(f"{k}_cut"))
        placed[k] = sliced.join(F.broadcast(cuts), "slice").select(F.col("slice").alias(f"{k}_slice"), F.pmod(F.xxhash64(k), F.col("cuts").cast("long")).cast("int").alias(f"{k}_cut"), k, "v")
    ask = tiles["q"].withColumn("o_slice", F.explode(F.expr(f"sequence(q_slice - {math.ceil(reach / width)}, q_slice + {math.ceil(reach / width)})")))
    pairs = ask.join(tiles["o"], "o_slice").withColumn("tile", F.struct("q_slice", "q_cut", "o_slice", "o_cut"))
    kinds = {k: rows.schema[k].dataType.simpleString() for k, rows in sides.items()}
    empty = {k: F.lit(None).cast(kind).alias(k) for k, kind in kinds.items()}
    dealt = pairs.join(placed["q"], ["q_slice", "q_cut"]).select("tile", "q", empty["o"], "v").union(pairs.join(placed["o"], ["o_slice", "o_cut"]).select("tile", empty["q"], "o", "v"))

    def product(part: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "o": [], "similarity": []}
        asked, entries = part[part["q"].notna()], part[part["q"].isna()].sort_values("o")
        for size in asked["v"].map(len).unique():
            a, b = (x[x["v"].map(len) == size] for x in (asked, entries))
            if not len(b):
                continue
            near = np.array(a["v"].tolist()) @ np.array(b["v"].tolist()).T
            first = np.argsort(-near, axis=1, kind="stable")[:, :top]  # entries are in order: ties go to the first
            row = np.repeat(np.arange(len(a)), first.shape[1])
            keep = near[row, first.ravel()] >= threshold
            out["q"] += a["q"].to_numpy()[row[keep]].tolist()
            out["o"] += b["o"].to_numpy()[first.ravel()[keep]].tolist()
            out["similarity"] += near[row, first.ravel()][keep].tolist()
        return pd.DataFrame({k: pd.Series(v, dtype=object if k != "similarity" else float) for k, v in out.items()})

    return dealt.groupBy("tile").applyInPandas(product, f"q {kinds['q']}, o {kinds['o']}, similarity double")


def clear_hits(hits: DataFrame, key: str = "term", margin: float = MARGIN) -> DataFrame:
    """The first hit of each key where it is the only one, or far enough before the second."""
    following = F.lead("similarity").over(Window.partitionBy(key).orderBy("rank"))
    return hits.withColumn("_next", following).where((F.col("rank") == 1) & (F.col("_next").isNull() | (F.col("similarity") - F.col("_next") >= margin))).drop("_next")


def map_terms(terms: DataFrame, entries: DataFrame, index: DataFrame | None = None, embed: Callable[[Column], Column] | None = None, resolve: Resolver | None = None) -> DataFrame:
    """(term, type, context) -> the same with `mapped` (MAPPED_REF or null). First hit wins: dictionary with the entry's type, vectors, resolver with the term's type.

    Each step sees only what the earlier ones left: the dictionary is joined by normal key, and only the rest is embedded or resolved.
    """
    keyed = terms.withColumn("key", lookup_key("term"))
    flat = entries.select("key", F.col("ko").alias("_ko"), F.col("type").alias("_type"), F.col("notes").alias("_notes"))
    found = keyed.join(flat, "key", "left")

    def ref(ko: Column, kind: Column, source: str, retrieved: bool, notes: Column) -> Column:
        none = F.array().cast("array<struct<code:string,severity:string,message:string>>")
        return F.struct(F.col("term").alias("term"), ko.alias("ko"), kind.alias("type"), F.lit(source).alias("source"), F.lit(retrieved).alias("retrieved"), F.coalesce(notes, F.lit("")).alias("notes"), none.alias("validation")).cast(MAPPED_REF)

    columns = terms.columns
    done = found.where("_ko is not null").select(*columns, ref(F.col("_ko"), F.col("_type"), "dict", False, F.col("_notes")).alias("mapped"))
    rest = found.where("_ko is null").select(*columns)
    if index is not None and embed is not None:
        words = rest.select("term").distinct().withColumn("_v", embed(F.col("term")))
        words = words.select("term", F.transform("_v", lambda x: x / (norm(F.col("_v")) + 1e-9)).alias("vector"))
        hits = clear_hits(nearest(words, index, top=TOP, threshold=NEAR)).select("term", F.col("ko").alias("_ko"), F.col("type").alias("_type"), F.col("notes").alias("_notes"))
        placed = rest.join(hits, "term", "left")
        done = done.unionByName(placed.where("_ko is not null").select(*columns, ref(F.col("_ko"), F.col("_type"), "retriever", True, F.col("_notes")).alias("mapped")))
        rest = placed.where("_ko is null").select(*columns)
    if resolve is not None:
        answers = resolve(rest.select("term", "type", "context").distinct()).select(F.struct("term", "type", "context").alias("_asked"), F.col("ko").alias("_ko"), F.col("notes").alias("_notes"))
        placed = rest.withColumn("_asks", F.struct("term", "type", "context")).join(answers, F.col("_asks").eqNullSafe(F.col("_asked")), "left").select(*columns, "_ko", "_notes")
        ko = F.coalesce(F.nullif(strip("_ko"), F.lit("")), F.col("term"))
        return done.unionByName(placed.select(*columns, ref(ko, F.col("type"), "web+llm", True, F.col("_notes")).alias("mapped")))
    return done.unionByName(rest.select(*columns, F.lit(None).cast(MAPPED_REF).alias("mapped")))


def map_refs(rows: DataFrame, entries: DataFrame, index: DataFrame | None = None, embed=None, resolve: Resolver | None = None, key: str = "id") -> DataFrame:
    """rows with mapped_refs: their cultural references without generic terms, in order, each through map_terms."""
    refs = without_generic(F.col("dialogue_decomposed.cultural_refs"))
    flat = rows.select(F.col(key).alias("_id"), F.col("source_dialogue").alias("_d"), F.posexplode(refs).alias("_pos", "_ref"))
    flat = flat.select("_id", "_pos", F.col("_ref.term").alias("term"), F.col("_ref.type").alias("type"), context(F.col("_ref.term"), F.col("_d")).alias("context"))
    mapped = map_terms(flat, entries, index, embed, resolve).where("mapped is not null")
    lists = mapped.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("_pos", "mapped"))).alias("_m"))
    out = rows.drop("mapped_refs").join(lists, F.col(key) == F.col("_id"), "left")
    return out.withColumn("mapped_refs", F.coalesce(F.transform("_m", lambda x: x["mapped"]), F.array().cast(f"array<{MAPPED_REF}>"))).drop("_id", "_m")
