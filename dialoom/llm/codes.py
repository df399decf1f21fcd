"""Product codes of vectors by exact k-means on whole numbers, with the parts of a block in heaps by how far their bounds reach.

Defined results: rows without a vector, or whose vector holds null or non-finite components or ones that scaled exceed MOST in size, are
dropped. Rows without an identifier or label are kept (identifiers that are null come last, null labels are one label). Repeated rows all
count. Ties go to the lower entry. Vectors of another size are a collection of their own, with codebooks of their own; a size that the parts do not
divide is filled up with zeros, and a vector without components has the first entry everywhere. Below `entries` vectors there are as many
entries as vectors. An empty table gives no rows. Further columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import Bucketed, balanced_join, scratch_path, scratch_scope, settle, table

#: Rows of a block at most; bytes of vectors of a bucket, about; greatest scaled component.
BLOCK, BUCKET_BYTES, MOST = 4096, 32 << 20, 1 << 24
#: Bounds are doubles: parts whose slack is within this of the drift are looked at again.
MARGIN = 1e-3

Books = dict[int, np.ndarray]


def whole(x: Column, scale: int) -> Column:
    return F.floor(x.cast("double") * scale)


def usable(vector: str, scale: int) -> Column:
    inside = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= MOST / scale), F.lit(False)))
    return F.coalesce(F.col(vector).isNotNull() & inside, F.lit(False))


def in_parts(flat: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, width) of rows of components, filled up with zeros."""
    rows, dim = flat.shape
    width = -(-dim // parts)
    return np.pad(flat, ((0, 0), (0, width * parts - dim))).reshape(rows, parts, width)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(rows, entries): exact squared distances, as products of doubles where these are exact, else of 64-bit integers."""
    top = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if 4 * max(1, x.shape[1]) * float(top) ** 2 < 2**53 else np.int64
    x, book = x.astype(kind), book.astype(kind)
    return ((x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)[None]).astype(np.int64)


class Heaps:
    """The rows of a block in one heap for each entry of one part: `keys` of rows `order`, entry e has those from starts[e] to starts[e + 1].

    A key is the bound of the distance to the second-nearest entry less that to the own one (lower less upper), plus the drift of the own
    entry when the key was made. The drift of an entry grows each round by its own move and the greatest move of another; while it is
    below the key, no other entry can be as near. So rows of a heap whose key the drift has reached are at its top. Heaps
    are arrays in ascending order: what is popped is a prefix, what is pushed is merged.
    """

    def __init__(self, order: np.ndarray, keys: np.ndarray, starts: np.ndarray):
        self.order, self.keys, self.starts = order, keys, starts

    @classmethod
    def unseen(cls, rows: int) -> Heaps:
        """All rows in one heap, with keys below any drift."""
        return cls(np.arange(rows, dtype=np.int32), np.full(rows, -np.inf), np.array([0, rows], np.int32))

    def pop(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Rows whose bounds the drift has violated, their entries, and what is left of each heap."""
        popped, entries, left = [], [], []
        for e, (a, b) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            cut = a + np.searchsorted(self.keys[a:b], drift[e] + MARGIN, "right")
            popped.append(self.order[a:cut])
            entries.append(np.full(cut - a, e))
            left.append((self.order[cut:b], self.keys[cut:b]))
        return np.concatenate(popped), np.concatenate(entries), left

    @classmethod
    def pushed(cls, left: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray, entries: np.ndarray, keys: np.ndarray) -> Heaps:
        order, merged = [], []
        for e, (own, own_keys) in enumerate(left):
            new = np.flatnonzero(entries == e)
            new = new[np.argsort(keys[new], kind="stable")]
            at = np.searchsorted(own_keys, keys[new])
            order.append(np.insert(own, at, rows[new]))
            merged.append(np.insert(own_keys, at, keys[new]))
        starts = np.concatenate([[0], np.cumsum([len(o) for o in order])])
        return cls(np.concatenate(order).astype(np.int32), np.concatenate(merged), starts.astype(np.int32))

    def nearest(self) -> np.ndarray:
        """The entry of each row."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        return out


def assign(x: np.ndarray, heaps: Heaps | None, book: np.ndarray, drift: np.ndarray) -> tuple[Heaps, np.ndarray, int]:
    """One part's rows (rows, width) at their nearest entries: the heaps after it, changes of (entries, width + 1: sums and counts), and
    how many rows were scanned."""
    first = heaps is None
    if first:
        rows, _, _ = Heaps.unseen(len(x)).pop(np.zeros(1))
        left = [(np.zeros(0, np.int32), np.zeros(0))] * len(book)
        was = np.full(len(rows), -1)
    else:
        rows, was, left = heaps.pop(drift)
    d = distances(x[rows], book)
    now = d.argmin(1)  # the lowest of equals
    best = d[np.arange(len(rows)), now]
    d[np.arange(len(rows)), now] = np.iinfo(np.int64).max
    second = d.min(1, initial=np.iinfo(np.int64).max)
    slack = np.where(second == np.iinfo(np.int64).max, np.inf, np.sqrt(second.astype(float)) - np.sqrt(best.astype(float)))
    change = np.zeros((len(book), x.shape[1] + 1), np.int64)
    moved = now != was
    values = np.column_stack([x[rows[moved]], np.ones(moved.sum(), np.int64)])
    np.add.at(change, now[moved], values)
    if not first:
        np.add.at(change, was[moved], -values)
    return Heaps.pushed(left, rows, now, slack + drift[now]), change, len(rows)


def replaced(book: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(parts, entries, width) after a round; sums: (parts, entries, width + 1)."""
    counts = sums[..., -1:]
    return np.where(counts > 0, sums[..., :-1] // np.maximum(counts, 1), book)


def drifted(drift: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """(parts, entries): the drift after a move of the entries."""
    moves = np.sqrt(((after - before).astype(float) ** 2).sum(2))
    others = np.array([[np.delete(row, e).max(initial=0) for e in range(len(row))] for row in moves]).reshape(moves.shape)
    return drift + moves + others


def digest(books: Books) -> str:
    """Of all entries' components, by size of vectors, part, entry and position."""
    return hashlib.sha256(",".join(str(c) for dim in sorted(books) for c in books[dim].ravel().tolist()).encode()).hexdigest()


def _matrix(row: dict, parts: int, kind: str, scale: int) -> np.ndarray:
    x = np.frombuffer(row["x"], kind).reshape(row["rows"], row["dim"])
    return in_parts(np.floor(x.astype(np.float64) * scale).astype(np.int64), parts)


def _heaps(row: dict, rows: int, parts: int) -> list[Heaps]:
    order, keys = np.frombuffer(row["order"], np.int32).reshape(parts, rows), np.frombuffer(row["keys"]).reshape(parts, rows)
    starts = np.frombuffer(row["starts"], np.int32).reshape(parts, -1)
    return [Heaps(*h) for h in zip(order, keys, starts)]


def in_blocks(rows: DataFrame, kind: str, block: int) -> DataFrame:
    """(block, dim, rows, ids, labels, x: components as bytes) of rows (id, label, v), as they lie in partitions."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = 0
        held: dict[int, list[pa.RecordBatch]] = {}

        def close(dim: int) -> pa.RecordBatch:
            nonlocal made
            own = pa.Table.from_batches(held.pop(dim)).combine_chunks()
            made += 1
            flat = own["v"].combine_chunks().flatten() if len(own) else pa.array([])
            x = flat.to_numpy(zero_copy_only=False).astype(kind).tobytes()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own[c].combine_chunks()) for c in ("id", "label")]
            number = (TaskContext.get().partitionId() << 32) + made
            return pa.record_batch([pa.array([number]), pa.array([dim], pa.int32()), pa.array([len(own)], pa.int32()), *lists, pa.array([x], pa.binary())], names=["block", "dim", "rows", "ids", "labels", "x"])

        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                own = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                while len(own):
                    room = block - sum(map(len, held.get(dim, [])))
                    held.setdefault(dim, []).append(own.slice(0, room))
                    own = own.slice(room)
                    if sum(map(len, held[dim])) >= block:
                        yield close(dim)
        for dim in list(held):
            yield close(dim)

    return rows.mapInArrow(cut, f"block long, dim int, rows int, ids array<{fields['id']}>, labels array<{fields['label']}>, x binary")


STATE = "block long, order binary, keys binary, starts binary, scanned long, dim int, changes array<long>"


def stepped(books: Books, drift: Books, parts: int, kind: str, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One round over blocks and, but for the first round, their heaps: rows of STATE."""
    fields = [("block", pa.int64()), ("order", pa.binary()), ("keys", pa.binary()), ("starts", pa.binary()), ("scanned", pa.int64()), ("dim", pa.int32()), ("changes", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                done = _assigned(row, books[row["dim"]], drift[row["dim"]], parts, kind, scale)[1]
                heaps = [h for h, _, _ in done]
                out = {
                    "block": row["block"], "order": b"".join(h.order.tobytes() for h in heaps), "keys": b"".join(h.keys.tobytes() for h in heaps), "starts": b"".join(h.starts.tobytes() for h in heaps),
                    "scanned": sum(n for _, _, n in done), "dim": row["dim"], "changes": np.concatenate([c.ravel() for _, c, _ in done]).tolist(),
                }
                yield pa.RecordBatch.from_pylist([out], pa.schema(fields))

    return run


def _assigned(row: dict, book: np.ndarray, drift: np.ndarray, parts: int, kind: str, scale: int) -> tuple[np.ndarray, list[tuple[Heaps, np.ndarray, int]]]:
    x = _matrix(row, parts, kind, scale)
    held = _heaps(row, len(x), parts) if "order" in row else [None] * parts
    return x, [assign(x[:, p], held[p], book[p], drift[p]) for p in range(parts)]


def coded(books: Books, drift: Books, parts: int, kind: str, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last assignment: (id, label, code, error) of every row of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.drop_columns(["ids", "labels"]).to_pylist()):
                book = books[row["dim"]]
                x, done = _assigned(row, book, drift[row["dim"]], parts, kind, scale)
                near = np.column_stack([h.nearest() for h, _, _ in done])
                error = sum(((x[:, p] - book[p][near[:, p]]) ** 2).sum(1) for p in range(parts))
                text = near.astype(">u1" if book.shape[1] <= 256 else ">u2").tobytes().hex()
                step = len(text) // len(x)
                codes = pa.array([text[k : k + step] for k in range(0, len(text), step)])
                yield pa.record_batch([batch.column("ids")[i].values, batch.column("labels")[i].values, codes, pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    return run


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, at, x): the sums of a task's changes, by size and place."""
    total: Books = {}
    for batch in batches:
        for dim, changes in zip(batch.column("dim").to_pylist(), batch.column("changes")):
            total[dim] = total.get(dim, 0) + changes.values.to_numpy()
    for dim, x in total.items():
        yield pa.record_batch([pa.array(np.full(len(x), dim), pa.int32()), pa.array(np.arange(len(x)), pa.int64()), pa.array(x)], names=["dim", "at", "x"])


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, key: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of each kept row.

    Components become floor(scale * x), a vector `parts` equal consecutive parts. Codebooks start as the parts of the `entries` smallest
    identifiers; each round assigns every part to its nearest entry and replaces entries by floor(sum / count). Blocks of vectors are
    written once, in buckets; the heaps of a block are a second table in the same buckets, so that a round reads both without an
    exchange, scans only the parts whose bounds the entries' drift has violated, and writes heaps and the changes of sums. Only sums
    (parts x entries x width numbers) and codebooks reach the driver. A lost executor costs its buckets of the round at hand.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")).where(usable("v", scale))
    kind = "<f8" if "double" in rows.schema["v"].dataType.simpleString() else "<f4" if "float" in rows.schema["v"].dataType.simpleString() else "<i8"
    rows = rows.withColumn("dim", F.size("v"))
    first = Window.partitionBy("dim").orderBy(F.asc_nulls_last("id"), "v")
    seeds = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= entries).select("dim", "n", F.transform("v", lambda x: whole(x, scale)).alias("v"))
    start: dict[int, list[list[int]]] = {}
    for r in seeds.orderBy("dim", "n").collect():  # so many rows for each size
        start.setdefault(r["dim"], []).append(r["v"])
    books: Books = {d: in_parts(np.array(v, np.int64).reshape(len(v), d), parts).transpose(1, 0, 2) for d, v in start.items()}
    drift: Books = {d: np.zeros(b.shape[:2]) for d, b in books.items()}
    cells = rows.agg(F.sum(F.col("dim").cast("long")).alias("n")).first()["n"] or 0
    buckets = max(spark.sparkContext.defaultParallelism, -(-int(cells) * 8 // BUCKET_BYTES))

    result = scratch_path(spark, "codes")
    with scratch_scope(spark):
        tables = Bucketed(spark, "block", buckets)
        names = []

        def kept(df: DataFrame, tag: str) -> DataFrame:
            name, own = tables.write(df, tag)
            names.append(name)
            return own

        blocks = kept(in_blocks(rows.select("id", "label", "v"), kind, block).repartition(buckets, "block"), "vector-blocks")
        met = blocks
        sums: Books = {}
        for _ in range(rounds if books else 0):
            heaps = kept(met.drop("ids", "labels").mapInArrow(stepped(books, drift, parts, kind, scale), STATE), "heaps")
            got: Books = {d: np.zeros((*b.shape[:2], b.shape[2] + 1), np.int64) for d, b in books.items()}
            for r in heaps.select("dim", "changes").mapInArrow(summed, "dim int, at long, x long").groupBy("dim", "at").agg(F.sum("x").alias("x")).collect():
                got[r["dim"]].reshape(-1)[r["at"]] = r["x"]  # a number for each part, entry and component
            sums = {d: got[d] + sums.get(d, 0) for d in got}
            after = {d: replaced(b, sums[d]) for d, b in books.items()}
            still = all((after[d] == books[d]).all() for d in books)
            drift = {d: drifted(drift[d], books[d], after[d]) for d in books}
            books = after
            met = blocks.join(heaps.select("block", "order", "keys", "starts").hint("shuffle_hash"), "block")
            if len(names) > 2:  # the heaps before these are read no more
                tables.drop(names.pop(1))
            if still:
                break  # nothing moves any more
        fields = {f.name: f.dataType.simpleString() for f in rows.schema}
        found = met.mapInArrow(coded(books, drift, parts, kind, scale), f"id {fields['id']}, label {fields['label']}, code string, error long")
        out = settle(found, "codes", result)
        for name in names:
            tables.drop(name)
    own = F.when(F.col("label").isNull(), "").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))  # null labels together
    out = out.withColumn("_label", own)
    errors = out.groupBy("_label").agg(F.sum("error").alias("label_error"))
    both = balanced_join(out, errors, "_label")
    return both.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same by brute force: a table of codebooks and one of assignments for each round."""
    out = [
        f"""with k as materialized (select vec_id, label, [floor({scale} * x::double)::bigint for x in embedding] as v from embeddings
    where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0)""",
        f"p as materialized (select vec_id, i as part, v[i * (len(v) // {parts}) + 1 : (i + 1) * (len(v) // {parts})]::double[] as q from k, range({parts}) t(i))",
        f"s as (select vec_id, row_number() over (order by vec_id) - 1 as e from k order by vec_id limit {entries})",
        "b0 as materialized (select part, e, q from s join p using (vec_id))",
    ]
    for r in range(rounds + 1):
        out.append(f"a{r} as materialized (select p.vec_id, p.part, min(struct_pack(d := list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.q, b.q)])::bigint, e := b.e)) as n from p join b{r} b using (part) group by all)")
        if r < rounds:
            out.append(f"u{r} as (select part, e, list(m order by pos) as q from (select part, n.e as e, pos, floor(sum(q[pos]) / count(*)) as m from a{r} join p using (vec_id, part), range(1, len(q) + 1) t(pos) group by all) group by all)")
            out.append(f"b{r + 1} as materialized (select part, e, coalesce(u.q, b.q) as q from b{r} b left join u{r} u using (part, e))")
    out.append(f"h as (select sha256(string_agg(c::bigint::varchar, ',' order by part, e, pos)) as codebooks_sha256 from (select part, e, unnest(q) as c, generate_subscripts(q, 1) as pos from b{rounds}))")
    out.append(f"c as (select vec_id, string_agg(printf('%02x', n.e), '' order by part) as code, sum(n.d)::bigint as error from a{rounds} group by all)")
    return ",\n    ".join(out) + "\n    select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from c join k using (vec_id), h"


QUERIES = {"op11_vector_codes": op11_vector_codes}
SQL = {"op11_vector_codes": _sql()}
