"""What the corpus operators share: reading tables, shared scratch tables, graph components, distributed ranks."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _files(spark: SparkSession, path: str):
    """(the file system of the path as Spark sees it, the path as Hadoop's)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system, so that tasks which open files themselves find the store that Spark writes to."""
    files, at = _files(spark, path)
    return files.makeQualified(at).toString()


def shared_root(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; a new temporary one only where none is set and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not context.getCheckpointDir():
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="dialoom-"))
        root = context.getCheckpointDir()
    return qualified(spark, root.rstrip("/"))


class _Scopes(threading.local):
    """Open scopes of this thread, innermost last: paths and names of tables that go when a scope ends."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_scopes = _Scopes()
_applications: set[str] = set()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that this thread makes within are deleted at the end; what is still needed must have been written elsewhere by then."""
    own: list[str] = []
    _scopes.open.append(own)
    try:
        yield
    finally:
        _scopes.open.remove(own)
        for path in own:
            remove(spark, path)


def scratch_folder(spark: SparkSession) -> str:
    """Where this application's scratch tables lie. It is deleted when the driver ends: a lazy result may read them until then."""
    context = spark.sparkContext
    folder = f"{shared_root(spark)}/dialoom-{context.applicationId}"
    if folder not in _applications:
        _applications.add(folder)
        atexit.register(_clear, spark, folder)
    return folder


def _clear(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session was stopped before
        with suppress(Exception):
            remove(spark, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application. Results that have not been written yet can't be read afterwards."""
    remove(spark, scratch_folder(spark))


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{scratch_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    if _scopes.open:
        _scopes.open[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def settle(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = path or scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Bucketed:
    """Scratch tables in equal buckets of one key: joined on the key, each task reads one bucket of both, and nothing is exchanged."""

    def __init__(self, spark: SparkSession, key: str, buckets: int):
        self.spark, self.key, self.buckets = spark, key, buckets

    def write(self, df: DataFrame, tag: str) -> tuple[str, DataFrame]:
        """(name, table). Rows that come from a bucketed table lie in their bucket already; others are best dealt before."""
        name = f"dialoom_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, self.key).option("path", scratch_path(self.spark, tag)).saveAsTable(name)
        return name, self.spark.table(name)

    def drop(self, name: str) -> None:
        """Files go with the scope."""
        self.spark.sql(f"drop table if exists {name}")


def crc_mod(column: str, n: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    """(_t, _y): one row for each of at most `sample` labelled identifiers, those of the least hash. Of several labels of an identifier the
    least counts, of several rows the text of the least hash; so no more than `sample` rows are kept, however often an identifier repeats."""
    known = labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y")).where("_k is not null and _y in (0, 1)").groupBy("_k").agg(F.min("_y").alias("_y"))
    known = known.orderBy(F.xxhash64("_k"), "_k").limit(sample)
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(known), "_k")
    return rows.groupBy("_k", "_y").agg(F.min(F.struct(F.xxhash64("_t").alias("h"), F.col("_t").alias("t"))).alias("s")).select(F.col("s.t").alias("_t"), "_y")


def boxed(docs: DataFrame, **named: Column) -> DataFrame:
    """(_row: all columns of docs as one struct, and the named columns): working columns never meet columns of the input."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *[c.alias(n) for n, c in named.items()])


def literal_rows(spark: SparkSession, json_text: str, ddl: str) -> DataFrame:
    """A small table from a JSON array, planned on the JVM alone."""
    rows = spark.range(1).select(F.explode(F.from_json(F.lit(json_text), f"array<struct<{ddl}>>")).alias("r"))
    return rows.select("r.*")


#: Keys that are treated apart in a balanced join. Every other key has at most this part of the rows.
HUBS = 1_000


def most_frequent(rows: DataFrame, key: str) -> DataFrame:
    """The HUBS most frequent values of key, of those that repeat: a table of that many rows at most."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return counts.orderBy(F.desc("_n"), key).limit(HUBS).select(key)


def balanced_join(rows: DataFrame, lookup: DataFrame, key: str, hubs: DataFrame | None = None) -> DataFrame:
    """rows joined with `lookup`, whose key is unique, however often a key occurs in rows: the most frequent keys (at most HUBS) meet
    their lookup rows as a broadcast of at most HUBS rows, all others by a shuffle in which no key has more than 1 / HUBS of the rows."""
    hubs = F.broadcast(hubs if hubs is not None else most_frequent(rows, key))
    columns = [*rows.columns, *(c for c in lookup.columns if c != key)]
    few = rows.join(F.broadcast(lookup.join(hubs, key, "left_semi")), key).select(*columns)
    return few.union(rows.join(hubs, key, "left_anti").join(lookup, key).select(*columns))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached, for every id in edges (src, dst: long).

    Each round takes the least label among the neighbours and the label of the own label, so that paths shorten by doubling.
    Hubs and large components are keys of balanced joins. A round leaves one table; that of the round before is deleted.
    """
    spark = edges.sparkSession
    both = edges.where("src <> dst").select("src", "dst")
    both = settle(both.union(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    hubs = settle(most_frequent(both, "dst"), "hubs")
    path = scratch_path(spark, "labels")
    label = settle(both.groupBy(F.col("src").alias("id")).agg(F.least(F.min("dst"), F.first("src")).alias("component")), "labels", path)
    while True:
        near = balanced_join(both, label.withColumnRenamed("id", "dst"), "dst", hubs).groupBy(F.col("src").alias("id")).agg(F.min("component").alias("near"))
        root = label.select(F.col("id").alias("component"), F.col("component").alias("root"))
        step = balanced_join(label, root, "component").join(near, "id")
        step = step.select("id", F.col("component").alias("was"), F.least("component", "near", "root").alias("component"))
        before, path = path, scratch_path(spark, "labels")
        step = settle(step, "labels", path)
        remove(spark, before)
        label = step.select("id", "component")
        if step.where("component <> was").limit(1).count() == 0:
            return label


def spread_rank(df: DataFrame, group: list[str], order: Column, bucket: Column, name: str) -> DataFrame:
    """df with `name`: the exact rank from 0 of each row within its group, though no task sees a whole group.

    `bucket` is a non-negative int that is monotone in `order`; a group's rows lie over its buckets. Rows are ranked within
    (group, bucket) and shifted by the counts of the earlier buckets, a table of one row a bucket.
    """
    # the group as one string that is never null, so that the window and the join share one exchange
    rows = df.withColumn("_bucket", bucket).withColumn("_group", F.to_json(F.struct(*group), {"ignoreNullFields": "false"}))
    counts = rows.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_group", "_bucket").orderBy(order)
    rows = rows.withColumn("_place", F.row_number().over(inside) - 1)
    return rows.join(counts, ["_group", "_bucket"]).select(*df.columns, (F.col("_place") + F.col("_shift")).cast("long").alias(name))
