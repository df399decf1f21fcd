"""JSON Lines in and out. Files are read and written by Spark's own readers, so any store that Spark knows will do."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.text import strip
from dialoom.plans.schemas import DDL, problems, schema, with_defaults


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, lineno from 1, value) with blank lines counted.

    Lines are numbered per file without gathering it in a task: a line's rank follows from the counts of the scan's earlier
    blocks of the same file, one row a block.
    """
    raw = spark.read.text(located(spark, path)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("_at"))
    counts = raw.groupBy("path", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("path", "block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    return raw.join(shift, ["path", "block"]).select("path", (F.col("_shift") + F.col("_at") - F.col("_first") + 1).cast("long").alias("lineno"), "value")


def parsed(lines: DataFrame, layer: str) -> DataFrame:
    row = F.from_json("value", schema(layer), {"mode": "PERMISSIVE"})
    whole = F.try_parse_json("value")
    text = lines.where(strip("value") != "").withColumn("_ok", F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False)))
    return text.withColumn("_row", row)


def read_rows(spark: SparkSession, path: str, layer: str) -> tuple[DataFrame, DataFrame]:
    """(good rows with `_lineno`, errors as (path, lineno, error)). Blank lines are passed over; a bad line never becomes a row."""
    lines = parsed(_lines(spark, path), layer)
    checked = lines.where("_ok").select("path", "lineno", "_row.*").withColumn("_problems", problems(layer))
    good = with_defaults(checked.where(F.size("_problems") == 0).withColumnRenamed("lineno", "_lineno"), layer, ["_lineno"])
    errors = checked.where(F.size("_problems") > 0).select("path", "lineno", F.array_join("_problems", "; ").alias("error"))
    errors = errors.union(lines.where("not _ok").select("path", "lineno", F.lit("not a JSON object").alias("error")))
    return good, errors


def read_strict(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Rows; the query fails with "path:lineno: error" at a bad line."""
    lines = parsed(_lines(spark, path), layer).select("path", "lineno", "_ok", "_row.*")
    found = F.when(~F.col("_ok"), F.lit("not a JSON object")).otherwise(F.nullif(F.array_join(problems(layer), "; "), F.lit("")))
    guard = F.when(found.isNotNull(), F.raise_error(F.concat_ws(":", "path", "lineno", F.concat(F.lit(" "), found))).cast("boolean")).otherwise(True)
    return with_defaults(lines.where(guard), layer)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(value: variant) of each line that holds an object; no rows where the path is missing."""
    from pyspark.errors import AnalysisException

    try:
        lines = spark.read.text(located(spark, path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(F.parse_json(F.lit("{}")).alias("value"))
    return lines.where(strip("value") != "").select(F.try_parse_json("value").alias("value")).where(F.schema_of_variant("value").startswith("OBJECT"))


def ids(spark: SparkSession, path: str, field: str = "id") -> DataFrame:
    """Distinct non-empty identifiers; malformed lines are passed over."""
    rows = read_objects(spark, path).select(F.try_variant_get("value", f"$.{field}", "string").alias("id"))
    return rows.where(F.col("id") != "").distinct()


def count_rows(spark: SparkSession, path: str) -> int:
    return spark.read.text(located(spark, path)).where(strip("value") != "").count()


def write_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line, nulls written. mode: overwrite or append."""
    to = located(df.sparkSession, path) if mode == "append" else path
    df.write.mode(mode).option("ignoreNullFields", "false").json(to)


def replace_rows(df: DataFrame, path: str) -> None:
    """Replace a queue that may be the source of df; an empty queue leaves no folder. At every moment readers find the old rows or the new."""
    new = _version(path)
    write_rows(df, new)
    swap(df.sparkSession, path, new)


def _version(path: str) -> str:
    return f"{path.rstrip('/')}.v-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    at = jvm.Path(path.rstrip("/"))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.Path, at


def _pointer(path: str) -> str:
    return f"{path.rstrip('/')}.current"


def located(spark: SparkSession, path: str) -> str:
    """Where the rows of a queue lie: the version that its pointer names, as long as that has not taken the queue's own place."""
    fs, make, _ = _files(spark, path)
    pointer = make(_pointer(path))
    if not fs.exists(pointer):
        return path
    stream = fs.open(pointer)
    try:
        named = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return named if fs.exists(make(named)) else path


def swap(spark: SparkSession, path: str, new: str) -> None:
    """The folder `new` takes the place of `path`. The pointer goes over to it in one rename, last of what readers see; only then does the old
    folder go. A run that breaks off before has changed nothing, one that breaks off later is finished by the next swap."""
    fs, make, at = _files(spark, path)
    old, pointer, fresh = located(spark, path), make(_pointer(path)), make(f"{_pointer(path)}-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(new.encode()))
    out.close()
    gateway = spark.sparkContext._gateway
    options = gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(pointer), options)
    _settle_swap(fs, make, at, old, new, count_rows(spark, new) == 0)


def _settle_swap(fs, make, at, old: str, new: str, empty: bool) -> None:
    """Readers are with `new`: the old rows go, and the new ones move to the queue's own place."""
    for gone in {old, at.toString()}:
        fs.delete(make(gone), True)
    if empty:
        fs.delete(make(new), True)
    else:
        fs.rename(make(new), at)
    fs.delete(make(_pointer(at.toString())), False)


def repair(spark: SparkSession, path: str) -> int:
    """Cut every file of a folder before its first malformed line, as a writer that was torn off leaves it, and swap the result in. Returns
    how many lines that are not blank went. Lines are placed by file and block, so no file passes through one task."""
    lines = _lines(spark, located(spark, path)).where(strip("value") != "")
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    bad = lines.where(~whole).groupBy("path").agg(F.min("lineno").alias("_bad"))
    if not bad.limit(1).count():
        return 0
    new = _version(path)
    met = lines.join(bad, "path", "left")
    met.where(F.col("_bad").isNull() | (F.col("lineno") < F.col("_bad"))).select("value").write.text(new)
    gone = met.where(F.col("lineno") >= F.col("_bad")).count()
    swap(spark, path, new)
    return gone


def staged_dataset(df: DataFrame, name: str, limit: int | None = None, dialogue: str = "dialogue", speakers: str = "speakers", narrative: str = "narrative", position: str = "position") -> DataFrame:
    """Raw rows of a staged data set. `limit` counts positions in the source, so rows that are then left out for want of dialogue or
    speakers still count; identifiers are name-position."""
    short = name.split(":")[0].split("/")[-1]
    rows = df if limit is None else df.where(F.col(position) < limit)
    rows = rows.where((F.size(dialogue) > 0) & (F.size(speakers) > 0))
    return rows.select(F.concat(F.lit(f"{short}-"), F.col(position).cast("string")).alias("id"), F.col(position).cast("long").alias("original_index"), F.col(dialogue).alias("dialogue"), F.col(speakers).alias("speakers"), F.coalesce(F.col(narrative), F.lit("")).alias("narrative"))


LAYERS = tuple(DDL)
