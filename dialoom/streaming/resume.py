"""Files that arrive one after another, validated batch by batch; a restarted stream goes on where its checkpoint stands."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dialoom.plans.schemas import problems, with_defaults
from dialoom.sources import jsonl


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the lines of JSON Lines files."""
    return spark.readStream.text(folder)


def first_line(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The least line of a key that has not been seen before; the state is that it has."""
    least = min(b["value"].min() for b in batches)
    if not state.exists:
        state.update((True,))
        yield pd.DataFrame({"value": [least]})


def uncommitted(spark: SparkSession, checkpoint: str) -> int | None:
    """The batch that a stopped run had planned and not committed: it runs again first."""
    jvm = spark._jvm.org.apache.hadoop.fs
    last = {}
    for kind in ("offsets", "commits"):
        at = jvm.Path(f"{checkpoint.rstrip('/')}/{kind}")
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        last[kind] = max((int(n) for n in names if n.isdigit()), default=-1)
    return last["offsets"] if last["offsets"] > last["commits"] else None


def validated(spark: SparkSession, folder: str, layer: str, out: str, checkpoint: str, step: Callable[[DataFrame], DataFrame], key: str = "id") -> StreamingQuery:
    """Every row goes through `step` once and to `out`.

    Which keys have been seen is the stream's keyed state: a batch costs what it holds, however much there is already. The output itself is
    looked up with two batches only: the first of all, for what other writers had put there, and one that a stopped run had begun and not
    committed, so that a batch which runs twice adds nothing. Of rows with one key in a batch the one whose line is
    least counts. Lines that are no objects of the layer go to `out`-errors with what is wrong.
    """
    lines = jsonl.parsed(stream_lines(spark, folder), layer)
    checked = lines.where("_ok").select("value", "_row.*").withColumn("_problems", problems(layer))
    wrong = checked.where(F.size("_problems") > 0).select("value", F.array_join("_problems", "; ").alias("error"))
    wrong = wrong.union(lines.where("not _ok").select("value", F.lit("not a JSON object").alias("error")))
    good = checked.where((F.size("_problems") == 0) & F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_key"), "value")
    fresh = good.groupBy("_key").applyInPandasWithState(first_line, "value string", "seen boolean", "append", GroupStateTimeout.NoTimeout)
    both = fresh.withColumn("error", F.lit(None).cast("string")).union(wrong)

    again = uncommitted(spark, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = with_defaults(jsonl.parsed(batch.where("error is null").select("value"), layer).select("_row.*"), layer)
        if number in (0, again):
            done = jsonl.ids(session, out, key).select(F.col("id").alias("_done"))
            rows = rows.join(done, F.col(key) == F.col("_done"), "left_anti")
        jsonl.write_rows(batch.where("error is not null").withColumn("batch", F.lit(number)), f"{out.rstrip('/')}-errors/batch={number}")
        jsonl.write_rows(step(rows), out, "append")

    return both.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
