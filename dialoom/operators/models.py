"""Models as pluggable functions on columns or tables, with deterministic stand-ins that need no network.

A model that is a Python callable becomes a pandas UDF, marked non-deterministic so that Spark never runs a call twice for one row; its
rows are filtered before, never inside a CASE, and its results are persisted by the caller before they are used twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.vectors import hash_embedding
from dialoom.plans.schemas import AXES


def scalar_model(call: Callable[[list[str]], list], kind: str) -> Callable[[Column], Column]:
    """A function of a batch of texts as a function of a column."""

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(call(b.tolist()))

    return run.asNondeterministic()


def client_model(make: Callable[[], Callable[[dict], dict]], kind: str, tasks: int | None = None, threads: int = 4) -> Callable[[DataFrame], DataFrame]:
    """A remote model on whole rows: `make` builds a client once a task; up to `threads` calls run at once in a task, and `tasks` bounds
    the tasks. `kind` is the schema of what a call adds; an exception becomes its `failure`."""

    def apply(df: DataFrame) -> DataFrame:
        names = [f.split()[0] for f in kind.split(",")]
        base = df.withColumn("_row", F.to_json(F.struct(*df.columns)))
        slim = base.repartition(tasks) if tasks else base

        @F.pandas_udf(f"{kind}, failure string")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            import json
            from concurrent.futures import ThreadPoolExecutor

            client = make()

            def one(row: str) -> dict:
                try:
                    return client(json.loads(row)) | {"failure": None}
                except Exception as e:  # noqa: BLE001  a failed call is a result
                    return dict.fromkeys(names) | {"failure": f"{type(e).__name__}: {e}"}

            with ThreadPoolExecutor(threads) as pool:
                for b in batches:
                    yield pd.DataFrame(list(pool.map(one, b)), columns=[*names, "failure"])

        got = slim.withColumn("_got", run.asNondeterministic()("_row"))
        return got.select(*df.columns, "_got.*")

    return apply


# ---- stand-ins


def embed(x: Column) -> Column:
    return hash_embedding(x)


def always_safe(x: Column) -> Column:
    return F.lit(True)


def safety_verdict(x: Column) -> Column:
    """Of a safety model's JSON answer: unsafe if it is none, or if a key that begins with S says yes."""
    fields = F.from_json(x, "map<string,string>")
    bad = F.exists(F.map_entries(fields), lambda e: e["key"].startswith("S") & F.contains(F.lower(e["value"]), F.lit("yes")))
    return F.coalesce(F.try_parse_json(x).isNotNull() & fields.isNotNull() & ~bad, F.lit(False))


def fixed_judge(score: int | dict[str, int] = 5, reward: float = 4.0) -> Callable[[DataFrame], DataFrame]:
    own = score if isinstance(score, dict) else dict.fromkeys(AXES, score)
    axes = F.create_map(*[F.lit(x) for kv in own.items() for x in kv]).cast("map<string,int>")
    none = F.lit(None).cast("string")
    gain = F.create_map(F.lit("correctness"), F.lit(reward), F.lit("coherence"), F.lit(reward))
    return lambda df: df.withColumns({"axes": axes, "reasoning": F.create_map().cast("map<string,string>"), "reward": gain, "judge_error": none, "reward_error": none})


def hash_judge(df: DataFrame) -> DataFrame:
    """Scores from 2 to 5 out of the row's id."""
    axes = F.map_from_entries(F.array(*[F.struct(F.lit(a), (2 + F.conv(F.substring(F.md5(F.concat(F.col("id"), F.lit(a)).cast("binary")), 1, 2), 16, 10).cast("int") % 4).cast("int")) for a in AXES]))
    return fixed_judge()(df).withColumn("axes", axes)


def echo_generator(df: DataFrame) -> DataFrame:
    """A payload that repeats the source's turns."""
    turns = F.to_json(F.transform("source_dialogue", lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text"))))
    return df.withColumns({"payload": F.parse_json(turns), "failure": F.lit(None).cast("string")})


def offline_search(term: Column) -> Column:
    """array<struct<title,content,url>>: one placeholder, as a search that has no key."""
    return F.array(F.struct(F.concat(F.lit("no search: "), term).alias("title"), F.lit("").alias("content"), F.lit("").alias("url")))
