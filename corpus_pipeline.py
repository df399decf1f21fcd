"""A training corpus from the documents table: good documents, one of each group of near-duplicates, without secrets, mixed and packed.

Every stage takes and returns the columns of documents, the last one pieces of packed sequences. Stages are written to the
cluster's shared folder and read back, so that a lost executor costs at most the stage at hand.

Defined results: a null text is empty to every stage; texts without words or empty are scored, never link and are one piece, the end
mark; of equal rows of an identifier one stays, rows without identifier all stay; very long texts go through whole; an empty table gives
no rows; further columns of any name are carried by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import mixing, neardup, packing, quality, secrets
from dialoom.llm.common import remove, scratch_path, scratch_scope, settle, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-labelling field takes for bad go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the least doc_id."""
    return neardup.keep_one(docs)


def safe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to the name of their kind; n_chars follows."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of sources."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences, each with the place of its document in the mixture.

    The mixture is the order of the rows in the files that the stage before has written: part, then row. Pieces of a length are placed
    in this order, and sequences are numbered by their earliest piece, so that reading them in order follows the mixture.
    """
    file = docs.metadataColumn("_metadata")  # Spark's own, whatever columns docs has
    name = F.regexp_extract(file["file_name"], r"part-(\d+)", 1).cast("long")
    chunk = F.coalesce(F.regexp_extract(file["file_name"], r"-c(\d+)\.", 1).try_cast("long"), F.lit(0))
    place = F.shiftleft(name, 40) + F.shiftleft(chunk, 32) + file["row_index"]
    return packing.pack(docs.select("doc_id", "text", place.alias("mixture_place")), carry="mixture_place", in_order=True)


STAGES = [("quality", good), ("near_dedup", single), ("secrets", safe), ("mixing", mixed), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. A stage's table is deleted when the next one is written; the last stage's own lasts as the session's
    scratch tables do."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):  # what a stage has written on its way goes with it
            docs = settle(stage(spark, docs, sf_dir), name, path)
        if before:
            remove(spark, before)
        before = path
    out = scratch_path(spark, "pipeline-packing")
    with scratch_scope(spark):
        pieces = settle(STAGES[-1][1](spark, docs, sf_dir), "packing", out)
    remove(spark, before)
    return pieces
