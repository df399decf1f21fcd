"""The dictionary of cultural terms: a JSON object of entries keyed by term, or a table of the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.text import lookup_key

ENTRY = "ko string, type string, notes string, source string, approximate boolean, keep boolean, reviewed boolean"
COLUMNS = ("key", "en", "ko", "type", "notes", "source", "approximate", "keep", "reviewed")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(ord, en, entry columns) of a JSON object; keys that begin with _ and values that are no objects are passed over."""
    # a map keeps the order of the file's keys, a variant would not
    whole = spark.read.text(path, wholetext=True).select(F.map_entries(F.from_json("value", "map<string,string>")).alias("m"))
    rows = whole.select(F.posexplode("m").alias("ord", "m")).select(F.col("ord").cast("long").alias("ord"), F.col("m.key").alias("en"), F.col("m.value").alias("value"))
    kept = rows.where(~F.col("en").startswith("_") & F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"))
    return kept.select("ord", "en", F.from_json("value", ENTRY).alias("e")).select("ord", "en", "e.*")


def index(entries: DataFrame, use_unreviewed: bool = False) -> DataFrame:
    """Entries by normal key. Retrieved entries are hidden until reviewed; the last of equal keys wins (`ord`)."""
    source = F.coalesce("source", F.lit("dict"))
    reviewed = F.coalesce("reviewed", source != "retrieved")
    rows = entries.withColumns({"source": source, "reviewed": reviewed, "key": lookup_key("en")})
    if not use_unreviewed:
        rows = rows.where((F.col("source") != "retrieved") | F.col("reviewed"))
    last = F.max_by(F.struct(*[c for c in COLUMNS if c != "key"]), "ord").alias("e")
    return rows.withColumns({"type": F.coalesce("type", F.lit("other")), "notes": F.coalesce("notes", F.lit("")), "approximate": F.coalesce("approximate", F.lit(False)), "keep": F.coalesce("keep", F.lit(False))}).groupBy("key").agg(last).select("key", "e.*")


def add_entries(entries: DataFrame, found: DataFrame, use_unreviewed: bool = False) -> DataFrame:
    """The next version of the dictionary: found (en, ko, type, notes) enter as retrieved and unreviewed where no visible entry has their
    key; a hidden entry of the same term is replaced."""
    fresh = found.where((F.trim("en") != "") & (F.trim("ko") != "")).withColumn("key", lookup_key("en")).dropDuplicates(["key"])
    fresh = fresh.join(index(entries, use_unreviewed).select("key"), "key", "left_anti")
    new = fresh.select(F.col("en"), "ko", "type", "notes", F.lit("retrieved").alias("source"), F.lit(False).alias("approximate"), F.lit(False).alias("keep"), F.lit(False).alias("reviewed"))
    last = entries.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("_last"))
    new = new.crossJoin(F.broadcast(last)).select((F.col("_last") + 1).alias("ord"), "en", "ko", "type", "notes", "source", "approximate", "keep", "reviewed")
    return entries.join(new.select("en"), "en", "left_anti").select(*new.columns).union(new)
