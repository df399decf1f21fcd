"""The persona bank: a table partitioned by gender and age bucket, so that a query reads only the partitions that it asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GENDERS = ("male", "female")
AGE_BUCKETS = ("10s", "20s", "30s", "40s", "50s", "60s", "70s", "80s", "90s")
# The bank's own names.
SEX_TO_GENDER = {"남자": "male", "여자": "female"}
AGE_TO_BUCKET = {f"{n}0대": f"{n}0s" for n in range(1, 10)}
COLUMNS = ("name", "age", "age_bucket", "sex", "normalized_location", "occupation", "persona", "persona_id", "summary_text", "career_goals_and_ambitions", "cultural_background", "hobbies_and_interests", "skills_and_expertise")


def write_bank(rows: DataFrame, path: str) -> None:
    """Rows with the bank's columns -> Parquet by (gender_key, age_key); rows of another sex or age bucket are an error of the source."""
    gender = F.element_at(F.create_map(*[F.lit(x) for kv in SEX_TO_GENDER.items() for x in kv]), F.col("sex"))
    age = F.element_at(F.create_map(*[F.lit(x) for kv in AGE_TO_BUCKET.items() for x in kv]), F.col("age_bucket"))
    keyed = rows.withColumns({"gender_key": gender, "age_key": age})
    keyed.repartition("gender_key", "age_key", F.pmod(F.xxhash64("persona_id"), F.lit(16))).write.mode("overwrite").partitionBy("gender_key", "age_key").parquet(path)


def read_bank(spark: SparkSession, path: str, genders: list[str] | None = None, ages: list[str] | None = None) -> DataFrame:
    bank = spark.read.parquet(path)
    if genders:
        bank = bank.where(F.col("gender_key").isin(*genders))
    return bank.where(F.col("age_key").isin(*ages)) if ages else bank


def read_bank_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """The files persona_{gender}_{age}.jsonl of a folder, keys taken from their names."""
    name = F.regexp_extract("_metadata.file_name", r"persona_(male|female)_(\d0s)\.jsonl", 1)
    age = F.regexp_extract("_metadata.file_name", r"persona_(male|female)_(\d0s)\.jsonl", 2)
    rows = spark.read.text(f"{path}/persona_*.jsonl").select(name.alias("gender_key"), age.alias("age_key"), F.try_parse_json("value").alias("v"))
    typed = {c: F.try_variant_get("v", f"$.{c}", "int" if c == "age" else "string").alias(c) for c in COLUMNS}
    return rows.where("v is not null").select("gender_key", "age_key", *typed.values(), compact_extra("v").alias("extra"))


def compact_extra(value: str):
    """map<string,string>: all fields of a variant object that the bank has no column for."""
    fields = F.from_json(F.to_json(value), "map<string,string>")
    return F.map_filter(fields, lambda k, _: ~k.isin(*COLUMNS))
