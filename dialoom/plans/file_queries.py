"""Queries of files as a run leaves them, of the parts of a polishing prompt, and of the real repair tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import dialogue, retry
from dialoom.operators.rules import Limits
from dialoom.plans import pipeline
from dialoom.plans.case_queries import _CASES, _as, _key, cases
from dialoom.plans.registry import query, read
from dialoom.plans.schemas import DECOMPOSED, MAPPED_REF, SCENE, SPEAKER, TURN, with_defaults
from dialoom.sources import dictionary, jsonl, staged
from dialoom.sources.scratch import scratch_path


@query("""with c as (select c_custkey, c_name, c_nationkey, c_mktsegment, row_number() over (order by c_custkey) - 1 as p from customer)
    select 'set-' || p as id, p as original_index, c_name as said, case when c_custkey % 2 = 0 then c_mktsegment else '' end as narrative from c where p < 1000 and c_nationkey % 5 <> 0 and c_custkey % 11 <> 0""")
def staged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged set of several files through the data source, with columns of other names: the limit counts positions, empty rows too."""
    path = scratch_path(spark, "staged")
    turns = F.when(F.col("c_nationkey") % 5 != 0, F.array("c_name")).otherwise(F.array().cast("array<string>"))
    people = F.when(F.col("c_custkey") % 11 != 0, F.array(F.lit("A")))
    rows = read(spark, sf_dir, "customer").repartitionByRange(5, "c_custkey").sortWithinPartitions("c_custkey")
    rows.select(turns.alias("turns"), people.alias("speakers"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("story"), "c_custkey").write.parquet(path)
    staged.register(spark)
    got = spark.read.format("dialoom_staged").options(path=path, name="some/set:v1", limit="1000", dialogue="turns", narrative="story").load()
    return got.select("id", "original_index", F.get("dialogue", F.lit(0)).alias("said"), "narrative")


_TORN = "with l as (select s_suppkey as k, s_name, s_suppkey // 25 as file, s_suppkey % 17 = 8 as broken, s_suppkey % 11 = 0 as blank from supplier), b as (select *, coalesce(min(case when broken then k end) over (partition by file), 1000000000) as cut from l)"


@query(f"{_TORN} select 'id-' || k as id, s_name as said, (select count(*) from b where k >= cut and (broken or not blank)) as gone from b where k < cut and not blank")
def lines_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that were torn in the middle of a line: each keeps what stands before its first broken line."""
    path = scratch_path(spark, "torn")
    k = F.col("s_suppkey")
    line = F.when(k % 17 == 8, F.concat(F.lit('{"id": "'), "s_name")).when(k % 11 == 0, " ").otherwise(F.to_json(F.struct(F.concat(F.lit("id-"), k.cast("string")).alias("id"), F.col("s_name").alias("said"))))
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", F.floor(k / 25).alias("file"), line.alias("value"))
    rows.repartition("file").sortWithinPartitions("file", "s_suppkey").select("file", "value").write.partitionBy("file").text(path)
    gone = jsonl.repair(spark, path)
    kept = jsonl.read_objects(spark, path)
    return kept.select(*[F.try_variant_get("value", f"$.{c}", "string").alias(c) for c in ("id", "said")], F.lit(gone).cast("long").alias("gone"))


_PROFILE = "'- A (friend)' || case when z % 3 = 0 then ' -> ' || p_type || ', ' || z || ', , ' else '' end || chr(10) || chr(10) || '- B (friend)'"
_TWICE = "case when z % 3 = 0 then ',' || p_type || '(' || z || '세, ),' || p_type || '(' || z || '세, )' else '' end"


@query(f"{_CASES} select p_partkey, {_PROFILE} as profiles, ['friendship', 'family', 'professional'][z % 3 + 1] || {_TWICE} as consistency from j")
def polish_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers and personas side by side, and what has to stay as it is: the kind of relationship, personas where there are two."""
    rows = cases(spark, sf_dir)
    twice = F.concat("persona", "persona")
    return rows.select(_key(), dialogue.profile_context(F.col("speakers"), F.col("persona")).alias("profiles"), F.array_join(dialogue.consistency_context(F.col("scene.relationship_type"), twice), ",").alias("consistency"))


@query(f"""{_CASES} select p_partkey, '{dialogue.POLISH_TASK.replace("'", "''")}' as task, array_to_string(list_transform(f, lambda x, i: '[' || (i - 1 + case when z % 7 = 0 then 1 else 0 end) || '] ' || case when i % 2 = 1 then 'A: ' else 'B: ' end || x), chr(10)) as draft,
    {_PROFILE} as profiles, ['friendship', 'family', 'professional'][z % 3 + 1] as consistency from j""")
def polish_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of what is asked of a polishing model: the task, the draft, the profiles, what has to stay."""
    rows = cases(spark, sf_dir).withColumn("step3_korean_dialogue", F.col("final_dialogue")).select("*", dialogue.polish_prompt().alias("prompt"))
    cut = lambda since, until: F.regexp_extract("prompt", rf"(?s)\[{since}\]\n(.*?)\n\n\[{until}\]", 1)
    last = F.regexp_extract("prompt", r"(?s)\[consistency\]\n(.*)$", 1)
    return rows.select(_key(), cut("task", "source").alias("task"), cut("draft", "references").alias("draft"), cut("profiles", "notes").alias("profiles"), last.alias("consistency"))


_MEND = "select *, p_size % 5 = 0 as unknown, p_size % 2 = 1 as missing from part"


@query(f"""with m as ({_MEND}) select p_partkey, not unknown as valid, 1 as iter, case when unknown then '' else '상점' end as ko, case when unknown then 'cultural_ref_coverage' else '' end as rules from m where missing""")
def tools_mend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair tools themselves: references are mapped again by the dictionary; a term that it lacks cannot be mended."""
    z = F.col("p_size")
    term = F.when(z % 5 == 0, F.concat(F.lit("Unheard "), F.col("p_partkey").cast("string"))).otherwise(F.col("p_brand"))
    turn = lambda i, who, x: F.struct(F.lit(i).alias("index"), F.lit(who).alias("speaker"), x.alias("text"))
    source = F.array(turn(0, "A", F.concat(F.lit("We met at "), term, F.lit(" "), F.col("p_partkey").cast("string"))), turn(1, "B", F.lit("Nice")))
    final = F.array(turn(0, "A", F.lit("상점에서 만났지")), turn(1, "B", F.lit("좋아")))
    ref = F.struct(F.lit("brand").alias("type"), term.alias("term"))
    mapped = F.struct(term.alias("term"), F.lit("상점").alias("ko"), F.lit("brand").alias("type"), F.lit("dict").alias("source"), F.lit(False).alias("retrieved"))
    who = F.array(*[F.struct(F.lit(n).alias("name_en"), F.lit("friend").alias("role_in_scene")) for n in "AB"])
    # dealt while rows are narrow: what follows is much work a row, and a small file is read by few tasks
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand").repartition(2 * spark.sparkContext.defaultParallelism, "p_partkey")
    rows = parts.select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("original_index"), source.cast(f"array<{TURN}>").alias("source_dialogue"), _as(who, f"array<{SPEAKER}>").alias("speakers"),
        _as(F.struct(F.lit("").alias("narrative_en"), F.lit("cafe").alias("setting")), SCENE).alias("scene"), _as(F.struct(F.array(ref).alias("cultural_refs")), DECOMPOSED).alias("dialogue_decomposed"),
        F.when(z % 2 == 1, F.array().cast(f"array<{MAPPED_REF}>")).otherwise(_as(F.array(mapped), f"array<{MAPPED_REF}>")).alias("mapped_refs"), final.cast(f"array<{TURN}>").alias("final_dialogue"), F.col("p_partkey").alias("_ord"),
    )
    known = read(spark, sf_dir, "part").select(F.col("p_brand").alias("en")).distinct().select(F.xxhash64("en").alias("ord"), "en", F.lit("상점").alias("ko"), F.lit("brand").alias("type"), F.lit("").alias("notes"), F.lit("dict").alias("source"), F.lit(False).alias("approximate"), F.lit(False).alias("keep"), F.lit(True).alias("reviewed"))
    calls, limits = pipeline.Models(), Limits(ascii_ratio_max=1.0, coherence_floor=-1.0, semantic_cosine=0.9999999)
    first = pipeline.validate(with_defaults(rows, "stage3", ["_ord"]), calls, limits).drop("_ord")
    tools = pipeline.repair_tools(calls, dictionary.index(known), None)
    done = retry.repair(retry.queue(first), {k: tools[k] for k in ("maps_ref_redo", "websearch_cultural")}, lambda x: pipeline.revalidate(x, calls, limits), limits)
    return done.select(_key(), "valid", "iter", F.coalesce(F.get("mapped_refs", F.lit(0))["ko"], F.lit("")).alias("ko"), F.array_join(F.transform("reject_reasons", lambda r: r["rule"]), ",").alias("rules"))
