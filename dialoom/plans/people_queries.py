"""Queries of the persona operators: what a speaker asks for, whom they get, the bank and what a prompt says of them.

Speakers are two for each supplier, the bank is the customers; the SQL states draws, scores, pools and choices for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import text
from dialoom.operators import personas
from dialoom.plans.registry import query, read
from dialoom.plans.schemas import PERSONA_ENTRY, SPEAKER
from dialoom.sources import personas as bank_source
from dialoom.sources.scratch import scratch_path

SEED = 7
_GENDERS, _HINTS, _ROLES, _WORKS = ("Male", "?", "girl", ""), ("20s", "none", "older", "teen", "40plus", "n/a", ""), ("student", "boss", "friend", "cat", "stranger"), ("teacher", "unheard", "Student", "priest")
_JOBS, _LIVES = ("학생", "교사", "대표", "고양이", "상담"), ("차분 친구", "여행", "공감", "종교", "", "사교 경영", "학교")
_MOODS = ("neutral", "joy", "sadness")


def _pick(words: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (n % len(words)).cast("int") + 1)


def _speaker(n: Column, name: Column) -> Column:
    own = F.struct(
        name.alias("name_en"), _pick(_ROLES, n).alias("role_in_scene"), _pick(_GENDERS, n).alias("gender_hint"), _pick(_HINTS, n).alias("age_group_hint"), F.when(n % 2 == 0, "formal").otherwise("casual").alias("register"),
        F.struct(_pick(_MOODS, n).alias("type"), F.lit(3).alias("intensity")).alias("dominant_emotion"), F.array(F.lit("listening")).alias("personality_traits"), F.when(n % 3 == 0, F.array(F.lit("cat"), F.lit("vacation"))).otherwise(F.array().cast("array<string>")).alias("interests_hints"), _pick(_WORKS, n).alias("occupation_hint"),
    )
    return F.from_json(F.to_json(own), SPEAKER)


def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(n.cast("string").alias("id"), F.array(_speaker(n, F.lit("A")), _speaker(n + 1, F.lit("B"))).alias("speakers"))


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    own = {
        "name": F.col("c_name"), "age": (15 + k % 70).cast("int"), "age_bucket": F.concat((k % 9 + 1).cast("string"), F.lit("0대")), "sex": F.when(F.col("c_nationkey") % 2 == 0, "남자").otherwise("여자"), "occupation": _pick(_JOBS, k),
        "persona": _pick(_LIVES, k), "persona_id": k.cast("string"), "summary_text": F.col("c_mktsegment"), "gender_key": F.when(F.col("c_nationkey") % 2 == 0, "male").otherwise("female"), "age_key": F.concat((k % 9 + 1).cast("string"), F.lit("0s")),
    }
    rest = {c: F.lit("") for c in bank_source.COLUMNS if c not in own}
    return read(spark, sf_dir, "customer").select(*[c.alias(n) for n, c in (own | rest).items()])


def _of(words: tuple[str, ...], n: str = "n") -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + f"][{n} % {len(words)} + 1]"


def _buckets(first: int) -> str:
    return "[" + ", ".join(f"'{b}'" for b in bank_source.AGE_BUCKETS[first - 1 :]) + "]"


def _drawn(weights: dict[str, float]) -> str:
    total, out = 0.0, "case"
    for b, w in list(weights.items())[:-1]:
        total += w
        out += f" when ua < {total!r} then '{b}'"
    return f"{out} else '{list(weights)[-1]}' end"


def _words(terms: dict[str, str]) -> str:
    """SQL: keywords of a word in a column."""
    return " ".join(f"when '{k}' then [{', '.join(repr(w) for w in v)}]::varchar[]" for k, v in terms.items())


_U = "('0x' || substr(sha256({}), 1, 13))::bigint / 4503599627370496.0::double"
_KEYWORDS = _words(personas.KEYWORDS)
_ASKS = f"""with q as (select s_suppkey as s, unnest([0, 1]) as pos from supplier), k as (select *, s + pos as n, '{SEED}:' || s || ':' || pos as token from q),
    h as (select *, {_of(_ROLES)} as role, lower({_of(_WORKS)}) as work, lower({_of(_GENDERS)}) as g, {_of(_HINTS)} as a, {_U.format("token || ':gender'")} as ug, {_U.format("token || ':age'")} as ua from k),
    l as (select *, case a when '20s' then ['20s'] when 'teen' then ['10s'] when 'older' then {_buckets(5)} when '40plus' then {_buckets(4)} end as hinted,
        list_concat(case work {_KEYWORDS} else [] end, case role {_KEYWORDS} else [] end, case when n % 3 = 0 then list_concat({", ".join(f"[{', '.join(repr(w) for w in personas.KEYWORDS[t])}]" for t in ("cat", "vacation"))}) else []::varchar[] end, [{", ".join(repr(w) for w in personas.KEYWORDS["listening"])}]) as words from h),
    a as (select s, pos, n, token, case g when 'male' then 'male' when 'girl' then 'female' else case when ug < 0.5 then 'male' else 'female' end end as gender, g not in ('male', 'girl') as random_gender,
        coalesce(hinted, [case when role = 'student' or work = 'student' then {_drawn(personas.AGES_STUDENT)} when role in ('teacher', 'boss') or work in ('priest', 'executive', 'co-founder') then {_drawn(personas.AGES_SENIOR)} else {_drawn(personas.AGES_ANY)} end]) as ages,
        hinted is null as random_age, list_filter(words, lambda x, i: list_position(words, x) = i) as keywords from l)"""


@query(f"{_ASKS} select s as s_suppkey, pos, gender, random_gender, array_to_string(ages, ',') as ages, random_age, array_to_string(keywords, ',') as keywords from a")
def selection_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = personas.selection_context(casts(spark, sf_dir), SEED)
    return asks.select(F.col("id").cast("long").alias("s_suppkey"), "pos", "gender", "random_gender", F.array_join("ages", ",").alias("ages"), "random_age", F.array_join("keywords", ",").alias("keywords"))


_BANK = f"""b as (select c_custkey, c_custkey::varchar as pid, case when c_nationkey % 2 = 0 then 'male' else 'female' end as gender, (c_custkey % 9 + 1) || '0s' as age_key, (c_custkey % 9 + 1) || '0대' as age_bucket, {_of(_JOBS, "c_custkey")} as job,
    {_of(_JOBS, "c_custkey")} || ' ' || {_of(_LIVES, "c_custkey")} || '    ' || c_mktsegment as body, substr(sha256(c_custkey::varchar), 1, 16) as tie from customer)"""
_CALM = " or ".join(f"contains(body, '{w}')" for w in personas.CALM)
_POOL = f"""{_ASKS}, {_BANK},
    c as materialized (select a.s, a.pos, a.token, b.pid, b.tie, coalesce(list_sum(list_transform(a.keywords, lambda w: case when contains(job, w) then 8.0 when contains(body, w) then 3.0 else 0.0 end)), 0.0)
        + case when n % 2 = 0 and age_bucket in ({", ".join(f"'{x}'" for x in personas.MATURE)}) then 0.5 else 0.0 end + case when n % 3 <> 1 and ({_CALM}) then 0.5 else 0.0 end as score from a join b on a.gender = b.gender and list_contains(a.ages, b.age_key))"""


def _choice(free: str) -> str:
    """SQL: of the first ones among each cast's free candidates, by points or else by tie, one of those with the highest score, by the token."""
    ranked = f"select *, row_number() over (partition by s order by score desc, tie desc) as best, row_number() over (partition by s order by tie) as spare, max(score) over (partition by s) as top from ({free})"
    first = f"select * from ({ranked}) where score = top and case when top > 0 then best <= {personas.POOL} else spare <= {personas.POOL} end"
    return f"""select s, pos, pid, score from (select *, row_number() over (partition by s order by tie desc) - 1 as spot, count(*) over (partition by s) as n from ({first}))
        where spot = floor({_U.format("token || ':pick'")} * n)"""


@query(f"""{_POOL}, one as ({_choice("select * from c where pos = 0")}), two as ({_choice("select c.* from c left join one on one.s = c.s where c.pos = 1 and (one.pid is null or c.pid <> one.pid)")})
    select s as s_suppkey, pos, pid::bigint as persona_id, round(score, 3)::double as match_score, score > 0 as matched from (select * from one union all select * from two)""")
def personas_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """select_personas as a whole: who chooses later finds as many that are free; ties by the seeded hash, no persona twice in a cast."""
    chosen = personas.select_personas(casts(spark, sf_dir), bank(spark, sf_dir), SEED)
    flat = chosen.select(F.col("id").cast("long").alias("s_suppkey"), F.explode("persona").alias("e"))
    return flat.select("s_suppkey", F.col("e.speaker_index").alias("pos"), F.col("e.retrieved_persona.persona_id").cast("long").alias("persona_id"), F.round("e.selection_metadata.match_score", 3).alias("match_score"), F.col("e.selection_metadata.matched_by_keywords").alias("matched"))


@query(f"""{_ASKS} select s as s_suppkey, 'A' as name, array_to_string(case when random_age then [] else ages end, ',') as ages, case when random_gender then '' else gender end as gender, array_to_string(keywords, ',') as keywords from a where pos = 0""")
def fallback_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = personas.fallback_entry(F.lit(0), F.get("speakers", F.lit(0)))
    rows = casts(spark, sf_dir).select("id", e.alias("e"))
    meta = F.col("e.selection_metadata")
    return rows.select(F.col("id").cast("long").alias("s_suppkey"), F.col("e.retrieved_persona.name").alias("name"), F.array_join(meta["candidate_age_buckets"], ",").alias("ages"), F.coalesce(meta["candidate_gender"], F.lit("")).alias("gender"), F.array_join(meta["keyword_hints"], ",").alias("keywords"))


@query(f"""select c_custkey, '- A -> ' || c_name || ' (' || (15 + c_custkey % 70) || ', ' || case when c_nationkey % 2 = 0 then '남자' else '여자' end || ')' || chr(10) || '  occupation: ' || {_of(_JOBS, "c_custkey")}
    || case when {_of(_LIVES, "c_custkey")} <> '' then chr(10) || '  persona: ' || {_of(_LIVES, "c_custkey")} else '' end || chr(10) || '  interests: ' || c_mktsegment as prompt from customer""")
def persona_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.struct("name", "age", "sex", "occupation", "persona", "cultural_background", F.col("summary_text").alias("hobbies_and_interests"))
    entry = F.from_json(F.to_json(F.struct(F.lit("A").alias("speaker_name_en"), own.alias("retrieved_persona"))), PERSONA_ENTRY)
    return bank(spark, sf_dir).select(F.col("persona_id").cast("long").alias("c_custkey"), personas.prompt_context(F.array(entry)).alias("prompt"))


@query("select c_custkey, 'female' as gender, (c_custkey % 9 + 1) || '0s' as age, c_name as name from customer where c_nationkey % 2 = 1 and c_custkey % 9 in (2, 3)")
def persona_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by gender and age, two partitions read back."""
    path = scratch_path(spark, "bank")
    bank_source.write_bank(bank(spark, sf_dir).drop("gender_key", "age_key"), path)
    rows = bank_source.read_bank(spark, path, ["female"], ["30s", "40s"])
    return rows.select(F.col("persona_id").cast("long").alias("c_custkey"), F.col("gender_key").alias("gender"), F.col("age_key").alias("age"), "name")


@query("select c_custkey, 'male' as gender, '20s' as age, c_name as name, c_custkey::varchar || ':' || c_mktsegment as extra from customer")
def persona_bank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bank as JSON Lines: gender and age from the file's name, fields without a column of their own in `extra`."""
    path = scratch_path(spark, "bank-lines")
    lines = read(spark, sf_dir, "customer").select(F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("persona_id"), F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("number"))))
    lines.write.text(f"{path}/persona_male_20s.jsonl")
    return _named(spark, path)


def _named(spark: SparkSession, path: str) -> DataFrame:
    """Spark writes folders; the file within gets the bank's name."""
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(f"{path}/persona_male_20s.jsonl")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    moved = jvm.Path(f"{path}/named")
    fs.mkdirs(moved)
    for i, status in enumerate(s for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")):
        name = "persona_male_20s.jsonl" if i == 0 else f"more-{i}/persona_male_20s.jsonl"
        target = jvm.Path(f"{path}/named/{name}")
        fs.mkdirs(target.getParent())
        fs.rename(status.getPath(), target)
    rows = bank_source.read_bank_jsonl(spark, f"{path}/named")
    return rows.select(F.col("persona_id").cast("long").alias("c_custkey"), F.col("gender_key").alias("gender"), F.col("age_key").alias("age"), "name", F.concat_ws(":", F.col("extra")["number"], F.col("extra")["segment"]).alias("extra"))


@query("select c_custkey, array_to_string(list_filter(l, lambda x, i: x <> '' and list_position(l, x) = i), ',') as names from (select c_custkey, [c_mktsegment, trim(' ' || c_nationkey::varchar || ' '), '', c_mktsegment, (c_custkey % 25)::varchar] as l from customer)")
def ordered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.array("c_mktsegment", F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(" ")), F.lit("  "), F.concat("c_mktsegment", F.lit("\t")), (F.col("c_custkey") % 25).cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(text.ordered_distinct(own), ",").alias("names"))
