"""One query for each operator over the driver's tables, and SQL that gives the same rows.

A dialogue is a conversation: user turns are its source side, assistant turns its rewrite. Where an operator's own words or thresholds
would match nothing in these tables, the query passes others; the operators take them as parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions import stats, text
from dialoom.operators import dedup, dialogue, export, gates, lookup, mapping_checks, metrics, models, normalize, personas, retry, rules
from dialoom.plans.registry import query, read
from dialoom.plans.schemas import AXES, DDL, PERSONA_ENTRY, SPEAKER, TURN, with_defaults
from dialoom.sources import dictionary

LIMITS = rules.Limits(ascii_ratio_max=0.80)
POLITE_MARKS, CASUAL_MARKS = ("tion", "this"), ("hou", "ly")


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as rows of the third layer: one aggregation on conv_id."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    side = lambda role: F.sort_array(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text"))))
    both = turns.groupBy("conv_id").agg(side("user").alias("u"), side("assistant").alias("a"))
    made = lambda c, who: F.transform(c, lambda t, i: F.struct(i.alias("index"), F.lit(who).alias("speaker"), t["text"].alias("text"))).cast(f"array<{TURN}>")
    speaker = F.array(F.struct(F.lit("user").alias("name_en"), F.lit("friend").alias("role_in_scene"), F.lit("unknown").alias("gender_hint"), F.lit("unknown").alias("age_group_hint"), F.lit("casual").alias("register"), F.struct(F.lit("neutral").alias("type"), F.lit(3).alias("intensity")).alias("dominant_emotion"), F.array().cast("array<string>").alias("personality_traits"), F.array().cast("array<string>").alias("interests_hints"), F.lit("").alias("occupation_hint"), F.lit("").alias("speech_style_notes"))).cast(f"array<{SPEAKER}>")
    rows = both.select(F.col("conv_id").cast("string").alias("id"), F.col("conv_id").alias("original_index"), made(F.col("u"), "user").alias("source_dialogue"), speaker.alias("speakers"), made(F.col("a"), "assistant").alias("final_dialogue"))
    fields = dict(f.split(" ", 1) for f in _top_level(DDL["stage3"]))
    scene = F.from_json(F.lit('{"narrative_en":"","setting":"other","relationship_type":"friendship","topics":[]}'), fields["scene"])
    whole = F.from_json(F.lit('{"overall_register":"casual","overall_emotion":{"type":"neutral","intensity":3},"speech_acts":["statement"],"cultural_refs":[]}'), fields["dialogue_decomposed"])
    return with_defaults(rows.withColumns({"scene": scene, "dialogue_decomposed": whole}), "stage3")


def _top_level(ddl: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[start:i].strip())
            start = i + 1
    return [*out, ddl[start:].strip()]


def _joined(c: str, sep: str = " | ") -> Column:
    return F.array_join(F.transform(c, lambda t: t["text"]), sep)


def _conv() -> Column:
    return F.col("original_index").alias("conv_id")


_SIDES = """with s as (select conv_id, coalesce(list(coalesce(text, '') order by turn) filter (where role = 'user'), []) as u, coalesce(list(coalesce(text, '') order by turn) filter (where role = 'assistant'), []) as a from conversations group by conv_id),
    t as (select *, array_to_string(a, ' ' || chr(10) || ' ') as rt from s),
    w as (select *, list_filter(string_split(replace(rt, chr(10), ' '), ' '), lambda x: x <> '') as k from t),
    r as (select *, case when len(rt) > 0 then length(regexp_replace(rt, '[^0-9A-Za-z]', '', 'g')) / length(rt) else 0.0 end as ratio from w),
    f as (select *, case when len(a) > 0 and len(a) <> len(u) then 'turn_count_parity' when len(a) > 0 and ratio > 0.8 then 'ascii_ratio' end as rule from r)"""

@query(f"{_SIDES} select conv_id, len(u) as n_source, len(a) as n_rewrite, array_to_string(u, ' | ') as source_text, array_to_string(a, ' | ') as rewrite_text from s")
def paired_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).select(_conv(), F.size("source_dialogue").cast("long").alias("n_source"), F.size("final_dialogue").cast("long").alias("n_rewrite"), _joined("source_dialogue").alias("source_text"), _joined("final_dialogue").alias("rewrite_text"))


@query(f"{_SIDES} select conv_id, len(a) = 0 or len(a) = len(u) as ok from s")
def turn_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).select(_conv(), rules.turn_count_parity(LIMITS).isNull().alias("ok"))


@query(f"{_SIDES} select conv_id, round(ratio, 9) as ratio from r")
def ascii_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).select(_conv(), F.round(text.ascii_ratio(metrics.rewrite_text()), 9).alias("ratio"))


@query(f"{_SIDES} select conv_id, rule from f")
def rule_first_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply(dialogues(spark, sf_dir), limits=LIMITS).select(_conv(), F.get("reject_reasons", F.lit(0))["rule"].alias("rule"))


@query(f"{_SIDES} select 'stage3.phase2:' || rule as rule, count(*) as n from f where rule is not null group by 1")
def reject_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rejects(rules.apply(dialogues(spark, sf_dir), limits=LIMITS))


@query("select doc_id, md5(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) as cleaned from documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_text("text").cast("binary")).alias("cleaned"))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("en"), F.col("p_name").alias("ko"), F.lit("brand").alias("type"), F.col("p_type").alias("notes"), F.when(F.col("p_size") % 3 == 0, "retrieved").otherwise("seed").alias("source"), F.lit(False).alias("approximate"), F.lit(False).alias("keep"), (F.col("p_size") % 2 == 0).alias("reviewed"))


_KEY = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9가-힣\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""with d as (select {_KEY.format("p_brand")} as k, max_by(p_name, p_partkey) as ko from part where p_size % 3 <> 0 or p_size % 2 = 0 group by 1)
    select p_partkey, d.ko from part left join d on d.k = {_KEY.format("p_brand || '!'")}""")
def dict_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.lit("!")).alias("term"), F.lit("brand").alias("type"), F.lit("").alias("context"))
    return lookup.map_terms(terms, dictionary.index(_entries(spark, sf_dir))).select("p_partkey", F.col("mapped.ko").alias("ko"))


@query(f"""with w as (select conv_id, unnest(string_split(lower(text), ' ')) as w from conversations)
    select conv_id, count(*) filter (where trim(w) not in ({", ".join(f"'{g}'" for g in lookup.GENERIC)})) as n from w group by conv_id""")
def blocklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").where("text is not null")
    refs = F.transform(F.split(F.lower("text"), " "), lambda w: F.struct(F.lit("other").alias("type"), w.alias("term")))
    return rows.groupBy("conv_id").agg(F.sum(F.size(lookup.without_generic(refs))).cast("long").alias("n"))


@query("""with p as (select p_partkey, p_name as term, case when p_size % 5 = 0 then p_name else p_type end as ko, case p_size % 3 when 0 then 'brand' when 1 then 'pop_culture' else 'slang' end as kind, replace(p_type, ' ', case when p_size % 2 = 0 then '_' else ' ' end) as notes from part)
    select p_partkey, case when lower(trim(ko)) = lower(trim(term)) then 'ko_empty_or_same:error' else array_to_string(list_filter([
        case when kind = 'brand' and not regexp_matches(ko, '[가-힣]') then 'non_hangul_ko:error' when kind = 'pop_culture' and not regexp_matches(ko, '[가-힣]') then 'non_hangul_ko:warn' end,
        case when regexp_matches(ko, '[A-Za-z가-힣]+_[A-Za-z가-힣]+') or regexp_matches(notes, '[A-Za-z가-힣]+_[A-Za-z가-힣]+') then 'corrupted_token:warn' end], lambda x: x is not null), ',') end as flags from p""")
def validator_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    kind = F.when(size % 3 == 0, "brand").when(size % 3 == 1, "pop_culture").otherwise("slang")
    ko = F.when(size % 5 == 0, F.col("p_name")).otherwise(F.col("p_type"))
    notes = F.when(size % 2 == 0, F.replace("p_type", F.lit(" "), F.lit("_"))).otherwise(F.col("p_type"))
    flags = mapping_checks.flags(F.col("p_name"), ko, kind, notes)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(flags, lambda f: F.concat_ws(":", f["code"], f["severity"])), ",").alias("flags"))


@query("""with m as (select label, list(v order by i) as v from (select label, i, avg(embedding[i]::double) as v from embeddings, range(1, 65) t(i) where embedding is not null and label is not null group by label, i) group by label),
    s as (select e.vec_id, m.label, list_cosine_similarity(e.embedding::double[], m.v) as s from embeddings e, m), k as (select *, row_number() over (partition by vec_id order by s desc, label) as r, lead(s) over (partition by vec_id order by s desc, label) as n from s where s >= 0.1)
    select vec_id, label from k where r = 1 and (n is null or s - n >= 0.05)""")
def vector_topk_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where("embedding is not null")
    flat = rows.where("label is not null").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    index = flat.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda c: c["x"]).alias("v"))
    unit = lambda c: F.transform(c, lambda x: x.cast("double") / F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, y: s + y.cast("double") * y.cast("double"))))
    hits = lookup.nearest(rows.select("vec_id", unit(F.col("embedding")).alias("vector")), index.select("label", unit(F.col("v")).alias("vector")), key="vec_id", top=2, threshold=0.1, order="label")
    return lookup.clear_hits(hits, key="vec_id").select("vec_id", "label")


_PAIRS = "select a.vec_id as a, b.vec_id as b, list_cosine_similarity(a.embedding::double[], b.embedding::double[]) as s from embeddings a join embeddings b on a.vec_id < b.vec_id"


@query(f"select a, b, round(s, 6) as similarity from ({_PAIRS}) where s >= 0.4")
def similarity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.similar_pairs(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.4).withColumn("similarity", F.round("similarity", 6))


@query(f"""with recursive e as materialized (select a, b, s from ({_PAIRS}) where s >= 0.35), n as (select vec_id, row_number() over (order by vec_id) as rn from embeddings), l as (select b, list(a) as l from e group by b),
    r as (select 0::bigint as rn, []::bigint[] as kept union all select r.rn + 1, case when list_has_any(r.kept, coalesce(l.l, []::bigint[])) then r.kept else list_append(r.kept, n.vec_id) end from r join n on n.rn = r.rn + 1 left join l on l.b = n.vec_id),
    k as (select unnest(kept) as id from r where rn = (select max(rn) from r)), p as (select b, min(a) as pivot from e where a in (select id from k) group by b)
    select vec_id, case when vec_id in (select id from k) then vec_id else p.pivot end as pivot, case when vec_id in (select id from k) then 'kept' when (select s from e where e.a = p.pivot and e.b = vec_id) >= 0.45 then 'exact' else 'semantic' end as label from embeddings left join p on p.b = vec_id""")
def dedup_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.semantic_dedup(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.35, 0.45)
    return found.withColumn("pivot", F.coalesce("pivot", "vec_id"))


@query("select doc_id, row_number() over (partition by text order by doc_id) = 1 as kept from documents")
def dedup_exact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_text(read(spark, sf_dir, "documents"), "doc_id", "text")


_HASHED = "[" + ", ".join(f"('0x' || substr(md5(text), {2 * i + 1}, 2))::int / 255.0::double * 2 - 1" for i in range(8)) + "]"


@query(f"""with e as (select conv_id, turn, {_HASHED}::double[] as v from conversations), p as (select conv_id, v, lag(v) over (partition by conv_id order by turn) as p from e)
    select conv_id, round(coalesce(avg(case when p is not null then list_cosine_similarity(p, v) end), 1.0), 6) as coherence from p group by conv_id""")
def coherence_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", models.embed(F.col("text")).alias("v"))
    return gates.turn_coherence(turns, "conv_id", "turn", "v").select("conv_id", F.round("coherence", 6).alias("coherence"))


@query("""select d.doc_id, round(case when l.doc_id is null then (n_chars % 5 + 1) * 0.35 / 0.35 else ((quality * 4 + 1) * 0.2 + (5 - 4 * toxic) * 0.2 + (n_chars % 5 + 1) * 0.35) / 0.75 end, 3) as aggregate from documents d left join labels l using (doc_id)""")
def judge_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", "n_chars").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    scores = {"property_preservation": F.col("quality") * 4 + 1, "naturalness": 5 - 4 * F.col("toxic"), "cultural_appropriateness": F.col("n_chars") % 5 + 1}
    return rows.select("doc_id", gates.weighted_mean(scores, LIMITS.weights).alias("aggregate"))


@query(f"{_SIDES} select conv_id, case rule when 'turn_count_parity' then 'stage1_redecompose' when 'ascii_ratio' then 'stage2_rewrite' else '' end as actions from f")
def retry_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retry.derive(rules.apply(dialogues(spark, sf_dir), limits=LIMITS))
    return rows.select(_conv(), F.array_join(F.transform("retry_actions", lambda a: a["action"]), ",").alias("actions"))


@query(f"{_SIDES} select conv_id from f where rule is not null")
def retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retry.queue(retry.derive(rules.apply(dialogues(spark, sf_dir), limits=LIMITS))).select(_conv())


@query(f"""{_SIDES}, g as (select n, array_to_string(k[i:i+n-1], ' ') as g from w, range(1, 4) a(n), range(1, 1000000) b(i) where i + n - 1 <= len(k))
    select n::int as n, count(distinct g) as distinct_ngrams, count(*) as total, round(count(distinct g) / count(*), 9) as ratio from g group by n""".replace("range(1, 1000000) b(i) where", "unnest(range(1, len(k) + 1)) b(i) where"))
def distinct_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distinct_n(dialogues(spark, sf_dir), text.blank_tokens(metrics.rewrite_text())).withColumn("ratio", F.round("ratio", 9))


@query("select 'lang' as field, round(entropy(lang), 9) as entropy from documents union all select 'source', round(entropy(source), 9) from documents")
def entropy_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.explode(F.array(F.struct(F.lit("lang").alias("field"), F.col("lang").alias("value")), F.struct(F.lit("source").alias("field"), F.col("source").alias("value")))).alias("r")).select("r.*")
    return stats.entropy(docs, "value", by=["field"]).withColumn("entropy", F.round("entropy", 9))


@query("""with x as (select lang, list(n_chars order by n_chars) as l from documents where n_chars is not null group by lang)
    select lang, round(list_avg(l), 6) as mean, l[round_even(0.5 * (len(l) - 1), 0)::bigint + 1]::double as p50, l[round_even(0.95 * (len(l) - 1), 0)::bigint + 1]::double as p95, len(l) as n from x""")
def nearest_rank_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.nearest_rank(read(spark, sf_dir, "documents"), "n_chars", by=["lang"]).withColumn("mean", F.round("mean", 6))


@query(f"""{_SIDES}, g as (select conv_id, list_distinct(list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) as g from w where len(k) > 1)
    select count(*) as pairs, round(avg(1 - len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g)))), 6) as diversity from g a join g b on a.conv_id < b.conv_id""")
def bigram_jaccard_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.bigram_jaccard_diversity(dialogues(spark, sf_dir), "original_index", text.blank_tokens(metrics.rewrite_text()))
    return found.withColumn("diversity", F.round("diversity", 6))


@query(f"select (select count(*) from embeddings) as n, round(avg(1 - s), 6) as diversity from ({_PAIRS})")
def embedding_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.embedding_diversity(read(spark, sf_dir, "embeddings"), "embedding").withColumn("diversity", F.round("diversity", 6))


@query(f"""{_SIDES}, v as (select 'chars' as field, length(rt) as v from w union all select 'tokens', len(k) from w union all select 'turns', len(u) from w union all select 'mapped_refs', 0 from w),
    x as (select field, list(v order by v) as l from v group by field)
    select field, round(list_avg(l), 6) as mean, l[round_even(0.5 * (len(l) - 1), 0)::bigint + 1]::double as p50, l[round_even(0.95 * (len(l) - 1), 0)::bigint + 1]::double as p95, len(l) as n from x""")
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.lengths(dialogues(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


_SCORE = "case when contains(p_type, k) then 8.0 when contains(p_name, k) then 3.0 else 0.0 end"


@query("select p_partkey, " + " + ".join(_SCORE.replace("k)", f"'{k}')") for k in ("STEEL", "SMALL", "a")) + " as score from part")
def keyword_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(F.lit("STEEL"), F.lit("SMALL"), F.lit("a"))
    return read(spark, sf_dir, "part").select("p_partkey", personas.score(words, F.lit(""), F.lit(""), F.col("p_type"), F.col("p_name"), F.lit("")).alias("score"))


_CARDS = "list_transform(regexp_extract_all(coalesce(text, ''), '" + gates.CARD + "', 1), lambda c: regexp_replace(c, '[ -]', '', 'g'))"
_LUHN = "list_sum(list_transform(range(1, length(c) + 1), lambda i: case when i % 2 = 1 then substr(reverse(c), i, 1)::int when substr(reverse(c), i, 1)::int > 4 then substr(reverse(c), i, 1)::int * 2 - 9 else substr(reverse(c), i, 1)::int * 2 end)) % 10 = 0"


@query("select doc_id, array_to_string(list_filter([" + ", ".join(f"case when regexp_matches(coalesce(text, ''), '{p}') then '{k}' end" for k, p in gates.PII_PATTERNS.items()) + f", case when len(list_filter({_CARDS}, lambda c: length(c) between 13 and 19 and {_LUHN})) > 0 then 'card' end], lambda x: x is not null), ',') as kinds from documents")
def pii_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(gates.pii_kinds(F.col("text")), ",").alias("kinds"))


_LEVEL = "case when p and c then 'mixed' when p then 'polite' when c then 'casual' else 'unknown' end"
_MARKED = "select *, contains(text, 'tion') or contains(text, 'this') as p, contains(text, 'hou') or contains(text, 'ly') as c from conversations"


@query(f"select conv_id, turn, {_LEVEL} as level from ({_MARKED})")
def speech_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", text.speech_level("text", POLITE_MARKS, CASUAL_MARKS).alias("level"))


@query(f"select conv_id, count(distinct case when level in ('polite', 'casual') then level end) = 2 as mixed from (select conv_id, case when role = 'assistant' then {_LEVEL} end as level from ({_MARKED})) group by conv_id")
def mixed_speech_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).select(_conv(), dialogue.mixed_levels(F.col("final_dialogue"), POLITE_MARKS, CASUAL_MARKS).alias("mixed"))


@query("select c_custkey, case c_custkey % 3 when 0 then 20 + c_custkey % 40 <= 20 + c_nationkey when 1 then 20 + c_custkey % 40 <= 20 + c_nationkey else 25 + c_custkey % 40 < 20 + c_nationkey end as conflict from customer")
def role_age_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_custkey") % 3
    entry = lambda role, age: F.from_json(F.to_json(F.struct(F.lit("x").alias("speaker_name_en"), F.struct(age.cast("int").alias("age")).alias("retrieved_persona"), F.struct(role.alias("role_in_scene")).alias("source_speaker_profile"))), PERSONA_ENTRY)
    old = F.when(kind == 0, "parent").when(kind == 1, "teacher").otherwise("boss")
    young = F.when(kind == 0, "child").when(kind == 1, "student").otherwise("subordinate")
    both = F.array(entry(old, 20 + F.col("c_custkey") % 40), entry(young, 20 + F.col("c_nationkey")))
    return read(spark, sf_dir, "customer").select("c_custkey", dialogue.role_conflict(both, F.array().cast(f"array<{SPEAKER}>")).alias("conflict"))


@query("select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.unfinished(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")), key="doc_id")


@query(f"""{_SIDES} select conv_id::varchar as source_id, array_to_string(list_transform(u, lambda x: 'user: ' || x), chr(10)) as asked, array_to_string(list_transform(a, lambda x: 'assistant: ' || x), chr(10)) as answered from f where rule is null""")
def sft_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = export.sft(rules.apply(dialogues(spark, sf_dir), limits=LIMITS))
    return rows.select("metadata.source_id", F.get("messages", F.lit(0))["content"].alias("asked"), F.get("messages", F.lit(1))["content"].alias("answered"))


@query("""select event_id, greatest(1, least(5, round_even(value, 0)))::int as intensity, case when event_type in ('joy', 'anger', 'sadness', 'fear', 'surprise', 'disgust', 'neutral') then event_type else 'neutral' end as emotion from events""")
def normalize_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    return rows.select("event_id", normalize.intensity(F.col("value").cast("string")).alias("intensity"), normalize.emotion_type(F.col("event_type")).alias("emotion"))


@query("""select c_custkey, case when contains(c_name, '13') or contains(c_name, '14') or contains(c_name, '15') or contains(c_name, '16') or contains(c_name, '17') or contains(c_name, '18') or contains(c_name, '19') then 'teen'
    when contains(c_name, '20') then '20s' when contains(c_name, '30') then '30s' when contains(c_name, '40') or contains(c_name, '50') or contains(c_name, '60') then '40plus' else 'unknown' end as age_group from customer""")
def normalize_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", normalize.age_group(F.col("c_name")).alias("age_group"))


@query(f"""{_SIDES} select count(*) filter (where rule is null) as accepted, count(*) filter (where rule is not null) as rejected, count(*) filter (where rule is not null) as retry_queue, 0::bigint as repaired, 0::bigint as repaired_valid, 0::bigint as parse_errors from f""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retry.derive(rules.apply(dialogues(spark, sf_dir), limits=LIMITS))
    return export.summary(rows, retry.queue(rows), rows.limit(0), rows.limit(0))


_JUDGED = ", ".join(f"2 + ('0x' || substr(md5(id || '{a}'), 1, 2))::int % 4 as {a}" for a in AXES)
_WEIGHTED = " + ".join(f"{w} * {a}" for a, w in LIMITS.weights.items())


@query(f"""{_SIDES.replace("with s as", "with recursive s as")},
    e as materialized (select conv_id, u, a, {_HASHED.replace("text", "array_to_string(u, ' ' || chr(10) || ' ')")}::double[] as v from s), o as (select *, row_number() over (order by conv_id) as rn from e),
    g as materialized (select x.conv_id as a, y.conv_id as b, list_cosine_similarity(x.v, y.v) as s from e x join e y on x.conv_id < y.conv_id where list_cosine_similarity(x.v, y.v) >= 0.92), h as (select b, list(a) as l from g group by b),
    k as (select 0::bigint as rn, []::bigint[] as kept union all select k.rn + 1, case when list_has_any(k.kept, coalesce(h.l, []::bigint[])) then k.kept else list_append(k.kept, o.conv_id) end from k join o on o.rn = k.rn + 1 left join h on h.b = o.conv_id),
    z as (select unnest(kept) as id from k where rn = (select max(rn) from k)), p as (select b, min(a) as pivot from g where a in (select id from z) group by b),
    d as (select e.conv_id, case when e.conv_id in (select id from z) then null when (select s from g where g.a = p.pivot and g.b = e.conv_id) >= 0.99 then 'exact_dup' else 'semantic_dup' end as dup from e left join p on p.b = e.conv_id),
    c as (select r.conv_id, d.dup, case when len(r.a) > 0 and len(r.a) <> len(r.u) then 'turn_count_parity' when len(r.a) > 0 and ratio > 0.9 then 'ascii_ratio' end as broken, list_concat(r.u, r.a) as l, r.conv_id::varchar as id from r join d using (conv_id)),
    x as (select *, array_to_string(l, ' ' || chr(10) || ' ') as text, {_JUDGED} from c),
    y as (select *, not ({" or ".join(f"regexp_matches(text, '{p}')" for p in gates.PII_PATTERNS.values())} or len(list_filter({_CARDS}, lambda c: length(c) between 13 and 19 and {_LUHN})) > 0) as clean, round(({_WEIGHTED}) / 1.0, 3) as score from x),
    w2 as (select *, case when dup is not null then dup when broken is not null then broken when not clean then 'pii' end as early from y),
    f2 as (select *, coalesce(early, case when score < 3.5 then 'aggregate_floor' end) as why, early is null as judged from w2),
    m as (select *, judged and cultural_appropriateness < 3 as mapping, why = 'turn_count_parity' as parity, why = 'ascii_ratio' or judged and (register_consistency < 3 or persona_style_consistency < 3 or naturalness < 3 or property_preservation < 3) as rewrite from f2)
    select conv_id, why is null as valid, why as rule, case when judged then score end as aggregate, case when why is null then '' when why = 'semantic_dup' then 'none' when not (mapping or parity or rewrite or why = 'aggregate_floor') then 'none' else array_to_string(list_filter([case when mapping then 'maps_ref_redo' end,
        case when mapping then 'websearch_cultural' end, case when parity then 'stage1_redecompose' end, case when rewrite then 'stage2_rewrite' end, case when why = 'aggregate_floor' and not (mapping or parity or rewrite) then 'stage2_rewrite' end], lambda x: x is not null), ',') end as actions from m""")
def validate_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gate, with the stand-in models."""
    from dialoom.plans import pipeline

    rows = dialogues(spark, sf_dir).withColumn("_ord", F.col("original_index"))
    out = pipeline.validate(rows, pipeline.Models(judge=models.hash_judge), rules.Limits(ascii_ratio_max=0.9, coherence_floor=-1.0))
    return out.select(_conv(), "valid", F.get("reject_reasons", F.lit(0))["rule"].alias("rule"), F.col("quality.aggregate").alias("aggregate"), F.array_join(F.transform("retry_actions", lambda a: a["action"]), ",").alias("actions"))


# ---- one operator each


def _pick(words: tuple[str, ...], by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (by % len(words)).cast("int") + 1)


_GENDERS = (" Male", "M", "boy", "Woman", "girl ", "f", "other", "")


@query("select c_custkey, ['male', 'male', 'male', 'female', 'female', 'female', 'unknown', 'unknown'][c_custkey % 8 + 1] as gender, ['male', 'male', 'male', 'female', 'female', 'female', '', ''][c_custkey % 8 + 1] as hint from customer")
def normalize_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _pick(_GENDERS, F.col("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", normalize.gender(own).alias("gender"), F.coalesce(personas.gender_hint(own), F.lit("")).alias("hint"))


@query("select c_custkey, ['10s', '20s', '40s,50s,60s,70s,80s,90s', '50s,60s,70s,80s,90s', '60s,70s,80s,90s', '90s', ''][c_custkey % 7 + 1] as buckets from customer")
def age_bucket_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _pick(("Teen", " 20s", "40plus", "older", "60plus", "90s", "none"), F.col("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(personas.age_buckets(own), ",").alias("buckets"))


_ROLES = ("student", "boss", "cat", "stranger", "unheard")


@query("select c_custkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') as keywords from (select c_custkey, list_concat(" + ", ".join("[" + ", ".join(f"[{', '.join(repr(k) for k in personas.KEYWORDS.get(r, ()))}]::varchar[]" for r in _ROLES) + f"][c_custkey % {n} % 5 + 1]" for n in (5, 7)) + ") as l from customer)")
def keyword_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = F.struct(_pick(_ROLES, F.col("c_custkey") % 5).alias("occupation_hint"), _pick(_ROLES, F.col("c_custkey") % 7).alias("role_in_scene"), F.array().cast("array<string>").alias("interests_hints"), F.array().cast("array<string>").alias("personality_traits"))
    return read(spark, sf_dir, "customer").withColumn("s", speaker).select("c_custkey", F.array_join(personas.keyword_hints(F.col("s")), ",").alias("keywords"))


@query("select p_partkey, substr(sha256(p_name), 1, 16) as tie from part")
def stable_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", personas.stable_order(F.col("p_name")).alias("tie"))


@query("select conv_id, md5(string_agg(n || '. ' || role || ': ' || text, chr(10) order by n)) as prompt from (select conv_id, role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn) as n from conversations) group by conv_id")
def dialogue_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.md5(text.numbered_dialogue(F.col("t.role"), F.col("t.text")).cast("binary")).alias("prompt"))


@query(f"{_SIDES} select conv_id, coalesce(array_to_string(list_transform(list_filter(u, lambda x: contains(lower(x), 'the'))[1:2], lambda x: 'user: ' || x), ' | '), '') as context from s")
def reference_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).select(_conv(), lookup.context(F.lit("The"), F.col("source_dialogue")).alias("context"))


@query("select p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i)[1:5], '|') as words from (select p_partkey, list_filter(string_split(replace(lower(p_type || ' ' || p_name || ' ' || p_type), ' ', ','), ','), lambda x: x <> '') as l from part)")
def string_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.replace(F.concat_ws(" ", "p_type", "p_name", "p_type"), F.lit(" "), F.lit(" / "))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(normalize.split_list(own), "|").alias("words"))


@query("select p_partkey, 'brand:' || lower(p_brand) || case when p_size % 2 = 0 then ',other:' || lower(p_type) else '' end as refs from part")
def cultural_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.array(*[F.struct(F.lit(k).alias("type"), t.alias("term")) for k, t in ((" Brand", F.col("p_brand")), ("brand", F.upper("p_brand")), ("thing", F.col("p_type")), ("food", F.lit("absent")), ("food", F.lit(" ")))])
    said = F.concat_ws(" ", F.lit("we saw"), "p_brand", F.when(F.col("p_size") % 2 == 0, F.col("p_type")))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(normalize.cultural_refs(given, said), lambda r: F.concat_ws(":", r["type"], r["term"])), ",").alias("refs"))


@query("select event_id, ['statement,question', 'request,question', 'greeting,question', 'empathy_seeking,question', 'question'][event_id % 5 + 1] as acts from events")
def speech_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _pick(("Inform", "directive", "Thanks", "empathy seeking", "nonsense"), F.col("event_id"))
    return read(spark, sf_dir, "events").select("event_id", F.array_join(normalize.speech_acts(F.array(own, F.lit("question"), own)), ",").alias("acts"))


@query("""with v as (select 'coherence' as key, value as v from events where value is not null union all select 'correctness', event_id % 7 from events), x as (select key, list(v order by v) as l from v group by key)
    select key, round(list_avg(l), 6) as mean, l[round_even(0.5 * (len(l) - 1), 0)::bigint + 1]::double as p50, l[round_even(0.95 * (len(l) - 1), 0)::bigint + 1]::double as p95, len(l) as n from x""")
def reward_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = F.map_filter(F.create_map(F.lit("coherence"), F.col("value"), F.lit("correctness"), (F.col("event_id") % 7).cast("double")), lambda _, v: v.isNotNull())
    rows = read(spark, sf_dir, "events").select(F.struct(reward.alias("reward")).alias("quality"))
    return metrics.rewards(rows).withColumn("mean", F.round("mean", 6))


@query("select count(*) as total, count(distinct case when p_brand <> '' then p_brand end) as distinct_ko, round(avg(case when p_size % 3 = 0 then 1.0 else 0.0 end), 9) as retrieved_share from part")
def mapped_ref_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.struct(F.col("p_brand").alias("ko"), (F.col("p_size") % 3 == 0).alias("retrieved"), F.lit("dict").alias("source"), F.lit("brand").alias("type"))
    found = metrics.mapped_refs(read(spark, sf_dir, "part").select(F.array(ref).alias("mapped_refs")))
    return found.select("total", "distinct_ko", F.round("retrieved_share", 9).alias("retrieved_share"))


@query("select count(*) as total, count(distinct p_type) as distinct_terms, round(count(distinct p_type) / count(*), 4) as ratio, round(entropy(p_brand), 9) as type_entropy from part")
def cultural_ref_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.struct(F.col("p_brand").alias("type"), F.col("p_type").alias("term"))
    rows = read(spark, sf_dir, "part").select(F.struct(F.array(ref).alias("cultural_refs")).alias("dialogue_decomposed"))
    return metrics.cultural_refs(rows).withColumn("type_entropy", F.round("type_entropy", 9))


@query("""with n as (select conv_id, turn, list_filter([case when regexp_matches(c, '[A-Za-z]') then 'latin' end, case when regexp_matches(text, '["''“”]') then 'quotes' end, case when length(c) >= 120 then 'long' end, case when regexp_matches(text, '\\s{2,}') then 'blanks' end, case when regexp_matches(c, '[:;,]$') then 'ending' end], lambda x: x is not null) as n
    from (select *, trim(regexp_replace(text, '\\s+', ' ', 'g')) as c from (select conv_id, turn, coalesce(text, '') as text from conversations))) select conv_id, turn, array_to_string(n, ',') as notes from n where len(n) > 0""")
def quality_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.struct(F.lit(0).alias("index"), F.col("role").alias("speaker"), F.col("text").alias("text"))
    noted = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(dialogue.quality_notes(F.array(turn))).alias("n"))
    return noted.select("conv_id", "turn", F.array_join("n.notes", ",").alias("notes"))


@query(f"{_SIDES} select conv_id, case when len(a) <> len(u) then 'turns: ' || len(a) || ' for ' || len(u) when list_contains(list_transform(a, lambda x: trim(x) = ''), true) then 'an empty turn' end as error from s")
def draft_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.transform("final_dialogue", lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text")))
    return dialogues(spark, sf_dir).select(_conv(), dialogue.normalise_draft(F.col("source_dialogue"), made, F.col("persona"))[1].alias("error"))


@query(f"{_SIDES}, g as (select conv_id, array_to_string(list_concat(u, a), ' ' || chr(10) || ' ') as text from s) select conv_id, not (" + " or ".join(f"regexp_matches(text, '{p}')" for p in gates.PII_PATTERNS.values()) + f" or len(list_filter({_CARDS}, lambda c: length(c) between 13 and 19 and {_LUHN})) > 0) as pii_pass from g")
def guard_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.guard(dialogues(spark, sf_dir), models.always_safe).select(_conv(), F.col("quality.pii_pass").alias("pii_pass"))


@query(f"{_SIDES} select conv_id, md5(array_to_string(u, ' ' || chr(10) || ' ')) as compared, len(k) as tokens from w")
def compared_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = dedup.row_text(F.col("scene.narrative_en"), F.col("source_dialogue"))
    return dialogues(spark, sf_dir).select(_conv(), F.md5(own.cast("binary")).alias("compared"), F.size(text.blank_tokens(metrics.rewrite_text())).cast("long").alias("tokens"))


@query("select doc_id, case when length(text) > 0 then length(regexp_replace(text, '[^0-9A-Za-z]', '', 'g')) / length(text) else 0.0 end <= 0.4 as kept from documents where text is not null")
def document_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", rules.ASCII_FILTER(F.col("text")).alias("kept"))


@query(f"{_SIDES} select 'stage3.phase2' as stage, rule, count(*) as n, min(conv_id::varchar) as example from f where rule is not null group by rule order by n desc, rule limit 10")
def top_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.top_rejects(rules.apply(dialogues(spark, sf_dir), limits=LIMITS))


@query(f"{_SIDES} select conv_id, rule from f where rule is not null")
def reject_diary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = export.reject_diary(rules.apply(dialogues(spark, sf_dir), limits=LIMITS))
    return rows.select(F.col("id").cast("long").alias("conv_id"), F.get("reject_reasons", F.lit(0))["rule"].alias("rule"))


@query(f"{_SIDES} select case rule when 'turn_count_parity' then 'stage1_redecompose' else 'stage2_rewrite' end as action, count(*) as n from f where rule is not null group by 1")
def retry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.retries(retry.derive(rules.apply(dialogues(spark, sf_dir), limits=LIMITS)))
    return found.select(F.explode("by_action").alias("action", "n"))


@query("select c_custkey, case when c_custkey % 2 = 0 then 'formal,' else '' end || ['acquaintance', 'professional', 'friendship', 'unclear'][c_custkey % 4 + 1] || case when abs(c_custkey % 40 - c_nationkey) >= 12 then ',age_gap' else '' end as guidance from customer")
def relationship_guidance(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = lambda age: F.from_json(F.to_json(F.struct(F.struct(age.cast("int").alias("age")).alias("retrieved_persona"))), PERSONA_ENTRY)
    kind = _pick((" Acquaintance", "professional", "friendship", "family"), F.col("c_custkey"))
    own = dialogue.relationship_guidance(kind, F.when(F.col("c_custkey") % 2 == 0, "Formal").otherwise("casual"), F.array(entry(F.col("c_custkey") % 40), entry(F.col("c_nationkey"))))
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(own, ",").alias("guidance"))


@query("select c_custkey, c_name from customer order by substr(sha256('7:' || c_custkey), 1, 16), c_custkey::varchar limit 16")
def sampled_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: 16 rows by a seeded hash."""
    return personas.sample_personas(read(spark, sf_dir, "customer").withColumn("persona_id", F.col("c_custkey").cast("string")), 16, 7).select("c_custkey", "c_name")
