"""Queries over rows of the third layer that have references, personas, second variants and scores, so that every rule and branch occurs.

A row is made of a part: the words of its name are the source's turns, and its size decides what is wrong with it. The SQL builds the
same row from the same columns and states each rule for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import stats
from dialoom.operators import gates, metrics, models, retry, rules
from dialoom.operators.dedup import checkpointed
from dialoom.plans.registry import query, read
from dialoom.plans.schemas import AXES, DECOMPOSED, MAPPED_REF, PERSONA_ENTRY, PERSONA_V3, QUALITY, REASON, SCENE, SPEAKER, TURN, with_defaults

_REGISTERS = ("intimate", "casual", "formal", "public")
_EMOTIONS = ("joy", "anger", "sadness", "fear", "surprise", "disgust", "neutral")
_AGES = ("teen", "20s", "unknown")


def _pick(words: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (n % len(words)).cast("int") + 1)


def _as(x: Column, kind: str) -> Column:
    """A struct or array of fewer fields as one of all fields: by name, what is missing is null."""
    return F.from_json(F.to_json(x), kind)


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    z, words = F.col("p_size"), F.split("p_name", " ")
    who = lambda i: F.when(i % 2 == 0, "A").otherwise("B")
    turn = lambda i, text: F.struct(i.cast("int").alias("index"), who(i).alias("speaker"), text.alias("text"))
    source = F.transform(words, lambda w, i: turn(i, w))
    made = F.transform(words, lambda w, i: F.struct((i + F.when(z % 7 == 0, 1).otherwise(0)).cast("int").alias("index"), who(i).alias("speaker"), F.concat(F.repeat(F.lit("가"), z % 23), w).alias("text")))
    made = F.slice(made, 1, F.when(z % 11 == 0, F.size(words) - 1).otherwise(F.size(words)))
    second = F.when(z % 13 == 0, F.array(turn(F.lit(0), F.col("p_type")), turn(F.lit(1), F.lit("가가가가가"))))
    speakers = F.array(*[F.struct(F.lit(n).alias("name_en"), F.lit("friend").alias("role_in_scene"), _pick(_REGISTERS, z + k).alias("register"), _pick(_AGES, z + k).alias("age_group_hint")) for k, n in enumerate("AB")])
    entry = F.struct(F.when(z % 5 == 0, "C").otherwise("A").alias("speaker_name_en"), F.struct(F.col("p_type").alias("name"), z.alias("age"), F.repeat("p_name", z).alias("summary_text")).alias("retrieved_persona"))
    term = F.when(z % 10 == 0, F.get(words, F.lit(0))).otherwise(F.col("p_brand"))
    ko = F.when(z % 4 == 0, F.get(words, F.lit(0))).when(z % 4 == 1, "가").when(z % 4 == 2, "").otherwise("나")
    mapped = F.struct(term.alias("term"), ko.alias("ko"), F.when(z % 6 == 0, "food").otherwise("brand").alias("type"), F.when(z % 2 == 0, "dict").otherwise("retriever").alias("source"), (z % 2 == 1).alias("retrieved"))
    refs = F.array_compact(F.array(F.struct(F.lit("brand").alias("type"), F.upper("p_brand").alias("term")), F.when(z % 8 == 0, F.struct(F.lit("place").alias("type"), F.col("p_type").alias("term")))))
    whole = F.struct(_pick(_REGISTERS, z).alias("overall_register"), F.struct(_pick(_EMOTIONS, z).alias("type"), F.lit(3).alias("intensity")).alias("overall_emotion"), F.when(z % 2 == 0, F.array(F.lit("joke"), F.lit("question"))).otherwise(F.array(F.lit("statement"))).alias("speech_acts"), refs.alias("cultural_refs"))
    scene = F.struct(F.lit("").alias("narrative_en"), F.lower("p_type").alias("setting"), _pick(("friendship", "family", "professional"), z).alias("relationship_type"))
    reward = F.map_filter(F.create_map(F.lit("coherence"), (z % 5).cast("double"), F.lit("correctness"), F.when(z % 3 == 0, (z % 4).cast("double"))), lambda _, v: v.isNotNull())
    rows = read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("original_index"), z.alias("z"), source.cast(f"array<{TURN}>").alias("source_dialogue"), _as(speakers, f"array<{SPEAKER}>").alias("speakers"),
        _as(scene, SCENE).alias("scene"), _as(whole, DECOMPOSED).alias("dialogue_decomposed"), _as(F.array(mapped), f"array<{MAPPED_REF}>").alias("mapped_refs"), made.cast(f"array<{TURN}>").alias("final_dialogue"), second.cast(f"array<{TURN}>").alias("korean_dialogue"),
        F.when(z % 3 == 0, _as(F.array(entry), f"array<{PERSONA_ENTRY}>")).alias("persona"), _as(F.array(F.struct(F.when(z % 9 == 0, "Z").otherwise("B").alias("speaker_ref"))), f"array<{PERSONA_V3}>").alias("speaker_personas"),
        _as(F.struct(reward.alias("reward")), QUALITY).alias("quality"), (z % 3).cast("int").alias("iter"),
    )
    return with_defaults(rows, "stage3", ["z"])


def _key() -> Column:
    return F.col("original_index").alias("p_partkey")


_CASES = """with d as (select p_partkey, p_size as z, p_brand, p_type, p_name, string_split(p_name, ' ') as w from part),
    v as (select *, list_transform(w, lambda x: repeat('가', z % 23) || x)[1:len(w) - case when z % 11 = 0 then 1 else 0 end] as f, case when z % 13 = 0 then [p_type, '가가가가가'] else []::varchar[] end as k,
        case when z % 10 = 0 then w[1] else p_brand end as term, case z % 4 when 0 then w[1] when 1 then '가' when 2 then '' else '나' end as ko, case when z % 6 = 0 then 'food' else 'brand' end as kind from d),
    j as (select *, list_filter([array_to_string(f, ' ' || chr(10) || ' '), array_to_string(k, ' ' || chr(10) || ' ')], lambda x: x <> '') as texts, array_to_string(w, ' ' || chr(10) || ' ') as source from v),
    r as (select *, len(f) > 0 and len(f) <> len(w) or len(k) > 0 and len(k) <> len(w) as r1, len(f) > 0 and z % 7 = 0 as r2, case when z % 3 = 0 then z % 5 = 0 else z % 9 = 0 end as r3,
        len(list_filter(texts, lambda x: length(regexp_replace(x, '[^0-9A-Za-z]', '', 'g')) > 0.4 * length(x))) > 0 as r4, ko <> '' and len(list_filter(texts, lambda x: not contains(x, ko))) > 0 as r5,
        lower(p_brand) <> lower(term) or z % 8 = 0 and lower(p_type) <> lower(term) as r6, not regexp_matches(ko, '[가-힯]') as r7, case when z % 8 = 0 and lower(p_type) = lower(term) then true else lower(term) = lower(p_brand) and kind <> 'brand' end as r8, not contains(lower(source), lower(term)) as r9 from j),
    n as (select *, list_filter([case when r1 then 'turn_count_parity' end, case when r2 then 'turn_index_order' end, case when r3 then 'speaker_ref_integrity' end, case when r4 then 'ascii_ratio' end, case when r5 then 'mapped_ref_surface' end,
        case when r6 then 'cultural_ref_coverage' end, case when r7 then 'mapped_ref_ko_hangul' end, case when r8 then 'mapped_ref_type_consistency' end], lambda x: x is not null) as failed from r)"""


@query(f"{_CASES} select p_partkey, array_to_string(case when r9 then list_append(failed, 'mapped_ref_terms_in_source') else failed end, ',') as failed from n")
def rule_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule for itself, the one that is off by default included."""
    found = F.filter(F.array(*[F.when(rule(rules.Limits()).isNotNull(), F.lit(name)) for name, rule in rules.RULES + rules.EXTRA]), lambda x: x.isNotNull())
    return cases(spark, sf_dir).select(_key(), F.array_join(found, ",").alias("failed"))


@query(f"{_CASES} select p_partkey, failed[1] as rule, len(failed) = 0 as valid from n")
def rule_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply(cases(spark, sf_dir)).select(_key(), F.get("reject_reasons", F.lit(0))["rule"].alias("rule"), "valid")


@query(f"""{_CASES}, a as (select *, case when len(failed) = 0 then '' when r1 then 'stage1_redecompose' when failed[1] in ('turn_index_order', 'speaker_ref_integrity', 'ascii_ratio', 'mapped_ref_surface') then 'stage2_rewrite' else 'maps_ref_redo,websearch_cultural' end as actions from n)
    select p_partkey, failed[1] as rule, actions from a where actions <> ''""")
def rule_retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows rejected by a rule, with what to try next."""
    queued = retry.queue(retry.derive(checkpointed(rules.apply(cases(spark, sf_dir)))))
    return queued.select(_key(), F.get("reject_reasons", F.lit(0))["rule"].alias("rule"), F.array_join(F.transform("retry_actions", lambda a: a["action"]), ",").alias("actions"))


@query("""select p_partkey, length(regexp_replace(p_name, '[^0-9A-Za-z]', '', 'g')) / length(p_name) <= 0.4 or regexp_matches(case when p_size % 2 = 0 then '가' else '' end || p_name, '[가-힯]') as kept from part""")
def filter_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two document filters, one or the other."""
    body = F.concat(F.when(F.col("p_size") % 2 == 0, "가").otherwise(""), F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", (rules.ASCII_FILTER(F.col("p_name")) | rules.HANGUL_FILTER(body)).alias("kept"))


# ---- what to try next

#: (stage, rule) of a row's reason, by its size; none for the first.
REASONS = ((None, None), ("phase3", "safety"), ("phase1", "near_dup"), ("phase2", "cultural_ref_coverage"), ("phase2", "turn_count_parity"), ("phase2", "ascii_ratio"), ("phase4", "intra_kr_coherence"), ("phase5", "aggregate_floor"), ("phase5", "axis_floor"), ("phase3", "pii"), ("phase4", "en_ko_mapping_cosine"), ("phase1", "semantic_dup"))


def reasoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with one reason or none, and scores of two axes for some."""
    z, key = F.col("p_size"), F.col("p_partkey")
    of = lambda i: F.element_at(F.array(*[F.lit(r[i]) for r in REASONS]), (z % len(REASONS)).cast("int") + 1)
    reason = F.struct(F.concat(F.lit("stage3."), of(0)).alias("stage"), of(1).alias("rule"), F.lit("").alias("detail"))
    none = F.array().cast(f"array<{REASON}>")
    quality = F.struct(F.when(key % 4 == 0, z % 6).alias("cultural_appropriateness"), F.when(key % 5 == 0, z % 7).alias("register_consistency"), (z / 10).alias("aggregate"))
    rows = read(spark, sf_dir, "part").select(key.cast("string").alias("id"), key.alias("original_index"), _as(quality, QUALITY).alias("quality"), F.when(of(0).isNull(), none).otherwise(_as(F.array(reason), f"array<{REASON}>")).alias("reject_reasons"), of(0).isNull().alias("valid"), (z % 3).cast("int").alias("iter"))
    return with_defaults(rows, "stage3")


def _sql_list(i: int) -> str:
    return "[" + ", ".join("null" if r[i] is None else f"'{r[i]}'" for r in REASONS) + f"][p_size % {len(REASONS)} + 1]"


_LOW = "coalesce({0} <> 0 and {0} < 3, false)"
_REASONED = f"""with q as (select p_partkey, p_size, {_sql_list(0)} as stage, {_sql_list(1)} as rule, case when p_partkey % 4 = 0 then p_size % 6 end as cultural, case when p_partkey % 5 = 0 then p_size % 7 end as register from part),
    b as (select *, rule in ('cultural_ref_coverage', 'en_ko_mapping_cosine') or {_LOW.format("cultural")} as mapping, rule = 'turn_count_parity' as parity, rule in ('ascii_ratio', 'intra_kr_coherence') or {_LOW.format("register")} as rewrite from q),
    a as (select *, case when rule is null then [] when rule in ('safety', 'near_dup', 'semantic_dup') then ['none'] when not (mapping or parity or rewrite or rule = 'aggregate_floor') then ['none'] else list_filter([case when mapping then 'maps_ref_redo' end,
        case when mapping then 'websearch_cultural' end, case when parity then 'stage1_redecompose' end, case when rewrite then 'stage2_rewrite' end, case when rule = 'aggregate_floor' and not (mapping or parity or rewrite) then 'stage2_rewrite' end], lambda x: x is not null) end as actions from b)"""


@query(f"{_REASONED} select p_partkey, array_to_string(actions, ',') as actions, case when list_contains(actions, 'maps_ref_redo') then 'cultural_appropriateness' end as axis, case when list_contains(actions, 'stage2_rewrite') and not rewrite then (p_size / 10)::double end as aggregate from a")
def retry_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every branch, with the hints of two actions."""
    rows = retry.derive(reasoned(spark, sf_dir))
    hint = lambda action, key: F.get(F.filter(F.transform("retry_actions", lambda a: F.when(a["action"] == action, F.try_element_at(a["hints"], F.lit(key)))), lambda h: h.isNotNull()), F.lit(0))
    return rows.select(_key(), F.array_join(F.transform("retry_actions", lambda a: a["action"]), ",").alias("actions"), hint("maps_ref_redo", "axis").alias("axis"), hint("stage2_rewrite", "aggregate").cast("double").alias("aggregate"))


@query(f"""{_REASONED} select 'action' as kind, x as key, count(*)::double as value from (select unnest(actions) as x from a) group by 2 union all select 'iter', (p_size % 3)::varchar, count(*)::double from a group by 2
    union all select 'retried', '', count(*)::double from a where p_size % 3 > 0 union all select 'valid_after_retry', '', round(avg(case when rule is null then 1.0 else 0.0 end), 9) from a where p_size % 3 > 0""")
def retry_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = metrics.retries(retry.derive(reasoned(spark, sf_dir)))
    flat = lambda c, kind: F.transform(F.map_entries(c), lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].cast("double").alias("value")))
    single = lambda c: F.array(F.struct(F.lit(c).alias("kind"), F.lit("").alias("key"), F.round(F.col(c).cast("double"), 9).alias("value")))
    return one.select(F.explode(F.concat(flat("by_action", "action"), flat("by_iter", "iter"), single("retried"), single("valid_after_retry"))).alias("r")).select("r.*")


@query(f"""{_REASONED} select p_partkey, stage is null as valid, 0::bigint as n_reasons, 0::bigint as n_actions, coalesce(cultural, -1)::int as cultural from a""")
def cleared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows made ready for another validation: reasons, actions and aggregate go, scores of axes stay. `valid` is what it was."""
    rows = retry.derive(reasoned(spark, sf_dir)).withColumn("_was", F.col("valid"))
    out = retry.cleared(rows).where("valid and quality.aggregate is null")
    return out.select(_key(), F.col("_was").alias("valid"), F.size("reject_reasons").cast("long").alias("n_reasons"), F.size("retry_actions").cast("long").alias("n_actions"), F.coalesce("quality.cultural_appropriateness", F.lit(-1)).alias("cultural"))


_TOOL = "case when list_contains(actions, 'maps_ref_redo') and p_size % 5 <> 0 then true when list_contains(actions, 'stage2_rewrite') and p_size % 2 = 0 then true else false end"


@query(f"""{_REASONED}, m as (select *, {_TOOL} as mended from a where rule is not null and actions <> ['none'])
    select p_partkey, mended as valid, p_size % 3 + 1 as iter from m""")
def repair_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tools that mend what suits them; the loop tries each on a row once, and a row that is mended leaves it."""
    rows = retry.queue(retry.derive(reasoned(spark, sf_dir))).withColumn("_keep", F.struct("reject_reasons", "quality"))
    mark = lambda kind: lambda df: df.withColumn("scene", F.col("scene").withField("setting", F.concat_ws(",", "scene.setting", F.lit(kind))))
    rows = rows.withColumn("scene", _as(F.struct(F.lit("").alias("setting")), SCENE))
    z = F.col("p_size")

    def again(df: DataFrame) -> DataFrame:
        tried = lambda kind: F.contains("scene.setting", F.lit(kind))
        fixed = tried("refs") & (z % 5 != 0) | tried("text") & (z % 2 == 0)
        return df.withColumns({"valid": fixed, "reject_reasons": F.when(fixed, F.array().cast(f"array<{REASON}>")).otherwise(F.col("_keep.reject_reasons")), "quality": F.col("_keep.quality")})

    sizes = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_size")
    done = retry.repair(rows.join(sizes, "id"), {"maps_ref_redo": mark("refs"), "stage2_rewrite": mark("text")}, again)
    return done.select(_key(), "valid", "iter")


# ---- configuration, gates


_GIVEN = {"axis_floor": 3, "unknown_knob": 1, "weights": {"property": 0.4, "naturalness": 0.1, "cultural": 0.3, "register": 0.1, "persona_style": 0.1, "other": 0.5}}


@query("""select p_partkey, round((0.4 * (p_size % 5) + case when p_size % 3 = 0 then 0 else 0.3 * (p_size % 4) end + 0.1 * (p_size % 2)) / (0.5 + case when p_size % 3 = 0 then 0 else 0.3 end), 3) as aggregate, 3 as axis_floor from part""")
def limits_from_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights from a nested configuration with short names; one axis has no score for some rows, an unknown one weighs nothing."""
    limits, z = rules.Limits.from_dict(_GIVEN), F.col("p_size")
    scores = {"property_preservation": z % 5, "cultural_appropriateness": F.when(z % 3 != 0, z % 4), "naturalness": z % 2, "other": z * 0 + 5}
    return read(spark, sf_dir, "part").select("p_partkey", gates.weighted_mean({a: scores[a] for a in scores if a in AXES}, limits.weights).alias("aggregate"), F.lit(limits.axis_floor).alias("axis_floor"))


_ANSWERS = """case p_size % 6 when 0 then '{"S1": "no", "S2": "no"}' when 1 then '{"S2": "Yes: ' || p_name || '"}' when 2 then 'no object: ' || p_name when 3 then '{"kind": "yes", "S9": "' || p_type || '"}' when 4 then '{"S1": "' || p_name || '", "S2": "oh yes"}' else '' end"""


@query(f"""with a as (select p_partkey, {_ANSWERS} as x from part) select p_partkey, json_valid(x) and len(list_filter(case when json_valid(x) then json_keys(x) else [] end, lambda k: k[1] = 'S' and contains(lower(json_extract_string(x, '$.' || k)), 'yes'))) = 0 as safe from a""")
def safety_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", models.safety_verdict(F.expr(_ANSWERS)).alias("safe"))


@query(f"""{_CASES}, t as (select *, array_to_string(list_concat(w, f, k), ' ' || chr(10) || ' ') as text from j), s as (select *, not contains(text, 'widget') as safe, z % 4 <> 0 as clean from t) select p_partkey, safe as safety_pass, clean as pii_pass, case when not safe then 'safety' when not clean then 'pii' end as rule, md5(text) as seen from s""")
def guard_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both flags on every row, safety before personal data; the text that the guards see."""
    safe = lambda x: ~F.contains(x, F.lit("widget"))
    rows = gates.guard(cases(spark, sf_dir), safe, lambda x: F.col("z") % 4 != 0)
    return rows.select(_key(), F.col("quality.safety_pass").alias("safety_pass"), F.col("quality.pii_pass").alias("pii_pass"), F.get("reject_reasons", F.lit(0))["rule"].alias("rule"), F.md5(gates.guard_text().cast("binary")).alias("seen"))


_BYTES = "[" + ", ".join(f"('0x' || substr(md5(x), {2 * i + 1}, 2))::int / 255.0::double * 2 - 1" for i in range(8)) + "]"


@query(f"""{_CASES}, c as (select p_partkey, case when len(f) > 0 then list_transform(f, lambda x: {_BYTES}::double[]) else list_transform(k, lambda x: {_BYTES}::double[]) end as v from j),
    m as (select p_partkey, case when len(v) < 1 then null when len(v) < 2 then 1.0 else list_avg(list_transform(range(1, len(v)), lambda i: list_cosine_similarity(v[i], v[i + 1]))) end as m from c)
    select p_partkey, round(m, 4) as coherence, m < 0.1 as rejected, m is null as skipped from m""")
def coherence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gates.coherence(cases(spark, sf_dir), models.embed, rules.Limits(coherence_floor=0.1))
    noted = F.try_element_at("quality.judge_reasoning", F.lit("intra_kr_coherence")) == "skipped_no_kr"
    return rows.select(_key(), F.col("quality.intra_kr_coherence").alias("coherence"), F.when(F.col("quality.intra_kr_coherence").isNotNull(), ~F.col("valid")).alias("rejected"), F.coalesce(noted, F.lit(False)).alias("skipped"))


@query(f"""{_CASES}, i as (select *, case when len(f) > 0 then f else k end as v from j)
    select p_partkey, array_to_string(list_transform(w, lambda x, n: case when n % 2 = 1 then 'A: ' else 'B: ' end || x), chr(10)) as en, array_to_string(list_transform(v, lambda x, n: case when n % 2 = 1 then 'A: ' else 'B: ' end || x), chr(10)) as ko,
        term || ' -> ' || ko as refs, case when z % 3 = 0 then case when z % 5 = 0 then 'C: ' else 'A: ' end || p_type || ', ' || z || ', ' || case when length(repeat(p_name, z)) > 120 then substr(repeat(p_name, z), 1, 117) || '...' else repeat(p_name, z) end else '' end as persona,
        ['intimate', 'casual', 'formal', 'public'][z % 4 + 1] as register from i""")
def judge_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = gates.judge_inputs()
    return cases(spark, sf_dir).select(_key(), *[given[n].alias(n) for n in ("en", "ko", "refs", "persona", "register")])


@query(f"""{_CASES}, s as (select *, 1 + z % 5 as a, 1 + z // 5 % 5 as b, len(failed) = 0 as seen from n),
    g as (select *, round((0.2 * a + 0.2 * b + 0.35 * 5) / 0.75, 3) as aggregate, z % 17 = 0 as je, z % 19 = 0 as re from s)
    select p_partkey, case when not seen then failed[1] when je then 'judge_error' when re then 'reward_error' when a < 2 or b < 2 then 'axis_floor' when aggregate < 3.5 then 'aggregate_floor' end as rule,
        case when seen and not je and not re then aggregate end as aggregate, case when seen and not je and not re then 4.0 else (z % 5)::double end as reward from g""")
def judge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows that the rules let pass are scored; calls that fail are reasons of their own."""
    z = F.col("original_index")

    def scores(df: DataFrame) -> DataFrame:
        z = F.col("iter")  # the row's size, see below
        axes = F.create_map(F.lit("property_preservation"), 1 + z % 5, F.lit("naturalness"), 1 + F.floor(z / 5).cast("int") % 5, F.lit("cultural_appropriateness"), F.lit(5)).cast("map<string,int>")
        fails = lambda n: F.when(z % n == 0, "no answer")
        return models.fixed_judge()(df).withColumns({"axes": axes, "judge_error": fails(17), "reward_error": fails(19)})

    rows = rules.apply(cases(spark, sf_dir).withColumn("iter", F.col("z")).drop("z"))
    out = gates.judge(rows, scores)
    return out.select(z.alias("p_partkey"), F.get("reject_reasons", F.lit(0))["rule"].alias("rule"), F.col("quality.aggregate").alias("aggregate"), F.try_element_at("quality.reward", F.lit("coherence")).alias("reward"))


# ---- figures


_FIELDS = {
    "register": "[['intimate', 'casual', 'formal', 'public'][z % 4 + 1]]", "emotion": "[['joy', 'anger', 'sadness', 'fear', 'surprise', 'disgust', 'neutral'][z % 7 + 1]]", "speech_act": "case when z % 2 = 0 then ['joke', 'question'] else ['statement'] end",
    "setting": "[lower(p_type)]", "relationship": "[['friendship', 'family', 'professional'][z % 3 + 1]]", "age_group": "[['teen', '20s', 'unknown'][z % 3 + 1], ['teen', '20s', 'unknown'][(z + 1) % 3 + 1]]",
    "speaker_register": "[['intimate', 'casual', 'formal', 'public'][z % 4 + 1], ['intimate', 'casual', 'formal', 'public'][(z + 1) % 4 + 1]]",
}


@query(f"{_CASES} " + " union all ".join(f"select '{k}' as field, round(entropy(x), 9) as entropy from (select unnest({v}) as x from d)" for k, v in _FIELDS.items()))
def coverage_entropies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.coverage_entropies(cases(spark, sf_dir)).withColumn("entropy", F.round("entropy", 9))


@query(f"{_CASES} select 'source' as kind, case when z % 2 = 0 then 'dict' else 'retriever' end as key, count(*) as n from j group by 2 union all select 'type', kind, count(*) from j group by 2")
def mapped_ref_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = metrics.mapped_refs(cases(spark, sf_dir))
    flat = lambda c: F.transform(F.map_entries(f"by_{c}"), lambda e: F.struct(F.lit(c).alias("kind"), e["key"].alias("key"), e["value"].alias("n")))
    return one.select(F.explode(F.concat(flat("source"), flat("type"))).alias("r")).select("r.*")


def _ranked(values: str) -> str:
    """SQL: mean, p50, p95 and n as rows (section, key, field, value) of values (section, key, v)."""
    return f"""select section, key, unnest(['mean', 'p50', 'p95', 'n']) as field, unnest([round(list_avg(l), 6), l[round_even(0.5 * (len(l) - 1), 0)::bigint + 1]::double, l[round_even(0.95 * (len(l) - 1), 0)::bigint + 1]::double, len(l)::double]) as value from (select section, key, list(v order by v) as l from ({values}) group by 1, 2)"""


@query(f"""{_CASES}, y as (select *, list_filter(string_split(replace(case when len(f) > 0 then texts[1] else array_to_string(k, ' ' || chr(10) || ' ') end, chr(10), ' '), ' '), lambda x: x <> '') as t, case when len(f) > 0 then texts[1] else array_to_string(k, ' ' || chr(10) || ' ') end as body from n where len(failed) = 0),
    g as (select p_partkey, list_distinct(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) as g from y where len(t) > 1),
    o as (select a.p_partkey, b.p_partkey as other, a.g as x, b.g as y from g a join g b on a.p_partkey < b.p_partkey),
    m as (select unnest(range(1, 4)) as n, t from y), u as (select n, array_to_string(t[i:i + n - 1], ' ') as g from m, unnest(range(1, len(t) + 1)) q(i) where i + n - 1 <= len(t))
    select 'rows' as section, key, 'value' as field, v::double as value from (select unnest(['accepted', 'rejected', 'total']) as key, unnest([count(*) filter (where len(failed) = 0), count(*) filter (where len(failed) > 0), count(*)]) as v from n)
    union all {_ranked("select 'rewards' as section, 'coherence' as key, (z % 5)::double as v from y union all select 'rewards', 'correctness', (z % 4)::double from y where z % 3 = 0")}
    union all {_ranked("select 'lengths' as section, 'chars' as key, length(body)::double as v from y union all select 'lengths', 'tokens', len(t) from y union all select 'lengths', 'turns', len(w) from y union all select 'lengths', 'mapped_refs', 1 from y")}
    union all select 'diversity', 'bigram_jaccard', 'value', round(coalesce(avg(1 - len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y)))), 0.0), 6) from o
    union all select 'distinct_n', n::varchar, 'value', round(coalesce(count(distinct g) / nullif(count(g), 0), 0.0), 9) from (select unnest(range(1, 4)) as n) left join u using (n) group by n
    union all """ + " union all ".join(f"select 'entropies', '{k}', 'value', round(entropy(x), 9) from (select unnest({v}) as x from y)" for k, v in _FIELDS.items()) + f"""
    union all select 'cultural_refs', unnest(['total', 'distinct_terms', 'ratio', 'type_entropy']), 'value', unnest([count(*)::double, count(distinct term)::double, round(count(distinct term) / count(*), 4), round(entropy(kind), 9)]) from (select upper(p_brand) as term, 'brand' as kind from y union all select p_type, 'place' from y where z % 8 = 0)
    union all select 'mapped_refs', unnest(['total', 'distinct_ko', 'retrieved_share']), 'value', unnest([count(*)::double, count(distinct case when ko <> '' then ko end)::double, round(avg((z % 2)::double), 9)]) from y
    union all select 'rejects', 'stage3.phase2:' || failed[1], 'value', count(*)::double from n where len(failed) > 0 group by 2
    union all select 'retries', unnest(['retried', 'valid_after_retry']), 'value', unnest([count(*)::double, round(avg(case when len(failed) = 0 then 1.0 else 0.0 end), 9)]) from n where z % 3 > 0""")
def dataset_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report, as rows (section, key, field, value)."""
    rows = checkpointed(retry.derive(rules.apply(cases(spark, sf_dir).drop("z"))))
    one = metrics.compute(rows.where("valid"), rows.where("not valid"))
    cell = lambda section, key, field, value, places=9: F.struct(F.lit(section).alias("section"), key.alias("key"), F.lit(field).alias("field"), F.round(value.cast("double"), places).alias("value"))
    fields = lambda section, *names: [F.array(*[cell(section, F.lit(n), "value", F.col(section)[n]) for n in names])]
    plain = lambda section: [F.transform(F.map_entries(section), lambda e: cell(section, e["key"].cast("string"), "value", e["value"]))]
    figure = lambda section, f: F.transform(F.map_entries(section), lambda e: cell(section, e["key"], f, e["value"][f], 6))
    ranked = lambda section: [figure(section, f) for f in ("mean", "p50", "p95", "n")]
    parts = [
        *fields("rows", "accepted", "rejected", "total"), *ranked("rewards"), *ranked("lengths"), F.array(cell("diversity", F.lit("bigram_jaccard"), "value", F.col("diversity.diversity"), 6)), *plain("distinct_n"), *plain("entropies"),
        *fields("cultural_refs", "total", "distinct_terms", "ratio", "type_entropy"), *fields("mapped_refs", "total", "distinct_ko", "retrieved_share"), *plain("rejects"), *fields("retries", "retried", "valid_after_retry"),
    ]
    return one.select(F.explode(F.concat(*parts)).alias("r")).select("r.*")


@query("select round(list_avg(l), 6) as mean, l[round_even(0.5 * (len(l) - 1), 0)::bigint + 1] as p50, l[round_even(0.95 * (len(l) - 1), 0)::bigint + 1] as p95, len(l) as n from (select list(p_retailprice order by p_retailprice) as l from part)")
def nearest_rank_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a whole table, without groups."""
    return stats.nearest_rank(read(spark, sf_dir, "part"), "p_retailprice").withColumn("mean", F.round("mean", 6))
