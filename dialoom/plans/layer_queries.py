"""Queries of the other operators of the layers: fields of generators' payloads, the dictionary and its cascade, drafts and polished
turns, prompts, calls of models, and JSON Lines in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import text
from dialoom.operators import dialogue, lookup, mapping_checks, models, normalize
from dialoom.operators.rules import Limits
from dialoom.plans import pipeline
from dialoom.plans.case_queries import _CASES, _as, _key, cases
from dialoom.plans.registry import query, read
from dialoom.plans.schemas import MAPPED_REF, PERSONA_ENTRY, SCENE, SPEAKER, TURN
from dialoom.sources import dictionary, jsonl
from dialoom.sources.scratch import scratch_path


def _pick(words: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (n % len(words)).cast("int") + 1)


def _of(words: tuple[str, ...], n: str) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + f"][{n} % {len(words)} + 1]"


def _any(x: str, words: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({x}, '{w}')" for w in words) + ")"


# ---- fields

_SAID = (" Formal", "PUBLIC ", "intimate", "slang", "", "Casual")


@query(f"select c_custkey, case when r in ('intimate', 'casual', 'formal', 'public') then r else 'casual' end as register from (select c_custkey, lower(trim({_of(_SAID, 'c_nationkey')})) as r from customer)")
def normalize_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", normalize.register(_pick(_SAID, F.col("c_nationkey"))).alias("register"))


@query("select s_suppkey, array_to_string(list_filter(l, lambda x, i: x <> '' and list_position(l, x) = i), ',') as names from (select s_suppkey, [s_name, '', 'N' || s_nationkey, s_name, 'N' || s_suppkey % 25] as l from supplier)")
def unique_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = lambda x: F.concat(F.lit("N"), x.cast("string"))
    own = F.array(F.concat(F.lit(" "), "s_name"), F.lit(" "), nation(F.col("s_nationkey")), F.col("s_name"), nation(F.col("s_suppkey") % 25))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(normalize.unique_speakers(own), ",").alias("names"))


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of parts with a generator's answer as JSON."""
    z, words = F.col("p_size"), F.split("p_name", " ")
    bob = F.struct(F.lit(" Bob ").alias("name_en"), F.when(z % 2 == 0, "Boss").otherwise("").alias("role_in_scene"), F.when(z % 3 == 0, "Man").alias("gender_hint"), F.when(z % 4 == 0, "his Thirties").otherwise("40plus").alias("age_group_hint"), F.when(z % 5 == 0, "Formal").alias("register"),
                   F.struct(F.when(z % 2 == 0, "Love").otherwise("odd").alias("type"), (z / 10).cast("string").alias("intensity")).alias("dominant_emotion"), F.array(F.lit("Calm"), F.lit("calm "), F.col("p_type")).alias("personality_traits"))
    given = F.to_json(F.struct(
        F.array(bob).alias("speakers"), F.struct(F.when(z % 3 == 0, " Home ").alias("setting"), F.col("p_type").alias("relationship_type")).alias("scene"),
        F.struct(F.when(z % 2 == 0, "Public").alias("overall_register"), F.array(F.lit("Inform"), F.lit("nonsense"), F.lit("joke")).alias("speech_acts"), F.array(F.struct(F.lit("Brand").alias("type"), F.upper(F.get(words, F.lit(0))).alias("term")), F.struct(F.lit("thing").alias("type"), F.lit("absent").alias("term"))).alias("cultural_refs")).alias("dialogue_decomposed"),
    ))
    return read(spark, sf_dir, "part").select(
        F.when(z % 4 != 0, F.concat(F.lit("row-"), F.col("p_partkey").cast("string"))).alias("id"), F.col("p_partkey").alias("original_index"), F.concat(words, F.array(F.lit("so?"))).alias("dialogue"),
        F.array(F.lit("Ann"), F.lit("Bob")).alias("speakers"), F.when(z % 2 == 0, F.col("p_type")).alias("narrative"), F.from_json(given, normalize.PAYLOAD).alias("payload"),
    )


@query("""with d as (select p_partkey, p_size as z, p_type, string_split(p_name, ' ') as w from part)
    select p_partkey, case when z % 4 = 0 then 'soda-' else 'row-' end || p_partkey as id, '0 Ann: ' || w[1] || '|1 Bob: ' || w[2] as turns, case when z % 2 = 0 then p_type else '' end as narrative,
        case when z % 3 = 0 then 'home' else 'other' end || ',' || lower(p_type) as scene, case when z % 2 = 0 then 'public' else 'casual' end as register, 'statement,joke' as acts, 'brand:' || lower(w[1]) as refs,
        'Ann other unknown unknown casual neutral 3 |Bob ' || case when z % 2 = 0 then 'boss' else 'other' end || ' ' || case when z % 3 = 0 then 'male' else 'unknown' end || ' ' || case when z % 4 = 0 then '30s' else '40plus' end || ' ' || case when z % 5 = 0 then 'formal' else 'casual' end
        || ' ' || case when z % 2 = 0 then 'joy' else 'neutral' end || ' ' || greatest(1, least(5, round_even(z / 10, 0)))::int || ' calm,' || lower(p_type) as speakers from d""")
def decomposed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generator's payload as rows of the first layer: turns as far as the shorter list reaches, a profile for each speaker, every field in its domain."""
    rows = normalize.decompose(payload_rows(spark, sf_dir), F.col("payload"))
    turns = F.array_join(F.transform("source_dialogue", lambda t: F.concat(t["index"].cast("string"), F.lit(" "), t["speaker"], F.lit(": "), t["text"])), "|")
    who = F.array_join(F.transform("speakers", lambda s: F.concat_ws(" ", s["name_en"], s["role_in_scene"], s["gender_hint"], s["age_group_hint"], s["register"], s["dominant_emotion"]["type"], s["dominant_emotion"]["intensity"].cast("string"), F.array_join(s["personality_traits"], ","))), "|")
    d = F.col("dialogue_decomposed")
    refs = F.array_join(F.transform(d["cultural_refs"], lambda r: F.concat_ws(":", r["type"], r["term"])), ",")
    return rows.select(_key(), "id", turns.alias("turns"), F.col("scene.narrative_en").alias("narrative"), F.concat_ws(",", "scene.setting", "scene.relationship_type").alias("scene"), d["overall_register"].alias("register"), F.array_join(d["speech_acts"], ",").alias("acts"), refs.alias("refs"), who.alias("speakers"))


_CELL = "case p_size % 4 when 0 then '{\"size\": ' || p_size || '}' when 1 then '  ' || p_name || ' ' when 2 then '' else '[' || p_size end"


@query(f"with x as (select p_partkey, {_CELL} as x from part) select p_partkey, x <> '' and json_valid(x) as parsed, case when x = '' or json_valid(x) then null else trim(x) end as rest from x")
def json_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, rest = normalize.json_like(F.expr(_CELL))
    return read(spark, sf_dir, "part").select("p_partkey", parsed.isNotNull().alias("parsed"), rest.alias("rest"))


# ---- dictionary and cascade


@query("""select p_partkey, '"' || p_name || '" ' || p_type || case when p_size % 3 = 0 then '' else ' ' || substr(repeat('say ''' || p_brand || ''' ', p_size), 1, 150) end as asked from part""")
def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    about = F.when(F.col("p_size") % 3 != 0, F.repeat(F.concat(F.lit('say "'), F.col("p_brand"), F.lit('" ')), F.col("p_size")))
    return read(spark, sf_dir, "part").select("p_partkey", lookup.search_text(F.col("p_name"), F.col("p_type"), about).alias("asked"))


@query("select p_name || ' ' || p_partkey as en, p_type as ko, p_brand as type, p_size % 2 = 0 as reviewed from part where p_size % 9 <> 0")
def dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary in one JSON object: notes of its own (keys that begin with _) and values that are no entries are passed over."""
    path = scratch_path(spark, "dictionary")
    part = read(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    value = F.to_json(F.struct(F.col("p_type").alias("ko"), F.col("p_brand").alias("type"), (F.col("p_size") % 2 == 0).alias("reviewed")))
    field = F.concat(F.lit('"'), F.when(F.col("p_size") % 18 == 0, F.concat(F.lit("_"), name)).otherwise(name), F.lit('": '), F.when(F.col("p_size") % 18 == 9, F.lit("3")).otherwise(value))
    whole = part.agg(F.array_join(F.array_sort(F.collect_list(field)), ", ").alias("f")).select(F.concat(F.lit("{"), "f", F.lit("}")))
    whole.coalesce(1).write.text(path)
    return dictionary.read_dictionary(spark, path).select("en", "ko", "type", "reviewed")


_SEEN = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9가-힣\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""with e as (select n_nationkey as ord, n_name as en, '나라' || n_nationkey as ko, n_nationkey % 3 <> 0 as shown from nation), m as (select max(ord) + 1 as ord from e),
    f as (select distinct 'nation ' || c_nationkey % 30 as en, '새' || c_nationkey % 30 as ko from customer), n as (select en, ko from f where {_SEEN.format("en")} not in (select {_SEEN.format("en")} from e where shown))
    select ord::bigint as ord, en, ko, shown as reviewed from e where en not in (select en from n) union all select m.ord::bigint, en, ko, false from n, m""")
def dictionary_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found terms enter as unreviewed entries where no visible entry has their key."""
    k = F.col("n_nationkey")
    entries = read(spark, sf_dir, "nation").select(k.cast("long").alias("ord"), F.col("n_name").alias("en"), F.concat(F.lit("나라"), k.cast("string")).alias("ko"), F.lit("place").alias("type"), F.lit("").alias("notes"), F.when(k % 3 == 0, "retrieved").otherwise("seed").alias("source"), F.lit(False).alias("approximate"), F.lit(False).alias("keep"), (k % 3 != 0).alias("reviewed"))
    number = (F.col("c_nationkey") % 30).cast("string")
    found = read(spark, sf_dir, "customer").select(F.concat(F.lit("nation "), number).alias("en"), F.concat(F.lit("새"), number).alias("ko"), F.lit("place").alias("type"), F.lit("").alias("notes"))
    return dictionary.add_entries(entries, found).select("ord", "en", "ko", "reviewed")


_HASH8 = "[" + ", ".join(f"('0x' || substr(md5(x), {2 * i + 1}, 2))::int / 255.0::double * 2 - 1" for i in range(8)) + "]"


@query(f"""with e as (select p_partkey, p_size as z, p_brand || '. A ' || case when p_size % 2 = 0 then 'food' else 'slang' end || ' referring to ' || case when p_size % 3 = 0 then p_name else '말' || p_size end as x from part where not (p_size % 2 = 0 and p_size % 3 = 0)),
    v as (select p_partkey, x, {_HASH8}::double[] as v from e) select p_partkey, x as passage, round(v[1] / (sqrt(list_inner_product(v, v)) + 1e-9), 6) as first from v""")
def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries without an error flag, embedded by their passage, unit length."""
    z = F.col("p_size")
    entries = read(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("en"), F.when(z % 2 == 0, "food").otherwise("slang").alias("type"), F.when(z % 3 == 0, F.col("p_name")).otherwise(F.concat(F.lit("말"), z.cast("string"))).alias("ko"), F.lit("").alias("notes"))
    index = lookup.build_index(entries, models.embed)
    return index.select("p_partkey", lookup.passage(F.col("en"), F.col("type"), F.col("ko")).alias("passage"), F.round(F.get("vector", F.lit(0)), 6).alias("first"))


_NEAR = {"machinery": "기계", "furniture": "가구"}


@query(f"""select c_custkey, case when kind = 0 then '나라' || c_nationkey when kind = 1 and c_mktsegment in ('MACHINERY', 'FURNITURE') then case c_mktsegment when 'MACHINERY' then '기계' else '가구' end when c_custkey % 2 = 0 then '웹 ' || term else term end as ko,
    case when kind = 0 then 'dict' when kind = 1 and c_mktsegment in ('MACHINERY', 'FURNITURE') then 'retriever' else 'web+llm' end as source, kind <> 0 as retrieved, case when kind = 0 then 'place' when kind = 1 and c_mktsegment in ('MACHINERY', 'FURNITURE') then 'other' else 'person' end as type
    from (select *, c_custkey % 3 as kind, case c_custkey % 3 when 0 then 'Nation ' || c_nationkey when 1 then c_mktsegment else c_name end as term from customer)""".replace("when c_custkey % 2 = 0 then '웹 '", "when length(term) % 2 = 0 then '웹 '"))
def mapping_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary, then vectors, then a resolver that knows some terms."""
    k = F.col("c_custkey")
    one = lambda test: F.when(test, 1.0).otherwise(0.0)
    own = lambda x: F.array(*[one(F.lower(x) == en) for en in _NEAR], one(~F.lower(x).isin(*_NEAR)))
    rows = [(i, en, ko, "other", "") for i, (en, ko) in enumerate(_NEAR.items())]
    index = spark.createDataFrame(rows, "ord long, en string, ko string, type string, notes string").withColumn("_v", own(F.col("en")))
    index = index.withColumnRenamed("_v", "vector")
    entries = dictionary.index(read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("en"), F.concat(F.lit("나라"), F.col("n_nationkey").cast("string")).alias("ko"), F.lit("place").alias("type"), F.lit("").alias("notes"), F.lit("seed").alias("source"), F.lit(False).alias("approximate"), F.lit(False).alias("keep"), F.lit(True).alias("reviewed")))
    term = F.when(k % 3 == 0, F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string"))).when(k % 3 == 1, F.col("c_mktsegment")).otherwise(F.col("c_name"))
    terms = read(spark, sf_dir, "customer").select("c_custkey", term.alias("term"), F.lit("person").alias("type"), F.lit("").alias("context"))
    resolve = lambda t: t.withColumns({"ko": F.when(F.length("term") % 2 == 0, F.concat(F.lit("웹 "), "term")), "notes": F.lit("")})
    out = lookup.map_terms(terms, entries, index, own, resolve)
    return out.select("c_custkey", *[F.col(f"mapped.{c}").alias(c) for c in ("ko", "source", "retrieved", "type")])


@query("""with e as (select lower(p_brand) as k, max_by(p_name, p_partkey) as ko from part where p_size % 3 <> 0 or p_size % 2 = 0 group by 1)
    select p_partkey, coalesce(upper(p_brand) || '>' || e.ko, '') as mapped from part left join e on e.k = lower(p_brand)""")
def mapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The references of whole rows through the dictionary, in order; what nothing maps is left out."""
    from dialoom.plans.queries import _entries

    rows = lookup.map_refs(cases(spark, sf_dir), dictionary.index(_entries(spark, sf_dir)))
    return rows.select(_key(), F.array_join(F.transform("mapped_refs", lambda m: F.concat(m["term"], F.lit(">"), m["ko"])), ",").alias("mapped"))


@query("""with r as (select p_partkey, p_size as z, case when p_size % 2 = 0 then 'brand' else 'food' end as kind, case p_size % 5 when 0 then '' when 1 then p_name when 2 then '게임 ' || p_size when 3 then '말' else '나_나' end as ko from part),
    f as (select *, case when ko = '' or ko = p_name then ['ko_empty_or_same'] else list_filter([case when not regexp_matches(ko, '[가-힣]') then 'non_hangul_ko' end, case when regexp_matches(ko, '[A-Za-z가-힣]+_[A-Za-z가-힣]+') then 'corrupted_token' end, case when contains(ko, '게임') then 'out_of_domain_leak' end], lambda x: x is not null) end as flags from r join part using (p_partkey))
    select p_partkey, array_to_string(case when len(flags) > 0 and z % 3 = 0 then list_append(flags, 'llm_rejected') else flags end, ',') as flags from f""")
def verified_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of every kind; a judge sees the flagged references only, rejects some and fails on others, which lets them pass."""
    z = F.col("p_size")
    ko = F.when(z % 5 == 0, "").when(z % 5 == 1, F.col("p_name")).when(z % 5 == 2, F.concat(F.lit("게임 "), z.cast("string"))).when(z % 5 == 3, "말").otherwise("나_나")
    ref = F.struct(F.col("p_name").alias("term"), ko.alias("ko"), F.when(z % 2 == 0, "brand").otherwise("food").alias("type"), F.lit("").alias("notes"))
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_size", F.get(mapping_checks.validate(_as(F.array(ref), f"array<{MAPPED_REF}>")), F.lit(0))["validation"].alias("validation"))
    judged = mapping_checks.verify_flagged(rows, lambda t: t.withColumns({"rejected": F.when(F.col("p_size") % 4 != 1, F.col("p_size") % 3 == 0).otherwise(F.when(F.col("p_size") % 3 == 0, True)), "reason": F.lit("no")}))
    return judged.select("p_partkey", F.array_join(F.transform("validation", lambda f: f["code"]), ",").alias("flags"))


# ---- drafts


_FORMS = """case z % 5 when 0 then '{"dialogue": ' || l || '}' when 1 then '{"turns": ' || l || '}' when 2 then l when 3 then '"nothing"' else '{"dialogue": []}' end"""


@query(f"""with d as (select p_partkey, p_size as z, p_type, string_split(p_name, ' ') as w from part), g as (select *, z % 17 = 0 as failed, z % 5 >= 3 as formless, z % 7 = 0 as short, z % 11 = 0 as hollow from d)
    select p_partkey, case when failed then 'retry_error' when formless or short or hollow then 'invalid' else 'saved' end as status, case when failed or formless or short or hollow then '' else '0 ' || case when z % 3 = 0 then p_type else 'A' end || ': 말 ' || w[1] || '|1 B: 말 ' || w[2] end as turns from g""")
def draft_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of every form, failed calls, too few turns, empty turns; speakers take their personas' names, texts are cleaned."""
    z = F.col("p_size")
    sizes = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("_k"), "p_size", "p_type")

    def generate(df: DataFrame) -> DataFrame:
        said = F.transform("source_dialogue", lambda t, i: F.struct(F.lit("x").alias("speaker"), F.when((z % 11 == 0) & (i == 1), F.lit("  ")).otherwise(F.concat(F.lit(" 말  "), t["text"])).alias("text")))
        listed = F.to_json(F.when(z % 7 == 0, F.slice(said, 1, 1)).otherwise(said))
        form = F.when(z % 5 == 0, F.concat(F.lit('{"dialogue": '), listed, F.lit("}"))).when(z % 5 == 1, F.concat(F.lit('{"turns": '), listed, F.lit("}"))).when(z % 5 == 2, listed).when(z % 5 == 3, F.lit('"nothing"')).otherwise(F.lit('{"dialogue": []}'))
        return df.withColumns({"payload": F.parse_json(form), "failure": F.when(z % 17 == 0, "timeout")})

    entry = F.struct(F.lit("A").alias("speaker_name_en"), F.struct(F.col("p_type").alias("name")).alias("retrieved_persona"))
    rows = cases(spark, sf_dir).drop("z", "persona", "final_dialogue", "korean_dialogue").join(sizes, F.col("original_index") == F.col("_k"))
    # the source's second speaker answers the first: turns are A, B
    plain = F.transform("source_dialogue", lambda t: t.withField("speaker", F.when(t["index"] == 0, F.when(z % 3 == 0, "A").otherwise("A'")).otherwise("B'")))
    rows = rows.withColumns({"persona": F.when(z % 3 == 0, _as(F.array(entry), f"array<{PERSONA_ENTRY}>")).otherwise(F.array().cast(f"array<{PERSONA_ENTRY}>")), "source_dialogue": plain})
    out = dialogue.draft(rows, lambda df: generate(df), dialogue.Mode("naive_persona"))
    name = lambda x: F.when(x == "x", F.lit(None).cast("string")).otherwise(x)
    turns = F.array_join(F.transform("step3_korean_dialogue", lambda t: F.concat(t["index"].cast("string"), F.lit(" "), F.coalesce(name(t["speaker"]), F.when(t["index"] == 0, "A").otherwise("B")), F.lit(": "), t["text"])), "|")
    parts = dialogue.route(out)
    whole = parts["saved"].unionByName(parts["retry_error"]).unionByName(parts["invalid"])
    return whole.select(_key(), "status", F.when(F.col("status") == "saved", turns).otherwise("").alias("turns"))


_REFINED = ("가자 좋아 hello", "감사합니다", "해봐", "좋은 날", "반갑습니다 고객님", "너는 어디", "")


@query(f"""with d as (select p_partkey, p_size as z, {_of(_REFINED, 'p_size')} as a, {_of(_REFINED, '(p_size // 7)')} as b, ['friendship', 'professional', 'other'][p_size % 3 + 1] as kind, p_size % 2 = 0 as plain from part),
    m as (select *, case when regexp_matches(a, '[A-Za-z]') and plain then '초안 하나' else a end as x, case when regexp_matches(b, '[A-Za-z]') and plain then '초안 둘' else b end as y from d),
    l as (select *, {_any("x", text.POLITE)} as xp, {_any("x", text.CASUAL)} as xc, {_any("y", text.POLITE)} as yp, {_any("y", text.CASUAL)} as yc from m),
    f as (select *, xp and not xc and yc and not yp or xc and not xp and yp and not yc as mixed, kind = 'friendship' and ({_any("x", text.TOO_FORMAL)} or {_any("y", text.TOO_FORMAL)}) or kind = 'professional' and ({_any("x", text.TOO_CASUAL)} or {_any("y", text.TOO_CASUAL)}) as unsuited, z % 5 = 0 as conflict from l)
    select p_partkey, case when a = '' or b = '' then 'invalid' else 'saved' end as status, case when a = '' or b = '' then '' when mixed or unsuited or conflict then case when plain then '초안 하나|초안 둘' else 'draft 하나|draft 둘' end else x || '|' || y end as turns from f""")
def polish_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined turns of one speaker: Latin letters give way to a draft without any, mixed levels, unsuited forms and roles that ages
    contradict bring the whole draft back."""
    z = F.col("p_size")
    a, b = _pick(_REFINED, z), _pick(_REFINED, F.floor(z / 7).cast("int"))
    word = F.when(z % 2 == 0, "초안").otherwise("draft")
    turn = lambda i, x: F.struct(F.lit(i).alias("index"), F.lit("민수").alias("speaker"), x.alias("text"))
    who = lambda role, age: F.struct(F.lit("n").alias("speaker_name_en"), F.struct(F.lit("n").alias("name"), F.lit(age).alias("age")).alias("retrieved_persona"), F.struct(F.lit(role).alias("role_in_scene")).alias("source_speaker_profile"))
    people = F.when(z % 5 == 0, F.array(who("parent", 20), who("child", 30))).otherwise(F.array(who("parent", 50), who("child", 20)))
    rows = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("original_index"), "p_size", F.array(turn(0, F.concat(word, F.lit("  하나"))), turn(1, F.concat(word, F.lit(" 둘")))).cast(f"array<{TURN}>").alias("step3_korean_dialogue"), _as(people, f"array<{PERSONA_ENTRY}>").alias("persona"), F.array().cast(f"array<{SPEAKER}>").alias("speakers"),
        _as(F.struct(_pick(("friendship", "professional", "other"), z).alias("relationship_type")), SCENE).alias("scene"), F.array().cast(f"array<{TURN}>").alias("source_dialogue"), F.array().cast(f"array<{MAPPED_REF}>").alias("mapped_refs"),
        F.from_json(F.lit('{"overall_register": "casual"}'), "struct<overall_register:string>").alias("dialogue_decomposed"), F.create_map().cast("map<string,string>").alias("translation_meta"),
    )
    said = F.to_json(F.array(*[F.struct(F.lit("x").alias("speaker"), x.alias("text")) for x in (a, b)]))
    out = dialogue.polish(rows, lambda df: df.withColumns({"payload": F.parse_json(said), "failure": F.lit(None).cast("string")}))
    return out.select(_key(), "status", F.when(F.col("status") == "saved", F.array_join(F.transform("final_dialogue", lambda t: t["text"]), "|")).otherwise("").alias("turns"))


_SPOKEN = f"{_of(text.POLITE + ('음',), 'p_size')} || ' ' || {_of(text.CASUAL + ('음', '씨', '너는', 'ok'), 'p_partkey')}"


@query(f"""with s as (select p_partkey, p_size, {_SPOKEN} as x from part) select p_partkey, case when {_any("x", text.POLITE)} and {_any("x", text.CASUAL)} then 'mixed' when {_any("x", text.POLITE)} then 'polite' when {_any("x", text.CASUAL)} then 'casual' else 'unknown' end as level,
    {_any("x", text.TOO_FORMAL)} as too_formal, {_any("x", text.TOO_CASUAL)} as too_casual, contains(x, 'ok') as latin, p_size % 3 = 0 as intimate, p_size % 3 = 1 as formal from s""")
def speech_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operators' own markers of Korean levels of speech."""
    x = F.concat(_pick(text.POLITE + ("음",), F.col("p_size")), F.lit("  "), _pick(text.CASUAL + ("음", "씨", "너는", "ok"), F.col("p_partkey")))
    kind = _pick(("friendship", "acquaintance", "other"), F.col("p_size"))
    return read(spark, sf_dir, "part").select("p_partkey", text.speech_level(x).alias("level"), text.too_formal(x).alias("too_formal"), text.too_casual(x).alias("too_casual"), text.has_ascii_letter(x).alias("latin"), dialogue.intimate(kind).alias("intimate"), dialogue.formal(kind).alias("formal"))


@query(f"""{_CASES} select p_partkey, '[task]' || chr(10) || '{dialogue.DRAFT_TASK.replace("'", "''")}' || chr(10) || chr(10) || '[dialogue]' || chr(10) || array_to_string(list_transform(w, lambda x, i: '[' || (i - 1) || '] ' || case when i % 2 = 1 then 'A: ' else 'B: ' end || x), chr(10))
    || chr(10) || chr(10) || '[scene]' || chr(10) || 'setting: ' || lower(p_type) || chr(10) || 'relationship: ' || ['friendship', 'family', 'professional'][z % 3 + 1] || chr(10) || 'topics: ' || chr(10) || 'narrative: ' as head,
    '[references]' || chr(10) || '- ' || term || ' -> ' || ko || ' (' || kind || ')' as refs, '- ' || upper(p_brand) || ' (brand)' || case when z % 8 = 0 then chr(10) || '- ' || p_type || ' (place)' else '' end as culture from j""")
def draft_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of what a generator is given: the task, turns, scene, references mapped or not."""
    rows = cases(spark, sf_dir).select("*", dialogue.draft_prompt().alias("prompt"), dialogue.draft_prompt(dialogue.Mode("direct")).alias("direct"))
    cut = lambda c, since, until: F.regexp_extract(c, rf"(?s){since}(.*?)\n\n\[{until}\]", 1)
    head = F.concat(F.lit("[task]\n"), cut("prompt", r"^\[task\]\n", "speakers"))
    refs = F.concat(F.lit("[references]\n"), cut("prompt", r"\n\[references\]\n", "personas"))
    return rows.select(_key(), head.alias("head"), refs.alias("refs"), F.regexp_extract("direct", r"(?s)\[references\]\n(.*)$", 1).alias("culture"))


@query(r"""with s as (select distinct coalesce(source, '') || '/' || coalesce(lang, '') || '!' as name from documents), t as (select name, regexp_replace(regexp_replace(name, '[^a-zA-Z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') as token from s)
    select name, unnest(['default', 'direct', 'naive_persona']) as mode, unnest(['stage2_rewrite', 'stage2_direct', 'stage2_naive_persona']) || '.jsonl' as draft, 'out' || unnest(['', '.direct', '.naive_persona']) || '.jsonl' as output,
        'out' || unnest(['', '.direct', '.naive_persona']) || '.invalid.jsonl' as queue, case when token = '' then 'row' else token end as token from t""")
def run_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of each mode for every kind of document, and the kind's name as a part of a file's name."""
    names = read(spark, sf_dir, "documents").select(F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("!")).alias("name")).distinct()
    files = [F.struct(*[F.lit(v).alias(c) for c, v in (("mode", m.name), ("draft", m.draft_file), ("output", m.output_file), ("queue", dialogue.queue_path(m.output_file, "invalid")))]) for m in map(dialogue.Mode, dialogue.MODES)]
    return names.select("name", dialogue.dataset_tokens(F.col("name")).alias("token"), F.explode(F.array(*files)).alias("f")).select("name", "token", "f.*")


# ---- calls of models


@query("select s_suppkey, case when s_suppkey % 7 = 0 then null else upper(s_name) end as answer, case when s_suppkey % 7 = 0 then 'ValueError: no answer for ' || s_suppkey end as failure from supplier")
def client_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A client on whole rows, several calls at once; an exception is the row's failure and no other's."""

    def make():
        def call(row: dict) -> dict:
            if row["s_suppkey"] % 7 == 0:
                raise ValueError(f"no answer for {row['s_suppkey']}")
            return {"answer": row["s_name"].upper()}

        return call

    return models.client_model(make, "answer string")(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")).select("s_suppkey", "answer", "failure")


@query("select s_suppkey, reverse(s_name) as answer from supplier")
def scalar_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that takes a batch of texts."""
    own = models.scalar_model(lambda texts: [t[::-1] for t in texts], "string")
    return read(spark, sf_dir, "supplier").select("s_suppkey", own(F.col("s_name")).alias("answer"))


# ---- JSON Lines


def _file(spark: SparkSession, sf_dir: str) -> str:
    """A line for each supplier, in one file in the order of keys: some blank, some broken, some that lack a field."""
    path = scratch_path(spark, "lines")
    k = F.col("s_suppkey")
    good = F.to_json(F.struct(F.concat(F.lit("id-"), (k % 60).cast("string")).alias("id"), F.when(k % 13 != 0, k).alias("original_index"), F.array("s_name").alias("dialogue"), F.array(F.lit("A")).alias("speakers")))
    line = F.when(k % 11 == 0, "  ").when(k % 7 == 0, F.concat(F.lit("{broken "), "s_name")).otherwise(good)
    read(spark, sf_dir, "supplier").select("s_suppkey", line.alias("value")).coalesce(1).sortWithinPartitions("s_suppkey").select("value").write.text(path)
    return path


_LINES = "with l as (select s_suppkey as k, s_name, row_number() over (order by s_suppkey) as line, case when s_suppkey % 11 = 0 then 'blank' when s_suppkey % 7 = 0 then 'not a JSON object' when s_suppkey % 13 = 0 then 'original_index: field required' end as why from supplier)"


@query(f"{_LINES} select line, 'id-' || k % 60 as id, s_name as said, '' as narrative from l where why is null")
def lines_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = jsonl.read_rows(spark, _file(spark, sf_dir), "raw")
    return good.select(F.col("_lineno").alias("line"), "id", F.get("dialogue", F.lit(0)).alias("said"), "narrative")


@query(f"{_LINES} select line, why as error from l where why <> 'blank'")
def lines_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, errors = jsonl.read_rows(spark, _file(spark, sf_dir), "raw")
    return errors.select(F.col("lineno").alias("line"), "error")


@query(f"{_LINES} select distinct 'id-' || k % 60 as id, (select count(*) from l where why is distinct from 'blank') as n from l where why is null or why like 'original%'")
def lines_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers for resuming, broken lines passed over, and the number of lines that are not blank."""
    path = _file(spark, sf_dir)
    return jsonl.ids(spark, path).withColumn("n", F.lit(jsonl.count_rows(spark, path)).cast("long"))


@query("select s_suppkey, s_name, null::varchar as nothing from supplier where s_suppkey % 3 = 0")
def queue_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue that is read, cut down and put back in its own place; nulls are written."""
    path = scratch_path(spark, "queue")
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.lit(None).cast("string").alias("nothing"))
    jsonl.write_rows(rows, path)
    jsonl.replace_rows(spark.read.schema(rows.schema).json(path).where("s_suppkey % 3 = 0"), path)
    return spark.read.schema(rows.schema).json(path)


@query("select 'set-' || c_custkey as id, c_custkey as original_index, c_name as said from customer where c_custkey < 1000 and c_nationkey % 5 <> 0")
def staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged data set: the limit counts positions, rows without turns are then left out."""
    turns = F.when(F.col("c_nationkey") % 5 != 0, F.array("c_name")).otherwise(F.array().cast("array<string>"))
    rows = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("position"), turns.alias("dialogue"), F.array(F.lit("A")).alias("speakers"), F.lit(None).cast("string").alias("narrative"))
    return jsonl.staged_dataset(rows, "some/set:v1", 1000).select("id", "original_index", F.get("dialogue", F.lit(0)).alias("said"))


@query("""with f as (select p_partkey, min(p_partkey) over (partition by p_name) as first from part) select p_partkey, 'exact_dup' as rule, 'near ' || first as detail from f where p_partkey <> first""")
def duplicate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates of earlier rows, named after them; with hashed vectors only equal texts are that near."""
    rows = cases(spark, sf_dir).drop("z").withColumn("_ord", F.col("original_index"))
    out = pipeline.find_duplicates(rows, models.embed, Limits(semantic_cosine=0.99999)).where("not valid")
    reason = F.get("reject_reasons", F.lit(0))
    return out.select(_key(), reason["rule"].alias("rule"), reason["detail"].alias("detail"))
