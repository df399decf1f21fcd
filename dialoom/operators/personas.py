"""Personas for speakers: weighted keyword scores over a partitioned bank, the best few, and one of them by a seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.text import any_of, strip
from dialoom.plans.schemas import PERSONA_ENTRY, RETRIEVED
from dialoom.sources.personas import AGE_BUCKETS, COLUMNS, GENDERS
from dialoom.sources.scratch import checkpointed

# Keywords of occupations, roles, interests and traits; age hints; distributions of ages where there is no hint; tokens
# of calm; ages that suit formal speech.
KEYWORDS = {
    "student": ("학생", "대학생", "조교", "학교", "교육"),
    "teacher": ("교사", "강사", "교수", "교육", "학교"),
    "priest": ("교회", "성당", "종교", "예배", "미사", "신부", "목사", "수녀"),
    "service_staff": ("서비스", "판매", "상점", "매장", "도우미"),
    "boss": ("대표", "임원", "사장", "경영", "관리"),
    "executive": ("대표", "임원", "경영", "관리"),
    "co-founder": ("대표", "창업", "경영", "사업"),
    "pet sitter": ("반려", "동물", "고양이", "강아지", "수의", "펫"),
    "stranger": (),
    "friend": ("친화", "사교", "공감", "대화"),
    "partner": ("연애", "가족", "배우자", "관계"),
    "religion": ("종교", "교회", "성당", "미사", "예배"),
    "spirituality": ("종교", "성찰", "교회", "성당"),
    "pets": ("반려", "동물", "고양이", "강아지", "수의", "펫"),
    "animals": ("동물", "고양이", "강아지", "수의", "반려"),
    "vacation": ("여행", "드라이브", "휴식"),
    "cat": ("고양이", "반려묘", "반려"),
    "listening": ("공감", "대화", "상담"),
    "friendship": ("친구", "공감", "사교"),
    "communication": ("대화", "소통", "상담"),
}
AGE_HINTS = {
    "teen": ("10s",),
    "teens": ("10s",),
    "10s": ("10s",),
    "20s": ("20s",),
    "30s": ("30s",),
    "40s": ("40s",),
    "50s": ("50s",),
    "60s": ("60s",),
    "70s": ("70s",),
    "80s": ("80s",),
    "90s": ("90s",),
    "40plus": ("40s", "50s", "60s", "70s", "80s", "90s"),
    "50plus": ("50s", "60s", "70s", "80s", "90s"),
    "60plus": ("60s", "70s", "80s", "90s"),
    "older": ("50s", "60s", "70s", "80s", "90s"),
}
AGES_STUDENT = {"10s": 0.45, "20s": 0.4, "30s": 0.1, "40s": 0.05}
AGES_SENIOR = {"30s": 0.15, "40s": 0.35, "50s": 0.3, "60s": 0.2}
AGES_ANY = dict(zip(AGE_BUCKETS, (0.08, 0.2, 0.18, 0.15, 0.12, 0.1, 0.08, 0.06, 0.03)))
CALM = ("차분", "신중", "꼼꼼", "정갈", "안정", "침착")
MATURE = ("40대", "50대", "60대", "70대", "80대", "90대")
SEARCHED = ("occupation", "persona", "cultural_background", "skills_and_expertise", "hobbies_and_interests", "summary_text")
IN_OCCUPATION, IN_TEXT, BONUS, POOL = 8.0, 3.0, 0.5, 20


def stable_order(x: Column) -> Column:
    """Orders as the number of the first 16 hexadecimal digits of SHA-256 does."""
    return F.substring(F.sha2(x.cast("binary"), 256), 1, 16)


def uniform(x: Column) -> Column:
    """From 0 to 1 by the first 13 hexadecimal digits of SHA-256; the same for the same text everywhere."""
    return F.conv(F.substring(F.sha2(x.cast("binary"), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)


def gender_hint(x: Column) -> Column:
    low = F.lower(strip(F.coalesce(x, F.lit(""))))
    return F.when(low.isin("male", "man", "m", "boy"), "male").when(low.isin("female", "woman", "f", "girl"), "female")


def age_buckets(x: Column) -> Column:
    """array<string>: the buckets that a hint allows; empty without a hint."""
    low = F.lower(strip(F.coalesce(x, F.lit(""))))
    out = F
    for hint, buckets in AGE_HINTS.items():
        out = out.when(low == hint, F.array(*map(F.lit, buckets)))
    return out.otherwise(F.array().cast("array<string>"))


def _draw(u: Column, weights: dict[str, float]) -> Column:
    total, out = 0.0, F
    for bucket, w in list(weights.items())[:-1]:
        total += w
        out = out.when(u < total, bucket)
    return out.otherwise(list(weights)[-1])


def random_age(speaker: Column, u: Column) -> Column:
    """A bucket by inverse distribution, by role and occupation; u from 0 to 1."""
    role, work = (F.lower(strip(F.coalesce(speaker[f], F.lit("")))) for f in ("role_in_scene", "occupation_hint"))
    return F.when((role == "student") | (work == "student"), _draw(u, AGES_STUDENT)).when(role.isin("teacher", "boss") | work.isin("priest", "executive", "co-founder"), _draw(u, AGES_SENIOR)).otherwise(_draw(u, AGES_ANY))


def keyword_hints(speaker: Column) -> Column:
    """Keywords of occupation, role, interests and traits, first occurrences in order."""
    none = F.array().cast("array<string>")
    named = F.expr("map(" + ", ".join(f"'{k}', cast(array({', '.join(f"'{w}'" for w in words)}) as array<string>)" for k, words in KEYWORDS.items()) + ")")
    terms = F.concat(F.array(speaker["occupation_hint"], speaker["role_in_scene"]), F.coalesce(speaker["interests_hints"], none), F.coalesce(speaker["personality_traits"], none))
    return F.array_distinct(F.flatten(F.transform(terms, lambda t: F.coalesce(F.element_at(named, F.lower(strip(F.coalesce(t, F.lit(""))))), none))))


def score(keywords: Column, register: Column, feeling: Column, occupation: Column, blob: Column, age_bucket: Column) -> Column:
    """8 for a keyword in the occupation, else 3 for one in the text; a half for formal speech with a mature age, a half for calm feelings with a calm text."""
    own = F.aggregate(keywords, F.lit(0.0), lambda s, k: s + F.when(F.contains(occupation, k), F.lit(IN_OCCUPATION)).when(F.contains(blob, k), F.lit(IN_TEXT)).otherwise(F.lit(0.0)))
    formal = F.when((F.lower(strip(F.coalesce(register, F.lit("")))) == "formal") & age_bucket.isin(*MATURE), F.lit(BONUS)).otherwise(F.lit(0.0))
    calm = F.when(F.lower(strip(F.coalesce(feeling, F.lit("")))).isin("neutral", "sadness") & any_of(blob, CALM), F.lit(BONUS)).otherwise(F.lit(0.0))
    return own + F.coalesce(formal, F.lit(0.0)) + F.coalesce(calm, F.lit(0.0))


def blob(columns: tuple[str, ...] = SEARCHED) -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def selection_context(rows: DataFrame, seed: int, key: str = "id") -> DataFrame:
    """One row a speaker: id, pos, speaker, gender, ages, keywords and whether gender or age were drawn."""
    flat = rows.select(F.col(key).alias("id"), F.posexplode("speakers").alias("pos", "speaker"))
    token = F.concat_ws(":", F.lit(str(seed)), F.col("id"), F.col("pos").cast("string"))
    hint, ages = gender_hint(F.col("speaker.gender_hint")), age_buckets(F.col("speaker.age_group_hint"))
    drawn = F.when(uniform(F.concat(token, F.lit(":gender"))) < 0.5, F.lit(GENDERS[0])).otherwise(F.lit(GENDERS[1]))
    return flat.select(
        "id", "pos", "speaker", token.alias("token"), F.coalesce(hint, drawn).alias("gender"), hint.isNull().alias("random_gender"),
        F.when(F.size(ages) > 0, ages).otherwise(F.array(random_age(F.col("speaker"), uniform(F.concat(token, F.lit(":age")))))).alias("ages"),
        (F.size(ages) == 0).alias("random_age"), keyword_hints(F.col("speaker")).alias("keywords"),
    )


def _sorted(x: Column, fields: tuple[str, ...], way: int) -> Column:
    """Structs by some of their fields, ascending (1) or descending (-1); the others, maps among them, have no order."""

    def compare(a, b):
        out = F
        for f in fields:
            out = out.when(a[f] < b[f], F.lit(-way)).when(a[f] > b[f], F.lit(way))
        return out.otherwise(F.lit(0))

    return F.array_sort(x, compare)


#: The fixed keywords, each with its bit in a mask; terms of the two half points beside them.
TERMS = tuple(dict.fromkeys(k for words in KEYWORDS.values() for k in words))
FORMAL, QUIET = "+formal", "+calm"


def keyword_mask(text: str) -> Column:
    """A long with the bits of the keywords that the text, an SQL expression, holds."""
    return F.expr(" | ".join(f"if(contains({text}, '{word}'), {1 << bit}L, 0L)" for bit, word in enumerate(TERMS)))


def persona_classes(bank: DataFrame) -> DataFrame:
    """(persona_id, tie, kind: all of a persona that a score depends on). Each persona's text is searched once, whatever is asked for."""
    texts = bank.select("persona_id", F.col("gender_key").alias("gender"), F.col("age_key").alias("age"), F.coalesce("occupation", F.lit("")).alias("_work"), blob().alias("_blob"), F.coalesce(F.col("age_bucket").isin(*MATURE), F.lit(False)).alias("mature"))
    masks = texts.select("persona_id", "gender", "age", "mature", keyword_mask("_work").alias("work"), keyword_mask("_blob").alias("text"), any_of(F.col("_blob"), CALM).alias("calm"))
    kind = F.struct("gender", "age", "work", F.col("text").bitwiseAND(F.bitwise_not("work")).alias("text"), "calm", "mature")
    return masks.select("persona_id", stable_order(F.col("persona_id")).alias("tie"), kind.alias("kind"))


def _postings(kinds: DataFrame) -> DataFrame:
    """(gender, age, term, kind, points): what each term that a class of personas has is worth to who asks for it."""
    point = lambda test, term, points: f"if({test}, named_struct('term', '{term}', 'points', {points}d), null)"
    found = [f"if(getbit(kind.work, {i}) = 1, named_struct('term', '{w}', 'points', {IN_OCCUPATION}d), {point(f'getbit(kind.text, {i}) = 1', w, IN_TEXT)})" for i, w in enumerate(TERMS)]
    found += [point(f"kind.{flag}", term, BONUS) for flag, term in (("mature", FORMAL), ("calm", QUIET))]
    flat = kinds.select(F.col("kind.gender").alias("gender"), F.col("kind.age").alias("age"), "kind", F.expr(f"explode(filter(array({', '.join(found)}), x -> x is not null))").alias("p"))
    return flat.select("gender", "age", "kind", "p.*")


def pools(requests: DataFrame, bank: DataFrame, depth: int) -> DataFrame:
    """(request, best, spare): arrays of (score, tie, persona_id). `best` has the first `depth` personas with points by score and tie, both
    descending; `spare` the first `depth` without points by tie, if `best` is not full. requests: (request, gender, ages, keywords, register, feeling).

    An index by keyword: personas that score alike whoever asks are one class, a class has a posting for each of its terms, and a request
    meets only the postings of its own terms. Classes keep their first `depth` members, so no step holds more of a class.
    """
    members = checkpointed(persona_classes(bank))
    kinds = checkpointed(members.groupBy("kind").agg(F.count(F.lit(1)).alias("n")))
    terms = F.concat("keywords", F.when(F.col("register") == "formal", F.array(F.lit(FORMAL))).otherwise(F.array().cast("array<string>")), F.when(F.col("feeling") == "neutral", F.array(F.lit(QUIET))).otherwise(F.array().cast("array<string>")))
    wanted = requests.select("request", "gender", F.explode(F.array_distinct("ages")).alias("age"), terms.alias("terms"))
    scored = wanted.select("request", "gender", "age", F.explode("terms").alias("term")).join(_postings(kinds), ["gender", "age", "term"]).groupBy("request", "kind").agg(F.sum("points").alias("score")).join(kinds, "kind")
    # classes that the better ones leave no room for are out before their members are looked at
    higher = Window.partitionBy("request").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    level = Window.partitionBy("request", "score")
    own = F.least("n", F.lit(depth))
    scored = checkpointed(scored.withColumn("before", F.sum(own).over(higher) - F.sum(own).over(level)).select("request", "kind", "score", "n", "before"))
    first = lambda order: members.withColumn("_r", F.row_number().over(Window.partitionBy("kind").orderBy(order))).where(F.col("_r") <= depth).drop("_r")
    top = lambda rows, order: rows.withColumn("_r", F.row_number().over(Window.partitionBy("request").orderBy(*order))).where(F.col("_r") <= depth).drop("_r")
    entry = F.struct("score", "tie", "persona_id")
    best = top(scored.where(F.col("before") < depth).join(first(F.desc("tie")), "kind").select("request", "score", "tie", "persona_id"), [F.desc("score"), F.desc("tie"), "persona_id"])
    # only requests that points do not fill look at classes without points
    short = wanted.join(scored.groupBy("request").agg(F.sum("n").alias("n")).where(F.col("n") >= depth), "request", "left_anti")
    without = short.join(kinds.select("kind", F.col("kind.gender").alias("gender"), F.col("kind.age").alias("age")), ["gender", "age"]).select("request", "kind").join(scored.select("request", "kind"), ["request", "kind"], "left_anti")
    spare = top(without.join(first(F.col("tie")), "kind").select("request", F.lit(0.0).alias("score"), "tie", "persona_id"), ["tie", "persona_id"])
    lists = lambda rows, name, way: rows.groupBy("request").agg(F.sort_array(F.collect_list(entry), asc=way).alias(name))
    none = F.array().cast("array<struct<score:double,tie:string,persona_id:string>>")
    both = lists(best, "best", False).join(lists(spare, "spare", True), "request", "full")
    return both.select("request", F.coalesce("best", none).alias("best"), F.coalesce("spare", none).alias("spare"))


def select_personas(rows: DataFrame, bank: DataFrame, seed: int = 0, key: str = "id") -> DataFrame:
    """(id, persona: array<PERSONA_ENTRY>), one entry a speaker, no persona twice in a dialogue while its part of the bank has others.

    What a speaker asks for is mostly shared: gender, ages, keywords, formality and calm; it is looked up once, as deep as the longest cast
    can reach. Speakers of a dialogue choose in turn: of the first POOL that are free the best ones, and of these one by the seeded
    hash; where nobody has points, one of the first POOL that are free. Identifiers are chosen first, personas are joined to them.
    """
    asks = selection_context(rows, seed, key)
    formal = F.lower(strip(F.coalesce("speaker.register", F.lit("")))) == "formal"
    calm = F.lower(strip(F.coalesce("speaker.dominant_emotion.type", F.lit("")))).isin("neutral", "sadness")
    asks = asks.withColumns({"register": F.when(formal, "formal").otherwise(""), "feeling": F.when(calm, "neutral").otherwise("")})
    request = ["gender", "ages", "keywords", "register", "feeling"]
    asks = checkpointed(asks.withColumn("request", F.to_json(F.struct(*request))))
    longest = asks.agg(F.max("pos")).first()[0]
    depth = POOL + int(longest or 0)  # whoever comes last finds POOL that are free
    pool = pools(asks.select("request", *request).dropDuplicates(["request"]), bank, depth)
    cast = asks.join(pool, "request", "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "best", "spare"))).alias("cast"))

    def choose(chosen: Column, s: Column) -> Column:
        free = lambda pool: F.slice(F.filter(F.coalesce(pool, F.array().cast("array<struct<score:double,tie:string,persona_id:string>>")), lambda c: ~F.array_contains(F.transform(chosen, lambda e: F.coalesce(e["c"]["persona_id"], F.lit(""))), c["persona_id"])), 1, POOL)
        best, spare = free(s["best"]), free(s["spare"])
        finest = F.filter(best, lambda c: c["score"] == F.get(best, F.lit(0))["score"])
        # spare ones too are counted from the greatest tie
        options = F.when(F.size(finest) > 0, finest).otherwise(F.reverse(spare))
        pick = F.get(options, F.floor(uniform(F.concat(s["token"], F.lit(":pick"))) * F.size(options)).cast("int"))
        return F.concat(chosen, F.array(F.struct(s["pos"].alias("pos"), pick.alias("c"))))

    none = F.array().cast("array<struct<pos:int,c:struct<score:double,tie:string,persona_id:string>>>")
    picked = checkpointed(cast.select("id", F.explode(F.aggregate("cast", none, choose)).alias("e")).where("e.c is not null").select("id", "e.pos", "e.c.persona_id", "e.c.score"))
    extra = F.col("extra").cast("map<string,string>") if "extra" in bank.columns else F.create_map().cast("map<string,string>")
    whom = bank.select("persona_id", F.struct(*COLUMNS, extra.alias("extra")).cast(RETRIEVED).alias("p"))
    whom = whom.join(picked.select("persona_id").distinct(), "persona_id", "left_semi").dropDuplicates(["persona_id"])
    met = picked.join(whom, "persona_id").join(asks.select("id", "pos", "speaker", "gender", "ages", "keywords", "random_age", "random_gender"), ["id", "pos"])
    meta = F.struct(F.col("ages").alias("candidate_age_buckets"), F.col("gender").alias("candidate_gender"), F.col("keywords").alias("keyword_hints"), F.col("score").alias("match_score"), (F.col("score") > 0).alias("matched_by_keywords"), F.col("random_age").alias("selected_random_age_group"), F.col("random_gender").alias("selected_random_gender"), F.create_map().cast("map<string,string>").alias("extra"))
    entry = F.struct(F.col("pos").alias("speaker_index"), F.col("speaker.name_en").alias("speaker_name_en"), F.col("p").alias("retrieved_persona"), meta.alias("selection_metadata"), F.col("speaker").alias("source_speaker_profile")).cast(PERSONA_ENTRY)
    chosen = met.select("id", "pos", entry.alias("e")).groupBy("id").agg(_sorted(F.collect_list(F.struct("pos", "e")), ("pos",), 1).alias("es"))
    every = asks.select("id").distinct().join(chosen, "id", "left")
    return every.select("id", F.coalesce(F.transform("es", lambda x: x["e"]), F.array().cast(f"array<{PERSONA_ENTRY}>")).alias("persona"))


def sample_personas(bank: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n personas by a seeded hash: a top-n, so that each task keeps n rows at most."""
    return bank.orderBy(stable_order(F.concat(F.lit(f"{seed}:"), F.col("persona_id"))), "persona_id").limit(n)


def fallback_entry(pos: Column, speaker: Column) -> Column:
    """PERSONA_ENTRY for a speaker for whom there is none: the speaker's own name, no age."""
    retrieved = F.from_json(F.to_json(F.struct(speaker["name_en"].alias("name"), F.lit("").alias("persona_id"))), RETRIEVED)
    meta = F.struct(
        age_buckets(speaker["age_group_hint"]).alias("candidate_age_buckets"), gender_hint(speaker["gender_hint"]).alias("candidate_gender"), keyword_hints(speaker).alias("keyword_hints"), F.lit(0.0).alias("match_score"),
        F.lit(False).alias("matched_by_keywords"), F.lit(False).alias("selected_random_age_group"), F.lit(False).alias("selected_random_gender"), F.create_map().cast("map<string,string>").alias("extra"),
    )
    return F.struct(pos.cast("int").alias("speaker_index"), speaker["name_en"].alias("speaker_name_en"), retrieved.alias("retrieved_persona"), meta.alias("selection_metadata"), speaker.alias("source_speaker_profile")).cast(PERSONA_ENTRY)


def prompt_context(persona: Column) -> Column:
    """A block of lines for each persona."""
    line = lambda name, x: F.when(F.coalesce(x, F.lit("")) != "", F.concat(F.lit(f"\n  {name}: "), x)).otherwise("")

    def block(e):
        p = e["retrieved_persona"]
        return F.concat(F.lit("- "), e["speaker_name_en"], F.lit(" -> "), p["name"], F.lit(" ("), p["age"].cast("string"), F.lit(", "), F.coalesce(p["sex"], F.lit("")), F.lit(")"), line("occupation", p["occupation"]), line("persona", p["persona"]), line("background", p["cultural_background"]), line("interests", p["hobbies_and_interests"]))

    return F.array_join(F.transform(persona, block), "\n")
