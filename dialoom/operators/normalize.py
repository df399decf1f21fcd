"""From a generator's payload to valid rows: every field is brought into its domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import numbered_dialogue, ordered_distinct, strip
from dialoom.plans.schemas import AGE_GROUPS, EMOTIONS, REF_TYPES, REGISTERS, SPEECH_ACTS, TURN, row_id

# Other names for emotions and speech acts, and parts of age descriptions in the order in which they are tried.
EMOTION_ALIASES = {
    "happiness": "joy", "love": "joy", "excitement": "joy", "frustration": "anger", "annoyance": "anger", "rage": "anger", "grief": "sadness", "melancholy": "sadness",
    "anxiety": "fear", "worry": "fear", "nervousness": "fear", "amazement": "surprise", "shock": "surprise",
}
SPEECH_ACT_ALIASES = {
    "expressive": "statement", "exclamation": "statement", "assertive": "statement", "directive": "request", "commissive": "statement", "declaration": "statement",
    "inform": "statement", "informative": "statement", "thanks": "greeting", "farewell": "greeting", "empathy": "empathy_seeking", "sympathy_seeking": "empathy_seeking",
    "praise": "brag", "boast": "brag",
}
AGE_PARTS = (
    ("teen", ("teen", "13", "14", "15", "16", "17", "18", "19", "youth")),
    ("20s", ("20", "college", "young adult", "twenties")),
    ("30s", ("30", "thirties")),
    ("40plus", ("40", "50", "60", "senior", "elder", "middle-aged")),
)
MALE, FEMALE = ("m", "man", "boy"), ("f", "woman", "girl")

#: What a generator is asked for.
PAYLOAD_SPEAKER = "struct<name_en:string,role_in_scene:string,gender_hint:string,age_group_hint:string,register:string,dominant_emotion:struct<type:string,intensity:string>,personality_traits:array<string>,interests_hints:array<string>,occupation_hint:string,speech_style_notes:string>"
PAYLOAD = f"struct<speakers:array<{PAYLOAD_SPEAKER}>,scene:struct<setting:string,relationship_type:string,topics:array<string>>,dialogue_decomposed:struct<overall_register:string,overall_emotion:struct<type:string,intensity:string>,speech_acts:array<string>,cultural_refs:array<struct<type:string,term:string>>>>"


def renamed(x: Column, names: dict[str, str]) -> Column:
    """x, or what it is another name for: a literal map, looked up on the JVM."""
    table = F.create_map(*[F.lit(s) for kv in names.items() for s in kv])
    return F.coalesce(F.element_at(table, x), x)


def emotion_type(x: Column) -> Column:
    own = renamed(strip(F.lower(F.coalesce(x, F.lit("")))), EMOTION_ALIASES)
    return F.when(own.isin(*EMOTIONS), own).otherwise("neutral")


def intensity(x: Column) -> Column:
    """1 to 5, half-way values to the even one; 3 for what is no number."""
    # NaN is no number either; greatest and least pass over nulls, so these are settled first
    n = F.nanvl(x.try_cast("double"), F.lit(3.0))
    return F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.bround(F.coalesce(n, F.lit(3.0))))).cast("int")


def emotion(kind: Column, strength: Column) -> Column:
    return F.struct(emotion_type(kind).alias("type"), intensity(strength).alias("intensity"))


def register(x: Column) -> Column:
    low = strip(F.lower(F.coalesce(x, F.lit(""))))
    return F.when(low.isin(*REGISTERS), low).otherwise("casual")


def age_group(x: Column) -> Column:
    low = strip(F.lower(F.coalesce(x, F.lit(""))))
    out = F.when(low.isin(*AGE_GROUPS), low)
    for group, parts in AGE_PARTS:
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(low, F.lit(p))
        out = out.when(hit, group)
    return out.otherwise("unknown")


def gender(x: Column) -> Column:
    low = strip(F.lower(F.coalesce(x, F.lit(""))))
    return F.when(low.isin("male", *MALE), "male").when(low.isin("female", *FEMALE), "female").otherwise("unknown")


def string_list(x: Column, most: int = 5) -> Column:
    """Of an array: trimmed, in lower case, first occurrences, the first `most`."""
    return F.slice(ordered_distinct(F.transform(F.coalesce(x, F.array().cast("array<string>")), F.lower)), 1, most)


def split_list(x: Column, most: int = 5) -> Column:
    """Of one string: cut at commas and slashes."""
    return string_list(F.split(F.replace(F.coalesce(x, F.lit("")), F.lit("/"), F.lit(",")), ","), most)


def cultural_refs(x: Column, dialogue: Column) -> Column:
    """(type, term) whose term, in lower case, stands in the dialogue; unknown types become other; first occurrences."""
    empty = F.array().cast("array<struct<type:string,term:string>>")
    low = F.lower(dialogue)

    def one(r):
        kind = strip(F.lower(F.coalesce(r["type"], F.lit(""))))
        return F.struct(F.when(kind.isin(*REF_TYPES), kind).otherwise("other").alias("type"), strip(F.lower(F.coalesce(r["term"], F.lit("")))).alias("term"))

    return F.array_distinct(F.filter(F.transform(F.coalesce(x, empty), one), lambda r: (r["term"] != "") & F.contains(low, r["term"])))


def speech_acts(x: Column) -> Column:
    named = F.transform(F.coalesce(x, F.array().cast("array<string>")), lambda a: renamed(F.replace(strip(F.lower(a)), F.lit(" "), F.lit("_")), SPEECH_ACT_ALIASES))
    return F.array_distinct(F.filter(named, lambda a: a.isin(*SPEECH_ACTS)))


def unique_speakers(x: Column) -> Column:
    return ordered_distinct(F.coalesce(x, F.array().cast("array<string>")))


def speakers(names: Column, payload: Column) -> Column:
    """One profile for each name, in the names' order: the payload's first of exactly that name, else defaults."""
    payload = F.coalesce(payload, F.array().cast(f"array<{PAYLOAD_SPEAKER}>"))

    def profile(name):
        p = F.get(F.filter(payload, lambda s: strip(F.coalesce(s["name_en"], F.lit(""))) == name), F.lit(0))
        text = lambda field, other: F.coalesce(F.nullif(strip(p[field]), F.lit("")), F.lit(other))
        return F.struct(
            name.alias("name_en"), F.lower(text("role_in_scene", "other")).alias("role_in_scene"), gender(p["gender_hint"]).alias("gender_hint"), age_group(p["age_group_hint"]).alias("age_group_hint"),
            register(p["register"]).alias("register"), emotion(p["dominant_emotion"]["type"], p["dominant_emotion"]["intensity"]).alias("dominant_emotion"), string_list(p["personality_traits"]).alias("personality_traits"),
            string_list(p["interests_hints"]).alias("interests_hints"), text("occupation_hint", "").alias("occupation_hint"), text("speech_style_notes", "").alias("speech_style_notes"),
        )

    return F.transform(names, profile)


def turns(names: Column, texts: Column) -> Column:
    """Parallel lists as turns with an index from 0, as far as the shorter reaches."""
    n = F.least(F.size(names), F.size(texts))
    pairs = F.arrays_zip(F.slice(names, 1, n).alias("s"), F.slice(texts, 1, n).alias("t"))
    return F.transform(pairs, lambda p, i: F.struct(i.alias("index"), p["s"].alias("speaker"), p["t"].alias("text"))).cast(f"array<{TURN}>")


def decompose(raw: DataFrame, payload: Column) -> DataFrame:
    """Raw rows and what a generator returned for them (PAYLOAD) as rows of the first layer, without mapped references."""
    p = F.col("_payload")
    dialogue = F.array_join("dialogue", "\n")
    d = p["dialogue_decomposed"]
    scene = F.struct(
        F.coalesce("narrative", F.lit("")).alias("narrative_en"), F.lower(F.coalesce(F.nullif(strip(p["scene"]["setting"]), F.lit("")), F.lit("other"))).alias("setting"),
        F.lower(F.coalesce(F.nullif(strip(p["scene"]["relationship_type"]), F.lit("")), F.lit("other"))).alias("relationship_type"), string_list(p["scene"]["topics"]).alias("topics"),
    )
    whole = F.struct(
        register(d["overall_register"]).alias("overall_register"), emotion(d["overall_emotion"]["type"], d["overall_emotion"]["intensity"]).alias("overall_emotion"),
        speech_acts(d["speech_acts"]).alias("speech_acts"), cultural_refs(d["cultural_refs"], dialogue).alias("cultural_refs"),
    )
    return raw.withColumn("_payload", payload).select(
        row_id(F.col("id"), F.col("original_index")).alias("id"), "original_index", turns(F.col("speakers"), F.col("dialogue")).alias("source_dialogue"),
        speakers(unique_speakers(F.col("speakers")), p["speakers"]).alias("speakers"), scene.alias("scene"), whole.alias("dialogue_decomposed"),
    )


def json_like(x: Column) -> tuple[Column, Column]:
    """(variant where x parses, else null; the stripped text where it does not and is not empty)."""
    parsed = F.try_parse_json(x)
    return parsed, F.when(parsed.isNull(), F.nullif(strip(x), F.lit("")))


def dialogue_prompt(names: Column, texts: Column) -> Column:
    return numbered_dialogue(names, texts)


