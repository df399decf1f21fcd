"""Row types of the layers, their closed domains, and the checks that a row must pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.text import strip

SCHEMA_VERSION = 4

# The closed domains.
SPEECH_ACTS = ("complaint", "brag", "question", "empathy_seeking", "sarcasm", "joke", "statement", "greeting", "request", "announce", "advice", "other")
REGISTERS = ("intimate", "casual", "formal", "public")
EMOTIONS = ("joy", "anger", "sadness", "fear", "surprise", "disgust", "neutral")
REF_TYPES = ("holiday", "brand", "service", "event", "person", "food", "place", "pop_culture", "meme", "slang", "other")
LAUGHTER = ("lol", "lmao", "rofl", "haha", "none")
EMPHASIS = ("CAPS", "repetition", "punctuation", "emoji", "exclaim", "ellipsis")
AGE_GROUPS = ("teen", "20s", "30s", "40plus", "unknown")
PLATFORMS = ("twitter", "reddit", "instagram", "tiktok", "discord", "sms", "thread")
MAP_SOURCES = ("dict", "retriever", "web+llm")
GENDER_STYLES = ("masc", "fem", "neutral")
RETRY_ACTIONS = ("stage1_redecompose", "maps_ref_redo", "stage2_rewrite", "websearch_cultural", "none")
AXES = ("property_preservation", "naturalness", "cultural_appropriateness", "register_consistency", "persona_style_consistency")

EMOTION = "struct<type:string,intensity:int>"
TURN = "struct<index:int,speaker:string,text:string>"
SPEAKER = f"struct<name_en:string,role_in_scene:string,gender_hint:string,age_group_hint:string,register:string,dominant_emotion:{EMOTION},personality_traits:array<string>,interests_hints:array<string>,occupation_hint:string,speech_style_notes:string>"
SCENE = "struct<narrative_en:string,setting:string,relationship_type:string,topics:array<string>>"
REF = "struct<type:string,term:string>"
FLAG = "struct<code:string,severity:string,message:string>"
MAPPED_REF = f"struct<term:string,ko:string,type:string,source:string,retrieved:boolean,notes:string,validation:array<{FLAG}>>"
DECOMPOSED = f"struct<overall_register:string,overall_emotion:{EMOTION},speech_acts:array<string>,cultural_refs:array<{REF}>>"
PERSONA_V3 = "struct<speaker_ref:string,gender:string,age:string,occupation:string,education:string,marital_status:string,military_status:string,family_type:string,housing:string,major:string,persona_id:string,extra:map<string,string>>"
STYLE_V3 = f"struct<speaker_ref:string,formality:string,emotion:{EMOTION},markers:struct<laughter:string,emphasis:array<string>,sarcasm_marker:boolean>,speech_style_notes:string,extra:map<string,string>>"
RETRIEVED = "struct<name:string,age:int,age_bucket:string,sex:string,normalized_location:string,occupation:string,persona:string,persona_id:string,summary_text:string,career_goals_and_ambitions:string,cultural_background:string,hobbies_and_interests:string,skills_and_expertise:string,extra:map<string,string>>"
SELECTION = "struct<candidate_age_buckets:array<string>,candidate_gender:string,keyword_hints:array<string>,match_score:double,matched_by_keywords:boolean,selected_random_age_group:boolean,selected_random_gender:boolean,extra:map<string,string>>"
PERSONA_ENTRY = f"struct<speaker_index:int,speaker_name_en:string,retrieved_persona:{RETRIEVED},selection_metadata:{SELECTION},source_speaker_profile:{SPEAKER}>"
QUALITY = f"struct<{','.join(f'{a}:int' for a in AXES)},intra_kr_coherence:double,semantic_cosine:double,safety_pass:boolean,pii_pass:boolean,aggregate:double,reward:map<string,double>,judge_reasoning:map<string,string>>"
REASON = "struct<stage:string,rule:string,detail:string,extra:map<string,string>>"
ACTION = "struct<action:string,reason_summary:string,hints:map<string,string>>"
MESSAGE = "struct<role:string,content:string>"

_RAW = "id string, original_index bigint, dialogue array<string>, speakers array<string>, narrative string"
_STAGE1 = f"id string, original_index bigint, source_dialogue array<{TURN}>, speakers array<{SPEAKER}>, scene {SCENE}, dialogue_decomposed {DECOMPOSED}, mapped_refs array<{MAPPED_REF}>"
_STAGE2 = f"{_STAGE1}, final_dialogue array<{TURN}>, step3_korean_dialogue array<{TURN}>, persona array<{PERSONA_ENTRY}>, korean_dialogue_draft array<{TURN}>, korean_dialogue array<{TURN}>, speaker_personas array<{PERSONA_V3}>, speaker_styles array<{STYLE_V3}>, translation_meta map<string,string>"
_STAGE3 = f"{_STAGE2}, quality {QUALITY}, valid boolean, reject_reasons array<{REASON}>, retry_actions array<{ACTION}>, iter int"
_SFT = f"messages array<{MESSAGE}>, metadata struct<source_id:string,domain:string,target_platform:string,target_age_group:string,target_community:string,target_gender_style:string,quality_score:map<string,struct<score:int>>>"
DDL = {"raw": _RAW, "stage1": _STAGE1, "stage2": _STAGE2, "stage3": _STAGE3, "sft": _SFT}

_REQUIRED = {
    "raw": ("original_index", "dialogue", "speakers"),
    "stage1": ("id", "original_index", "source_dialogue", "speakers", "scene", "dialogue_decomposed"),
    "sft": ("messages", "metadata"),
}
_REQUIRED["stage2"] = _REQUIRED["stage3"] = _REQUIRED["stage1"]
_EMPTY = {"array": lambda t: F.array().cast(t), "map": lambda t: F.create_map().cast(t)}


def schema(layer: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[layer])


def one_of(x: Column, domain: tuple[str, ...]) -> Column:
    return x.isin(*domain)


def problems(layer: str) -> Column:
    """array<string>: what is wrong with a row of the layer; empty if nothing is."""
    found = [F.when(F.col(c).isNull(), F.lit(f"{c}: field required")) for c in _REQUIRED[layer]]
    if layer in ("stage1", "stage2", "stage3"):
        d = F.col("dialogue_decomposed")

        def bad(x: Column, message: str) -> None:
            found.append(F.when(F.coalesce(x, F.lit(False)), F.lit(message)))

        bad(~one_of(d["overall_register"], REGISTERS), "dialogue_decomposed.overall_register: not in its domain")
        bad(~one_of(d["overall_emotion"]["type"], EMOTIONS), "dialogue_decomposed.overall_emotion.type: not in its domain")
        bad(~d["overall_emotion"]["intensity"].between(1, 5), "dialogue_decomposed.overall_emotion.intensity: not from 1 to 5")
        bad(F.exists(d["speech_acts"], lambda x: ~one_of(x, SPEECH_ACTS)), "dialogue_decomposed.speech_acts: not in their domain")
        bad(F.exists(d["cultural_refs"], lambda x: ~one_of(x["type"], REF_TYPES)), "dialogue_decomposed.cultural_refs.type: not in its domain")
        bad(F.exists("speakers", lambda s: ~one_of(s["register"], REGISTERS) | ~one_of(s["age_group_hint"], AGE_GROUPS)), "speakers: register or age group not in its domain")
        bad(F.exists("mapped_refs", lambda m: ~one_of(m["type"], REF_TYPES) | ~one_of(m["source"], MAP_SOURCES)), "mapped_refs: type or source not in its domain")
        bad(F.exists("source_dialogue", lambda t: t["index"].isNull() | t["text"].isNull() | t["speaker"].isNull()), "source_dialogue: incomplete turn")
    if layer == "stage3":
        for axis in AXES:
            found.append(F.when(F.coalesce(~F.col("quality")[axis].between(1, 5), F.lit(False)), F.lit(f"quality.{axis}: not from 1 to 5")))
    return F.filter(F.array(*found), lambda p: p.isNotNull())


def with_defaults(df: DataFrame, layer: str, keep: list[str] | None = None) -> DataFrame:
    """Missing columns are added, null lists and maps become empty, other defaults are filled in; columns in `keep` stay in front."""
    fixed = {"valid": F.lit(True), "iter": F.lit(0), "narrative": F.lit("")}
    out = []
    for field in schema(layer).fields:
        c = (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType)
        kind = field.dataType.typeName()
        if kind in _EMPTY:
            c = F.coalesce(c, _EMPTY[kind](field.dataType))
        elif field.name in fixed:
            c = F.coalesce(c, fixed[field.name])
        elif field.name == "quality":
            c = F.coalesce(c, F.from_json(F.lit("{}"), field.dataType))
        out.append(c.alias(field.name))
    return df.select(*(keep or []), *out)


def mirror(df: DataFrame) -> DataFrame:
    """If exactly one of final_dialogue and korean_dialogue has turns, the other takes them."""
    a, b = F.col("final_dialogue"), F.col("korean_dialogue")
    none = lambda x: F.coalesce(F.size(x), F.lit(0)) <= 0
    return df.withColumns({"final_dialogue": F.when(none(a) & ~none(b), b).otherwise(a), "korean_dialogue": F.when(none(b) & ~none(a), a).otherwise(b)})


def row_id(given: Column, index: Column) -> Column:
    return F.coalesce(F.when(given != "", given), F.concat(F.lit("soda-"), index.cast("string")))


def cast_down(df: DataFrame, layer: str) -> DataFrame:
    """A later layer's rows as rows of an earlier one."""
    return df.select(*[f.name for f in schema(layer).fields])


def any_true(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def nonempty(x: Column) -> Column:
    return F.coalesce(strip(x) != "", F.lit(False))
