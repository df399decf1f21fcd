"""Generating and polishing dialogues: prompts as columns, what models return brought into rows, and the rules for falling back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import CASUAL, FORMAL, INTIMATE, POLITE, clean_text, has_ascii_letter, speech_level, strip, too_casual, too_formal
from dialoom.plans.schemas import TURN, any_true

MODES = ("default", "direct", "naive_persona")
NONE_TEXT = "없음"
TURNS = f"array<{TURN}>"


@dataclass(frozen=True)
class Mode:
    """What a way of running the second layer uses; its files' names follow."""

    name: str = "default"

    def __post_init__(self):
        if self.name not in MODES:
            raise ValueError(f"mode {self.name!r} is none of {', '.join(MODES)}")

    @property
    def persona(self) -> bool:
        return self.name != "direct"

    @property
    def mapped_refs(self) -> bool:
        return self.name == "default"

    @property
    def polish(self) -> bool:
        return self.name == "default"

    @property
    def draft_file(self) -> str:
        return {"default": "stage2_rewrite", "direct": "stage2_direct", "naive_persona": "stage2_naive_persona"}[self.name] + ".jsonl"

    @property
    def output_file(self) -> str:
        return "out.jsonl" if self.name == "default" else f"out.{self.name}.jsonl"


def queue_path(path: str, kind: str) -> str:
    """The side queue of an output: kind is retry-errors or invalid."""
    stem = path.removesuffix(".jsonl")
    return f"{stem}.{kind}.jsonl"


def dataset_token(x: str) -> str:
    import re

    return re.sub(r"[^a-zA-Z0-9._-]+", "-", x).strip("-") or "row"


def dataset_tokens(x: Column) -> Column:
    """dataset_token of a column."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), "[^a-zA-Z0-9._-]+", "-"), "^-+|-+$", "")
    return F.when(plain == "", "row").otherwise(plain)


# ---- prompts


def _lines(x: Column, line: Callable[[Column], Column], sep: str = "\n") -> Column:
    text = F.array_join(F.transform(x, line), sep)
    return F.when(F.coalesce(F.size(x), F.lit(0)) > 0, text).otherwise(F.lit(NONE_TEXT))


def dialogue_context(turns: Column) -> Column:
    return _lines(turns, lambda t: F.concat(F.lit("["), t["index"].cast("string"), F.lit("] "), F.coalesce(t["speaker"], F.lit("")), F.lit(": "), F.coalesce(t["text"], F.lit(""))))


def speaker_context(speakers: Column) -> Column:
    text = lambda x: F.coalesce(x, F.lit(""))

    def line(s):
        feeling = F.concat(text(s["dominant_emotion"]["type"]), F.lit(" "), F.coalesce(s["dominant_emotion"]["intensity"].cast("string"), F.lit("")))
        parts = [F.concat(F.lit("- "), text(s["name_en"]), F.lit(" ("), text(s["role_in_scene"]), F.lit(")"))]
        for name, value in (("gender", text(s["gender_hint"])), ("age", text(s["age_group_hint"])), ("register", text(s["register"])), ("emotion", feeling), ("traits", F.array_join(s["personality_traits"], ", ")), ("interests", F.array_join(s["interests_hints"], ", ")), ("occupation", text(s["occupation_hint"])), ("style", text(s["speech_style_notes"]))):
            parts.append(F.concat(F.lit(f"; {name}: "), F.coalesce(value, F.lit(""))))
        return F.concat(*parts)

    return _lines(speakers, line)


def refs_context(mapped: Column) -> Column:
    return _lines(mapped, lambda m: F.concat(F.lit("- "), m["term"], F.lit(" -> "), m["ko"], F.lit(" ("), m["type"], F.lit(")"), F.when(F.coalesce(m["notes"], F.lit("")) != "", F.concat(F.lit(": "), m["notes"])).otherwise("")))


def culture_context(refs: Column) -> Column:
    return _lines(refs, lambda r: F.concat(F.lit("- "), r["term"], F.lit(" ("), r["type"], F.lit(")")))


def scene_context(scene: Column) -> Column:
    text = lambda x: F.coalesce(x, F.lit(""))
    return F.concat(F.lit("setting: "), text(scene["setting"]), F.lit("\nrelationship: "), text(scene["relationship_type"]), F.lit("\ntopics: "), F.coalesce(F.array_join(scene["topics"], ", "), F.lit("")), F.lit("\nnarrative: "), text(scene["narrative_en"]))


def profile_context(speakers: Column, persona: Column) -> Column:
    """Speakers and personas side by side by position; either may be longer."""
    both = F.arrays_zip(speakers.alias("s"), persona.alias("p"))

    def block(x):
        p, s = x["p"]["retrieved_persona"], x["s"]
        own = F.concat(F.coalesce(s["name_en"], x["p"]["speaker_name_en"], F.lit("")), F.lit(" ("), F.coalesce(s["role_in_scene"], F.lit("")), F.lit(")"))
        other = F.when(p.isNotNull(), F.concat(F.lit(" -> "), F.coalesce(p["name"], F.lit("")), F.lit(", "), F.coalesce(p["age"].cast("string"), F.lit("")), F.lit(", "), F.coalesce(p["sex"], F.lit("")), F.lit(", "), F.coalesce(p["occupation"], F.lit("")))).otherwise("")
        return F.concat(F.lit("- "), own, other)

    return _lines(both, block, "\n\n")


#: What a turn's draft is marked for.
QUALITY_NOTES = ("latin", "quotes", "long", "blanks", "ending")


def quality_notes(turns: Column) -> Column:
    """array<struct<index, speaker, notes>> of the turns with notes: Latin letters, quotation marks, 120 characters or more, runs of white
    space, an ending in a colon, semicolon or comma."""

    def one(t):
        raw = F.coalesce(t["text"], F.lit(""))
        own = clean_text(raw)
        marks = (has_ascii_letter(own), raw.rlike("[\"'“”]"), F.length(own) >= 120, raw.rlike(r"(?U)\s{2,}"), own.rlike("[:;,]$"))
        return F.struct(t["index"].alias("index"), t["speaker"].alias("speaker"), F.filter(F.array(*[F.when(m, F.lit(n)) for m, n in zip(marks, QUALITY_NOTES)]), lambda n: n.isNotNull()).alias("notes"))

    return F.filter(F.transform(turns, one), lambda x: F.size(x["notes"]) > 0)


def relationship_guidance(relationship: Column, register: Column, persona: Column) -> Column:
    """array<string>: which guidance applies: formal, the kind of relationship, and age_gap from 12 years."""
    ages = F.filter(F.transform(persona, lambda e: e["retrieved_persona"]["age"]), lambda a: a.isNotNull())
    kind = F.lower(strip(F.coalesce(relationship, F.lit(""))))
    gap = (F.size(ages) >= 2) & (F.array_max(ages) - F.array_min(ages) >= 12)
    notes = F.array(F.when(F.lower(strip(F.coalesce(register, F.lit("")))) == "formal", "formal"), F.when(kind.isin("acquaintance", "professional", "friendship"), kind).otherwise("unclear"), F.when(gap, "age_gap"))
    return F.filter(notes, lambda n: n.isNotNull())


def consistency_context(relationship: Column, persona: Column) -> Column:
    """array<string>: the relationship that needs a rule of its own, and "name(age, sex)" of two personas or more."""
    kind = F.lower(strip(F.coalesce(relationship, F.lit(""))))
    rule = F.filter(F.array(F.when(kind.isin("friendship", "family", "romantic", "professional"), kind)), lambda x: x.isNotNull())
    people = F.transform(persona, lambda e: F.concat(F.coalesce(e["retrieved_persona"]["name"], F.lit("")), F.lit("("), F.coalesce(e["retrieved_persona"]["age"].cast("string"), F.lit("")), F.lit("세, "), F.coalesce(e["retrieved_persona"]["sex"], F.lit("")), F.lit(")")))
    return F.concat(rule, F.when(F.size(people) >= 2, people).otherwise(F.array().cast("array<string>")))


#: What a generator is told, in our words: the task, what to keep, what to give back.
DRAFT_TASK = (
    "Rewrite the English dialogue below as one that Koreans would have in the same situation.\n"
    "Keep the number and order of turns, who speaks and what each turn does; do not translate word by word.\n"
    "Speak as the scene, the relationship and each speaker's profile ask for; put the Korean counterparts of the references where the source has them.\n"
    "Write Hangul only, no Latin letters, no explanations.\n"
    'Answer with JSON alone: {"dialogue": [{"speaker": "...", "text": "..."}]}, one entry for each source turn.'
)
POLISH_TASK = (
    "Go over the Korean draft below and make it sound like speech.\n"
    "Change wording, endings and forms of address only where they do not suit the relationship, the profiles or the notes; a turn that is fine stays.\n"
    "Keep the number and order of turns, the speakers, the facts and the mapped references. One speaker keeps one level of speech to one listener.\n"
    "Write Hangul only, no Latin letters, no explanations.\n"
    'Answer with JSON alone: {"dialogue": [{"speaker": "...", "text": "..."}]}, one entry for each turn of the draft.'
)


def draft_prompt(mode: Mode = Mode()) -> Column:
    """What a generator is given for a row of the first layer: the task, then what is known of the row."""
    parts = [("task", F.lit(DRAFT_TASK)), ("dialogue", dialogue_context(F.col("source_dialogue"))), ("scene", scene_context(F.col("scene"))), ("speakers", speaker_context(F.col("speakers")))]
    if mode.mapped_refs:
        parts.append(("references", refs_context(F.col("mapped_refs"))))
    else:
        parts.append(("references", culture_context(F.col("dialogue_decomposed.cultural_refs"))))
    if mode.persona:
        from dialoom.operators.personas import prompt_context

        parts.append(("personas", F.when(F.size("persona") > 0, prompt_context(F.col("persona"))).otherwise(F.lit(NONE_TEXT))))
    return F.concat_ws("\n\n", *[F.concat(F.lit(f"[{n}]\n"), x) for n, x in parts])


def polish_prompt() -> Column:
    join = lambda x: F.array_join(x, "\n")
    kind, register = F.col("scene.relationship_type"), F.col("dialogue_decomposed.overall_register")
    notes = F.transform(quality_notes(F.col("step3_korean_dialogue")), lambda n: F.concat(F.lit("- "), n["index"].cast("string"), F.lit(" / "), n["speaker"], F.lit(": "), F.array_join(n["notes"], ", ")))
    parts = (("task", F.lit(POLISH_TASK)), ("source", dialogue_context(F.col("source_dialogue"))), ("draft", dialogue_context(F.col("step3_korean_dialogue"))), ("references", refs_context(F.col("mapped_refs"))), ("scene", scene_context(F.col("scene"))), ("profiles", profile_context(F.col("speakers"), F.col("persona"))), ("notes", join(notes)), ("guidance", join(relationship_guidance(kind, register, F.col("persona")))), ("consistency", join(consistency_context(kind, F.col("persona")))))
    return F.concat_ws("\n\n", *[F.concat(F.lit(f"[{n}]\n"), x) for n, x in parts])


# ---- drafts


def generated_turns(payload: Column) -> Column:
    """array<struct<speaker,text>> of a variant: a list, or an object's dialogue or turns; null if it is none of these."""
    kind = "array<struct<speaker:string,text:string>>"
    tries = [F.try_variant_get(payload, path, kind) for path in ("$.dialogue", "$.turns", "$")]
    return F.coalesce(*tries)


def normalise_draft(source: Column, generated: Column, persona: Column) -> tuple[Column, Column]:
    """(turns, error). One turn a source turn with the source's index, cleaned; names of English speakers become their persona's, the last
    persona of a name counting. Errors: no turns, another number of turns, an empty text."""
    names = F.coalesce(F.transform(persona, lambda e: F.struct(e["speaker_name_en"].alias("k"), e["retrieved_persona"]["name"].alias("v"))), F.array().cast("array<struct<k:string,v:string>>"))
    pairs = F.filter(names, lambda p: p["k"].isNotNull() & F.coalesce(p["v"] != "", F.lit(False)))
    last = lambda name: F.element_at(F.filter(pairs, lambda p: p["k"] == name), F.when(F.size(F.filter(pairs, lambda p: p["k"] == name)) > 0, F.lit(-1)).otherwise(F.lit(None).cast("int")))["v"]
    both = F.zip_with(source, generated, lambda s, g: F.struct(s["index"].alias("index"), F.coalesce(last(s["speaker"]), last(g["speaker"]), F.nullif(clean_text(g["speaker"]), F.lit("")), s["speaker"]).alias("speaker"), clean_text(g["text"]).alias("text")))
    error = F.when(generated.isNull(), "no turns in the payload").when(F.size(generated) != F.size(source), F.concat(F.lit("turns: "), F.size(generated).cast("string"), F.lit(" for "), F.size(source).cast("string"))).when(F.exists(both, lambda t: t["text"] == ""), "an empty turn")
    return F.when(error.isNull(), both).cast(TURNS), error


def draft(rows: DataFrame, generate: Callable[[DataFrame], DataFrame], mode: Mode = Mode()) -> DataFrame:
    """rows with step3_korean_dialogue, final_dialogue, translation_meta and `status` (saved, retry_error, invalid) and `error`.

    `generate` adds `payload` (variant) and `failure` (string; null where the call worked) to rows with `prompt`.
    """
    base = rows if "persona" in rows.columns else rows.withColumn("persona", F.array().cast("array<struct<speaker_name_en:string,retrieved_persona:struct<name:string>>>"))
    got = generate(base.withColumn("prompt", draft_prompt(mode) if mode.persona and "persona" in rows.columns else draft_prompt(Mode("direct"))))
    turns, error = normalise_draft(F.col("source_dialogue"), generated_turns(F.col("payload")), F.col("persona"))
    meta = F.create_map(F.lit("pipeline_mode"), F.lit(mode.name), F.lit("step3_pipeline"), F.lit(f"step3_{mode.name}"), F.lit("step4_applied"), F.lit(str(mode.polish).lower()))
    out = got.withColumns({"step3_korean_dialogue": F.coalesce(turns, F.array().cast(TURNS)), "_error": error})
    out = out.withColumns({
        "final_dialogue": F.array().cast(TURNS) if mode.polish else F.col("step3_korean_dialogue"), "translation_meta": meta,
        "status": F.when(F.col("failure").isNotNull(), "retry_error").when(F.col("_error").isNotNull(), "invalid").otherwise("saved"), "error": F.coalesce("failure", "_error"),
    })
    return out.drop("prompt", "payload", "failure", "_error")


# ---- polish


def intimate(kind: Column) -> Column:
    return F.coalesce(kind.isin(*INTIMATE), F.lit(False))


def formal(kind: Column) -> Column:
    return F.coalesce(kind.isin(*FORMAL), F.lit(False))


def mixed_levels(turns: Column, polite: tuple[str, ...] = POLITE, casual: tuple[str, ...] = CASUAL) -> Column:
    """True if a speaker has both polite and casual turns."""
    said = F.transform(turns, lambda t: F.struct(clean_text(t["speaker"]).alias("s"), speech_level(t["text"], polite, casual).alias("l")))
    of = lambda level: F.array_distinct(F.transform(F.filter(said, lambda x: (x["l"] == level) & (x["s"] != "")), lambda x: x["s"]))
    return F.coalesce(F.arrays_overlap(of("polite"), of("casual")), F.lit(False))


def role_conflict(persona: Column, speakers: Column) -> Column:
    """True if ages contradict roles: a parent no older than a child, a teacher no older than a student, a boss over five years younger
    than a subordinate. Needs two personas."""
    role_of = lambda name: F.get(F.reverse(F.filter(speakers, lambda s: (F.lower(clean_text(s["name_en"])) == name) & (clean_text(s["role_in_scene"]) != ""))), F.lit(0))["role_in_scene"]
    own = F.transform(persona, lambda e: F.struct(F.coalesce(F.nullif(F.lower(clean_text(e["source_speaker_profile"]["role_in_scene"])), F.lit("")), F.lower(clean_text(role_of(F.lower(clean_text(e["speaker_name_en"])))))).alias("role"), e["retrieved_persona"]["age"].alias("age")))
    ages = lambda role: F.transform(F.filter(own, lambda x: (x["role"] == role) & x["age"].isNotNull()), lambda x: x["age"])
    least, most = (lambda role: F.array_min(ages(role))), (lambda role: F.array_max(ages(role)))
    wrong = any_true([F.coalesce(x, F.lit(False)) for x in (least("parent") <= most("child"), least("teacher") <= most("student"), least("boss") + 5 < most("subordinate"))])
    return F.coalesce(F.size(persona) >= 2, F.lit(False)) & wrong


def falls_back(turns: Column, relationship: Column, persona: Column, speakers: Column) -> Column:
    kind = F.lower(strip(F.coalesce(relationship, F.lit(""))))
    unsuited = F.exists(turns, lambda t: (intimate(kind) & too_formal(t["text"])) | (formal(kind) & too_casual(t["text"])))
    return mixed_levels(turns) | role_conflict(persona, speakers) | F.coalesce(unsuited, F.lit(False))


def normalise_polish(drafted: Column, refined: Column, relationship: Column, persona: Column, speakers: Column) -> tuple[Column, Column]:
    """(turns, error). A refined turn with Latin letters gives way to its draft without any; if what results falls back, the whole draft stands."""
    error = F.when(refined.isNull(), "no turns in the payload").when(F.size(refined) != F.size(drafted), F.concat(F.lit("turns: "), F.size(refined).cast("string"), F.lit(" for "), F.size(drafted).cast("string"))).when(F.exists(refined, lambda t: clean_text(t["text"]) == ""), "an empty turn")

    def turn(d, r):
        text = clean_text(r["text"])
        own = F.when(has_ascii_letter(text) & ~has_ascii_letter(d["text"]), clean_text(d["text"])).otherwise(text)
        return F.struct(d["index"].alias("index"), d["speaker"].alias("speaker"), own.alias("text"))

    made = F.zip_with(drafted, refined, turn)
    plain = cleaned(drafted)
    return F.when(error.isNull(), F.when(falls_back(made, relationship, persona, speakers), plain).otherwise(made)).cast(TURNS), error


def cleaned(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["index"].alias("index"), t["speaker"].alias("speaker"), clean_text(t["text"]).alias("text"))).cast(TURNS)


def polish(rows: DataFrame, refine: Callable[[DataFrame], DataFrame] | None, mode: Mode = Mode()) -> DataFrame:
    """rows with final_dialogue and `status`, `error`. Modes without polish, and no `refine`, take the cleaned draft. An empty result is an error."""
    meta = lambda applied: F.map_concat(F.map_filter(F.coalesce("translation_meta", F.create_map().cast("map<string,string>")), lambda k, _: k != "step4_applied"), F.create_map(F.lit("step4_applied"), F.lit(applied)))
    if not mode.polish or refine is None:
        out = rows.withColumns({"final_dialogue": cleaned(F.col("step3_korean_dialogue")), "translation_meta": meta("false"), "_error": F.lit(None).cast("string"), "failure": F.lit(None).cast("string")})
    else:
        got = refine(rows.withColumn("prompt", polish_prompt()))
        turns, error = normalise_polish(F.col("step3_korean_dialogue"), generated_turns(F.col("payload")), F.col("scene.relationship_type"), F.col("persona"), F.col("speakers"))
        out = got.withColumns({"final_dialogue": turns, "translation_meta": meta("true"), "_error": error}).drop("prompt", "payload")
    wrong = F.coalesce("_error", F.when(F.coalesce(F.size("final_dialogue"), F.lit(0)) <= 0, "an empty dialogue"))
    status = F.when(F.col("failure").isNotNull(), "retry_error").when(wrong.isNotNull(), "invalid").otherwise("saved")
    return out.withColumns({"status": status, "error": F.coalesce("failure", wrong)}).drop("failure", "_error")


def route(rows: DataFrame) -> dict[str, DataFrame]:
    """Rows by status."""
    return {s: rows.where(F.col("status") == s) for s in ("saved", "retry_error", "invalid")}


def unfinished(rows: DataFrame, *done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in none of the tables (columns: id)."""
    out = rows
    for d in done:
        out = out.join(d.select(F.col("id").alias("_done")).distinct(), F.col(key) == F.col("_done"), "left_anti")
    return out
