"""Text expressions on columns. White space is Unicode's, as str.strip() has it; nulls stay null unless said otherwise."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Text = str | Column

#: Joins turns and narratives (fixed value).
JOINER = " \n "


def col(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Text) -> Column:
    return F.regexp_replace(col(x), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def clean_text(x: Text) -> Column:
    """Runs of white space become one blank; none at the ends; null becomes empty."""
    return strip(F.regexp_replace(F.coalesce(col(x), F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))


def lookup_key(x: Text) -> Column:
    """Lower case; all but Latin letters, digits, Hangul syllables and white space give way to a blank."""
    kept = F.regexp_replace(F.lower(col(x)), r"(?U)[^a-z0-9가-힣\s]", " ")
    return clean_text(kept)


def has_hangul(x: Text) -> Column:
    return F.coalesce(col(x), F.lit("")).rlike("[가-힣]")


def has_hangul_block(x: Text) -> Column:
    """The wider class, with the block's unassigned end."""
    return F.coalesce(col(x), F.lit("")).rlike("[가-힯]")


def has_ascii_letter(x: Text) -> Column:
    return F.coalesce(col(x), F.lit("")).rlike("[A-Za-z]")


def ascii_ratio(x: Text) -> Column:
    """ASCII letters and digits over all code points; 0 for an empty text."""
    n = F.length(col(x))
    return F.when(n > 0, F.length(F.regexp_replace(col(x), "[^0-9A-Za-z]", "")) / n).otherwise(F.lit(0.0))


def blank_tokens(x: Text) -> Column:
    """Line ends count as blanks; cut at single blanks; no empty tokens. Tabs stay inside tokens."""
    return F.filter(F.split(F.replace(F.coalesce(col(x), F.lit("")), F.lit("\n"), F.lit(" ")), " "), lambda t: t != "")


def any_of(x: Column, words: Iterable[str]) -> Column:
    """True if x holds one of the words."""
    return reduce(lambda a, b: a | b, (F.contains(x, F.lit(w)) for w in words), F.lit(False))


def joined_turns(turns: Text) -> Column:
    return F.array_join(F.transform(F.coalesce(col(turns), F.array().cast("array<struct<index:int,speaker:string,text:string>>")), lambda t: F.coalesce(t["text"], F.lit(""))), JOINER)


def ordered_distinct(x: Column) -> Column:
    """Without empty strings and repetitions, first occurrences in order."""
    return F.array_distinct(F.filter(F.transform(x, strip), lambda s: s != ""))


def numbered_dialogue(speakers: Text, texts: Text) -> Column:
    """"1. speaker: text" lines of parallel arrays, as far as the shorter reaches."""
    n = F.least(F.size(col(speakers)), F.size(col(texts)))
    pairs = F.arrays_zip(F.slice(col(speakers), 1, n).alias("s"), F.slice(col(texts), 1, n).alias("t"))
    return F.array_join(F.transform(pairs, lambda p, i: F.concat((i + 1).cast("string"), F.lit(". "), p["s"], F.lit(": "), p["t"])), "\n")


# ---- Korean levels of speech

# Markers of polite and of casual speech, of formality that does not suit intimates, of casualness that does not suit
# formal relations.
POLITE = ("습니다", "습니까", "세요", "해요", "해요.", "이에요", "예요", "드릴게요", "주시겠어요", "주실 수", "괜찮으세요", "하시나요", "감사합니다", "죄송합니다", "알겠습니다")
CASUAL = ("야", "지?", "네.", "거야", "했어", "했지", "할게", "고마워", "미안해", "괜찮아", "몰라", "좋아", "싫어", "맞아", "있어?", "없어?", "거든", "해봐", "가자")
TOO_FORMAL = ("씨", "고객님", "말씀", "감사드립니다", "드리겠습니다", "드시겠어요", "주시겠어요", "괜찮으세요", "하셨습니다", "하실까요", "하시나요", "해 주셔서 감사합니다")
TOO_CASUAL = ("야", "너는", "너가", "네가", "니가", "가자", "좋아?", "뭐해", "왜 그래", "괜찮아?")
INTIMATE = ("friendship", "family", "romantic")
FORMAL = ("professional", "acquaintance")


def speech_level(x: Text, polite: Iterable[str] = POLITE, casual: Iterable[str] = CASUAL) -> Column:
    """polite, casual, mixed or unknown, by the markers that the cleaned text holds."""
    text = clean_text(x)
    p, c = any_of(text, polite), any_of(text, casual)
    return F.when(p & c, "mixed").when(p, "polite").when(c, "casual").otherwise("unknown")


def too_formal(x: Text) -> Column:
    return any_of(clean_text(x), TOO_FORMAL)


def too_casual(x: Text) -> Column:
    return any_of(clean_text(x), TOO_CASUAL)
