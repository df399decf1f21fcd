"""Token counts of whole texts: batches of about equal bytes through the tokenizer's own library, lengths alone come back.

Null texts are empty: no bytes, no tokens. Every row gives a row, so repeated and tied rows are counted each; an empty table gives none.
Texts of any length are counted whole: long ones are cut where no token can cross, and where there is no such place they are
encoded in one piece. Columns of docs named n_bytes, n_tokens or over_limit give way to the new ones; all others are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import table
from dialoom.llm.tokens import Encoder, vocabulary_path

DEFAULT_MODEL = "piece_bpe_32k.model"
#: Bytes of one call of the library, about; characters after which a text is cut at the next safe place.
BATCH_BYTES, PART_CHARS = 1 << 20, 1 << 14
#: How sentencepiece writes a blank (fixed value).
BLANK = "▁"


class PieceCounter:
    """Counts by a sentencepiece model.

    A text may be cut at a single blank between two other characters if no piece holds a blank after another character: the blank
    starts a token, and the model puts it back in front of the next part. It may be cut before a line end if no piece holds one: the
    blank that the model puts in front is then a token of its own, and is taken off. Models that do otherwise get whole texts.
    """

    def __init__(self, path: str, part_chars: int = PART_CHARS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto())
        own = spec.normalizer_spec
        plain = own.add_dummy_prefix and own.escape_whitespaces and not own.remove_extra_whitespaces and not own.precompiled_charsmap
        plain = plain and spec.trainer_spec.model_type == spec.trainer_spec.BPE and not spec.trainer_spec.treat_whitespace_as_suffix
        pieces = [p.piece for p in spec.pieces]
        self.part_chars = part_chars
        self.cut: re.Pattern | None = None
        if plain and not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces) and not any(p.type == p.USER_DEFINED for p in spec.pieces):
            lines = "" if any("\n" in p for p in pieces) else rf"|(?<=[^\s{BLANK}])(?=\n)"
            self.cut = re.compile(rf"(?<=[^\s{BLANK}]) (?=[^\s{BLANK}]){lines}")

    def parts(self, text: str) -> tuple[list[str], int]:
        """The parts of a text, and the tokens that their counts have too many."""
        out, extra, at = [], 0, 0
        while self.cut and len(text) - at > self.part_chars:
            found = self.cut.search(text, at + self.part_chars)
            if not found:
                break
            out.append(text[at : found.start()])
            extra += found.start() == found.end()
            at = found.end()
        return [*out, text[at:] if at else text], extra

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]


class VocabularyCounter:
    """Counts by a vocabulary of the tokenizers library; Encoder cuts texts at blanks itself."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)

    def parts(self, text: str) -> tuple[list[str], int]:
        return [text], 0

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(self.encoder.encode(t)) for t in texts]


def counter(path: str) -> PieceCounter | VocabularyCounter:
    return PieceCounter(path) if path.endswith(".model") else VocabularyCounter(path)


def lengths(texts: pa.Array, by: PieceCounter | VocabularyCounter, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Tokens of each text. The library is called with parts of about batch_bytes together, however many rows these come from."""
    out = np.zeros(len(texts), np.int64)
    held: list[str] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        np.add.at(out, owners, by.lengths(held))
        held.clear(), owners.clear()

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for row in np.flatnonzero(sizes):
        parts, extra = by.parts(texts[row].as_py())
        out[row] -= extra
        for part in parts:
            held.append(part)
            owners.append(row)
            size += sizes[row] / len(parts)
            if size >= batch_bytes:
                flush()
                size = 0
    if held:
        flush()
    return out


def token_count(text: Column, path: str, batch_bytes: int = BATCH_BYTES) -> Column:
    """Tokens of a text, as a long; null texts count 0."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by = counter(path)
        for texts in batches:
            yield pa.array(lengths(texts, by, batch_bytes), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096, text: str = "text") -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit). Nothing is shuffled; no ids leave the tasks."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": token_count(whole, path or vocabulary_path(DEFAULT_MODEL))})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op13_token_counts": op13_token_counts}
SQL: dict[str, str] = {}
