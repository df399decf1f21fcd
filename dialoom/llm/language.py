"""Language identification by language-bitmask n-gram filters.

A Bloom filter whose cells hold one bit a language (bit-sliced): the AND of an n-gram's cells is the set of all languages that
have it. Per language, the n-grams of a text that it has are counted; the counts are corrected for the filter's false positives, and the
language with most decides. The n-grams of a language are those frequent in a bounded sample of its labelled texts. Languages are not
limited in number: a cell has as many words of 64 bits as they need.

Defined results: `und` and score 0 for null texts and texts without a letter, and where no language was learnt; of languages with
equal counts the first by name; repeated rows give one result each; an empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import crc_mod, literal_rows, table

#: Bounds of the sample: texts of a language (each at most TRAIN_CHARS long, else left out of the sample), and n-grams that are
#: kept of a language (its most frequent).
TRAIN_DOCS, TRAIN_CHARS, GRAMS_KEPT = 600, 20_000, 20_000
SIZES = (3, 4, 5)
#: So many times the sample lie below a language's mark; the approximate count of its texts is off by a twentieth.
WIDER = 4
#: Cells of the filter (a power of two) and cells of an n-gram.
CELL_BITS, HASHES = 19, 2
_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)

_fold: np.ndarray | None = None


def _folded() -> np.ndarray:
    """Per code point: its letter in lower case, or 32."""
    global _fold
    if _fold is None:
        out = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _fold = out
    return _fold


def letters(text: str | None) -> np.ndarray:
    """Code points in lower case with one blank before, between and after words; empty without a letter."""
    if not text:
        return np.zeros(0, np.uint32)
    a = _folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = a == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank after a word
    a = a[keep]
    if not len(a) or (len(a) == 1 and a[0] == 32):
        return np.zeros(0, np.uint32)
    a = a[1:] if a[0] == 32 else a
    edge = np.array([32], np.uint32)
    return np.concatenate([edge, a] if a[-1] == 32 else [edge, a, edge])


def gram_hashes(a: np.ndarray) -> np.ndarray:
    """64-bit hashes of all n-grams of SIZES, in which a blank is only first or last."""
    out = []
    x = a.astype(np.uint64)
    blank = np.concatenate([[0], np.cumsum(a == 32)])
    for n in SIZES:
        if len(x) < n:
            continue
        m = len(x) - n + 1
        h = np.zeros(m, np.uint64)
        for i in range(n):
            h = (h ^ x[i : m + i]) * _P[i]
        h ^= h >> np.uint64(29)
        h = (h ^ np.uint64(n)) * _P[4]
        inner = blank[n - 1 : m + n - 1] - blank[1 : m + 1]
        out.append(h[inner == 0])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _cells(h: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << CELL_BITS) - 1)
    return [((h >> np.uint64(64 - CELL_BITS * (i + 1))) & mask).astype(np.int64) for i in range(HASHES)]


class Filters:
    """The bit-sliced filter and each language's rate of false positives."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.names = sorted(grams)
        kind = next((k for k in (np.uint8, np.uint16, np.uint32) if len(self.names) <= 8 * np.dtype(k).itemsize), np.uint64)
        #: One array of masks for each 64 languages.
        self.words = [np.zeros(1 << CELL_BITS, kind) for _ in range(max(1, -(-len(self.names) // 64)))]
        self.false = np.zeros(len(self.names))
        for i, name in enumerate(self.names):
            masks, bit = self.words[i // 64], kind(i % 64)
            for c in _cells(grams[name]):
                masks[c] |= kind(1) << bit
            self.false[i] = float(np.mean((masks >> bit) & kind(1))) ** HASHES

    def languages(self, h: np.ndarray, word: int = 0) -> np.ndarray:
        """The mask of each n-gram over the languages from 64 * word on."""
        first, *rest = _cells(h)
        got = self.words[word][first]
        for c in rest:
            got &= self.words[word][c]
        return got

    def hits(self, h: np.ndarray) -> np.ndarray:
        """The number of n-grams that each language has."""
        if self.words[0].itemsize <= 2:
            by_mask = np.bincount(self.languages(h))
            sets = np.arange(len(by_mask))
            return np.array([by_mask[(sets >> i) & 1 == 1].sum() for i in range(len(self.names))])
        out = []
        for w in range(len(self.words)):
            got = self.languages(h, w)
            out += [np.count_nonzero(got >> got.dtype.type(i) & got.dtype.type(1)) for i in range(min(64, len(self.names) - 64 * w))]
        return np.array(out)

    def decide(self, text: str | None) -> tuple[str, float]:
        a = letters(text)
        if not len(a) or not self.names:
            return "und", 0.0
        h = gram_hashes(a)
        if not len(h):
            return self.names[0], 1.0 / len(self.names)
        share = np.clip((self.hits(h) / len(h) - self.false) / (1 - self.false), 0.0, 1.0)
        best = int(np.argmax(share))
        odds = np.exp((share - share[best]) * min(len(h), 400) / 4)
        return self.names[best], float(1 / odds.sum())


def train(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", sample: int = TRAIN_DOCS) -> Filters:
    """From at most `sample` different texts of each language, those whose hash is least; equal rows are one text. Hashes are spread evenly,
    so about WIDER * sample of them lie below a mark that follows from a language's number of texts: the window that ranks a language sees
    only those. The driver gets at most GRAMS_KEPT n-grams of each."""
    spark = docs.sparkSession
    texts = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= TRAIN_CHARS))
    texts = texts.select(F.col(label).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("_o"))
    sizes = texts.groupBy("lang").agg(F.approx_count_distinct("_o").alias("n")).collect()  # a row a language
    if not sizes:
        return Filters({})
    marks = [{"name": r["lang"], "mark": -(2.0**63) + 2.0**64 * min(1.0, WIDER * sample / max(1, r["n"]))} for r in sizes]
    low = F.broadcast(literal_rows(spark, json.dumps(marks), "name: string, mark: double"))
    slim = texts.join(low, (F.col("lang") == F.col("name")) & (F.col("_o") <= F.col("mark"))).select("lang", "_o").distinct()
    chosen = slim.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_o"))).where(F.col("_n") <= sample)
    limits = [{"name": r["lang"], "most": r["o"]} for r in chosen.groupBy("lang").agg(F.max("_o").alias("o")).collect()]  # a row a language
    within = F.broadcast(literal_rows(spark, json.dumps(limits), "name: string, most: bigint"))
    rows = texts.join(within, (F.col("lang") == F.col("name")) & (F.col("_o") <= F.col("most")))
    rows = rows.groupBy("lang", "_o").agg(F.first("text").alias("text")).select("lang", "text")

    def counted(batches):
        for b in batches:
            for name, part in b.groupby("lang")["text"]:
                h = np.concatenate([gram_hashes(letters(t)) for t in part])
                own, n = np.unique(h, return_counts=True)
                yield pd.DataFrame({"lang": name, "gram": own.view(np.int64), "n": n})

    grams = rows.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    top = grams.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("r") <= GRAMS_KEPT)
    got = top.groupBy("lang").agg(F.collect_list("gram").alias("grams")).toArrow()
    return Filters({k: v.values.to_numpy().view(np.uint64) for k, v in zip(got["lang"].to_pylist(), got["grams"])})


def predict(docs: DataFrame, model: Filters, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; columns of the input with these names give way, others stay. The model is 2 ** CELL_BITS masks, 4 MB for each 64 languages."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def decided(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = held.value
        for t in batches:
            yield pd.DataFrame([own.decide(x if isinstance(x, str) else None) for x in t], columns=["lang_pred", "score"])

    return docs.withColumn("_decided", decided(F.col(text))).withColumn("lang_pred", F.col("_decided.lang_pred")).withColumn("score", F.col("_decided.score")).drop("_decided")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(crc_mod("doc_id", 5) != 0))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


QUERIES = {"op8_language": op8_language}
SQL: dict[str, str] = {}
