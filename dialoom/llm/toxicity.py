"""Toxicity by a classifier that is regularised with counterfactuals.

A logistic regression over words and their beginnings. In the labelled texts, each sentence that names a group is
repeated with the other terms of that group's set in its place, and the squared change of the score is part of the loss, so that a
neutral mention of any group moves a score no more than a mention of another.

Defined results: null and empty texts hold no word and get the score of the intercept; repeated rows give one result each; an
empty table gives no rows; without labelled rows, or with labels of one kind only, the score is that kind's share (0 without any).
Texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import crc_mod, labelled_sample, settle, table

#: Bound of the sample of labelled documents, and the longest text (in code points) in it: longer ones are left out of
#: the sample, never cut; they are scored like any other.
TRAIN_DOCS, TRAIN_CHARS = 4_000, 12_000
BITS = 20
#: SPARSE: weight of the sum of absolute weights in the loss.
STEPS, RATE, SPARSE = 150, 0.05, 4e-4
#: Weight of the counterfactual part of the loss.
FAIRNESS = 5.0
STARTS = (5, 7)
#: Sets of terms that may stand for each other, each of one language; a term is in one set.
IDENTITY = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("american", "mexican", "chinese", "indian", "russian", "german", "french", "spanish"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("gays", "lesbians", "bisexuals"),
    ("blacks", "whites", "asians", "latinos", "arabs", "africans", "europeans"),
    ("americans", "mexicans", "indians", "russians", "germans"),
    ("immigrant", "refugee", "migrant", "foreigner"),
    ("immigrants", "refugees", "migrants", "foreigners"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten", "katholiken"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle"),
    ("ausländer", "einwanderer", "flüchtlinge", "migranten"),
    ("chrétiens", "musulmans", "juifs", "bouddhistes", "athées", "catholiques"),
    ("femmes", "hommes", "filles", "garçons"),
    ("homosexuels", "lesbiennes", "hétérosexuels", "bisexuels"),
    ("noirs", "blancs", "arabes", "asiatiques"),
    ("étrangers", "immigrés", "réfugiés"),
    ("cristianos", "musulmanes", "judíos", "budistas", "ateos", "católicos"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales"),
    ("negros", "blancos", "árabes", "asiáticos"),
    ("extranjeros", "inmigrantes", "refugiados", "migrantes"),
)
OTHERS = {t: tuple(o for o in group if o != t) for group in IDENTITY for t in group}
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")
_MEMORY = 400_000


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def features(word: str) -> list[int]:
    """Hashed features of one word: itself and its beginnings."""
    parts = [word, *(f"^{word[:n]}" for n in STARTS if len(word) >= n)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for p in parts]


def vector(counts: dict[str, int]) -> tuple[list[int], list[float]]:
    """Sparse features of a text from its words' counts: the sum of log2(1 + count) over the words that have the feature.

    No division by length: one insult in a long text is one insult.
    """
    cells: dict[int, float] = {}
    for w, n in counts.items():
        for f in features(w):
            cells[f] = cells.get(f, 0.0) + float(np.log2(1 + n))
    return list(cells), list(cells.values())


def swaps(text: str | None) -> Counter[tuple[str, str, int, int]]:
    """(term, other term of its set, how often the sentence has the one and the other) of each swap in a text, with how often it occurs."""
    out: Counter[tuple[str, str, int, int]] = Counter()
    if text and any(t in text.lower() for t in OTHERS):
        for sentence in _SENTENCE.split(text):
            own = Counter(words(sentence))
            for w, n in own.items():
                for other in OTHERS.get(w, ()):
                    out[w, other, n, own[other]] += n
    return out


def change(term: str, other: str, n: int, m: int) -> tuple[list[int], list[float]]:
    """What one swap changes in a sentence's features: only those of the two words, whose counts are n and m before it."""
    cells: dict[int, float] = {}
    for word, step in ((term, np.log2(n) - np.log2(1 + n)), (other, np.log2(2 + m) - np.log2(1 + m))):
        for f in features(word):
            cells[f] = cells.get(f, 0.0) + float(step)
    cells = {f: x for f, x in cells.items() if abs(x) > 1e-12}
    return list(cells), list(cells.values())


def counterfactuals(text: str | None) -> list[tuple[list[int], list[float]]]:
    """For each sentence that names a group and each other term of the set: the change in the sentence's features."""
    return [change(*swap) for swap, times in swaps(text).items() for _ in range(times)]


class Model:
    def __init__(self, cells: np.ndarray, weights: np.ndarray, bias: float):
        self.cells, self.weights, self.bias = cells, weights, bias
        self._of_cell: dict[int, float] | None = None
        self._of_word: dict[str, float] = {}

    def __getstate__(self):
        return {"cells": self.cells, "weights": self.weights, "bias": self.bias, "_of_cell": None, "_of_word": {}}

    def word(self, w: str) -> float:
        got = self._of_word.get(w)
        if got is None:
            if self._of_cell is None:
                self._of_cell = dict(zip(self.cells.tolist(), self.weights.tolist()))
            if len(self._of_word) >= _MEMORY:
                self._of_word.clear()
            got = self._of_word[w] = sum(self._of_cell.get(f, 0.0) for f in features(w))
        return got

    def logit(self, text: str | None) -> float:
        counts = Counter(words(text))
        if not counts:
            return self.bias
        v = np.log2(1 + np.fromiter(counts.values(), float, len(counts)))
        return self.bias + float(v @ np.fromiter(map(self.word, counts), float, len(counts)))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -500, 500))))


class Constant:
    def __init__(self, value: float):
        self.value = value

    def score(self, text: str | None) -> float:
        return self.value


def _rows(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter((len(i) for i, _ in parts), np.int64, len(parts))
    row = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    cell = np.concatenate([np.asarray(i, np.int32) for i, _ in parts]) if parts else np.zeros(0, np.int32)
    value = np.concatenate([np.asarray(v, np.float32) for _, v in parts]) if parts else np.zeros(0, np.float32)
    return row, cell, value


def fit(docs: list[tuple], labels: np.ndarray, changes: list[tuple], fairness: float = FAIRNESS, times: np.ndarray | None = None) -> Model:
    """docs and changes: sparse rows (cells, values); times: how often a change occurs, once each if not given. Minimises log loss
    + fairness x mean squared change of the score by a swap + SPARSE x sum of absolute weights, by scaled proximal steps over the whole sample."""
    row, cell, value = _rows(docs)
    s_row, s_cell, s_value = _rows(changes)
    found, seen = np.unique(cell, return_counts=True)
    cells = found[seen >= 3]  # what one or two texts hold teaches nothing: it has no weight

    def known(rows: np.ndarray, own: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.searchsorted(cells, own).astype(np.int32)
        keep = (at < len(cells)) & (cells[np.minimum(at, len(cells) - 1)] == own) if len(cells) else np.zeros(len(own), bool)
        return rows[keep], at[keep], values[keep]

    (row, at, value), (s_row, s_at, s_value) = known(row, cell, value), known(s_row, s_cell, s_value)
    often = np.ones(len(changes)) if times is None else np.asarray(times, float)
    w, bias = np.zeros(len(cells)), float(np.log(labels.mean() / (1 - labels.mean())))
    m, v = np.zeros(len(cells) + 1), np.zeros(len(cells) + 1)
    for i in range(1, STEPS + 1):
        z = np.bincount(row, value * w[at], len(docs)) + bias
        err = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / len(labels)
        g = np.bincount(at, value * err[row], len(cells))
        if len(changes):
            moved = np.bincount(s_row, s_value * w[s_at], len(changes)) * often
            g += np.bincount(s_at, s_value * moved[s_row], len(cells)) * (2 * fairness / often.sum())
        g = np.append(g, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        pace = RATE / (np.sqrt(v / (1 - 0.99**i)) + 1e-4)
        step = pace * m / (1 - 0.9**i)
        w -= step[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - pace[:-1] * SPARSE, 0.0)
        bias -= step[-1]
    return Model(cells[w != 0], w[w != 0], bias)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = TRAIN_DOCS, fairness: float = FAIRNESS):
    """Fit on at most `sample` labelled documents, those whose hash of the key is least; features are made on the executors.

    Swaps that change the same counts are one row with their number, so what reaches the driver grows with the terms, not with the mentions.
    """
    rows = labelled_sample(docs, labels, key, text, label, sample)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[tuple[str, str, int, int]] = Counter()
        for b in batches:
            out = []
            for t, y in zip(b["_t"], b["_y"]):
                t = t if isinstance(t, str) else ""
                if len(t) <= TRAIN_CHARS:
                    out.append((int(y), *vector(Counter(words(t))), None, 1))
                    found.update(swaps(t))
            yield pd.DataFrame(out, columns=["y", "cell", "value", "swap", "times"])
        yield pd.DataFrame([(-1, None, None, dict(zip(("term", "other", "n", "m"), k)), n) for k, n in found.items()], columns=["y", "cell", "value", "swap", "times"])

    got = rows.mapInPandas(made, "y int, cell array<int>, value array<float>, swap struct<term: string, other: string, n: int, m: int>, times long")
    got = settle(got, "toxicity-sample")
    own = got.where("y >= 0").select("y", "cell", "value").toPandas()
    if not len(own) or own["y"].nunique() < 2:
        return Constant(float(own["y"].mean()) if len(own) else 0.0)
    swapped = got.where("y < 0").groupBy("swap").agg(F.sum("times").alias("times")).orderBy("swap").select("swap.*", "times").toPandas()
    changes = [change(*r) for r in swapped[["term", "other", "n", "m"]].itertuples(index=False, name=None)]
    return fit(list(zip(own["cell"], own["value"])), own["y"].to_numpy(float), changes, fairness, swapped["times"].to_numpy())


def score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with `name`: P(toxic), from the text alone; a column of the input with that name gives way, others stay. The model has a bounded size: its features come from the bounded sample."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = held.value
        for t in batches:
            yield pd.Series([own.score(x if isinstance(x, str) else None) for x in t], dtype=float)

    return docs.withColumn(name, scored(F.col(text)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(crc_mod("doc_id", 5) != 0))
    out = score(docs.select("doc_id", "text"), model)
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
SQL: dict[str, str] = {}
