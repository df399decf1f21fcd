"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features, those of the lines before and after it, and the label before it.
A document's score is the mean of its lines' marginal probabilities of being good (forward-backward), weighted by length.
The field is fitted to documents' labels, which hold for each of their lines, on a bounded sample of labelled rows.

Defined results: a null or empty text is one empty line and gets a score as any other; lines without characters weigh nothing
unless all are such; repeated rows give one result each; an empty table gives no rows; without labelled rows, or with labels
of one kind only, the score is that kind's share (0.5 without any); a column of the input that is named like the score gives way to it,
further columns stay; `keep_good` returns the input's columns only, whatever their names. Texts are read whole, in runs of lines: memory
follows the number of lines of the longest text of a batch, not its product with the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import boxed, crc_mod, labelled_sample, table

#: Bounds of the sample that the field is fitted on: documents, and lines of one document (a longer one is left out of
#: the sample, never cut; it is scored like any other).
TRAIN_DOCS, TRAIN_LINES = 2_000, 150
STEPS, RATE, DECAY = 80, 0.15, 1e-3

_CLASSES = 9
_LOWER, _UPPER, _DIGIT, _BLANK, _STOP, _LOUD, _BAR, _SYMBOL, _WIDE = range(_CLASSES)


def _byte_classes() -> np.ndarray:
    out = np.full(256, _SYMBOL, np.uint8)
    for chars, k in ((b"abcdefghijklmnopqrstuvwxyz", _LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), (b"0123456789", _DIGIT), (b" \t\r\f\v", _BLANK), (b".,;:'\"()-", _STOP), (b"!?", _LOUD), (b"|", _BAR)):
        out[list(chars)] = k
    out[128:] = _WIDE
    return out


_CLASS = _byte_classes()
OWN = 21
WIDTH = 3 * OWN + 1


def _own(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(OWN features, characters) of each of a few lines."""
    n = len(lines)
    raw = [line.encode("utf-8", "surrogatepass") for line in lines]
    sizes = np.fromiter(map(len, raw), np.int64, n)
    chars = np.fromiter(map(len, lines), np.int64, n)
    kinds = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    cell = np.repeat(np.arange(n) * _CLASSES, sizes) + kinds
    share = np.bincount(cell, minlength=n * _CLASSES).reshape(n, _CLASSES) / np.maximum(sizes, 1)[:, None]
    words = [line.split() for line in lines]
    n_words = np.fromiter(map(len, words), np.int64, n)
    kinds = np.fromiter((len(set(w)) for w in words), np.int64, n)
    again = np.fromiter((sum(map(str.__eq__, w, w[1:])) if len(w) > 3 and 2 * k < len(w) else 0 for w, k in zip(words, kinds)), np.int64, n)
    letters = share[:, _LOWER] + share[:, _UPPER]
    caps = share[:, _UPPER] / np.maximum(letters, 1e-9)
    same = 1 - kinds / np.maximum(n_words, 1)
    symbols = share[:, _SYMBOL]
    own = np.column_stack(
        [
            share[:, [_LOWER, _UPPER, _DIGIT, _BLANK, _STOP, _WIDE]],
            np.minimum(4 * share[:, [_LOUD, _BAR, _SYMBOL]], 1),
            symbols > 0.02, symbols > 0.08, share[:, _BAR] > 0.02, share[:, _LOUD] > 0.02,
            caps, (caps > 0.6) & (chars > 8), same, (same > 0.7) & (n_words > 8), again / np.maximum(n_words, 1),
            np.minimum(chars / np.maximum(n_words, 1), 30) / 10, np.log1p(chars) / 5, chars == 0,
        ]
    ).astype(np.float32)
    return own, chars


#: Lines, and characters, whose features are made at once.
RUN_LINES, RUN_CHARS = 8_192, 2_000_000


def own_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(OWN features of each line, first line of each document and one past the last, characters of each line), made in runs of lines,
    whatever documents they are of, so that what is held besides the result is bounded."""
    ends, parts, sizes = [0], [], []
    run: list[str] = []
    size = 0

    def flush() -> None:
        nonlocal run, size
        if run:
            own, chars = _own(run)
            parts.append(own)
            sizes.append(chars)
        run, size = [], 0

    for t in texts:
        lines = (t or "").split("\n")
        ends.append(ends[-1] + len(lines))
        for line in lines:
            run.append(line)
            size += len(line)
            if len(run) >= RUN_LINES or size >= RUN_CHARS:
                flush()
    flush()
    if not parts:
        return np.zeros((0, OWN), np.float32), np.array(ends, np.int64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.array(ends, np.int64), np.concatenate(sizes)


def _neighbours(own: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(what stands before, after each line in its document), zeros beyond its ends; own: one row a line, or one number."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[ends[:-1]] = 0
    after[ends[1:] - 1] = 0
    return before, after


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line and its neighbours, first line of each document and one past the last, characters of each line)."""
    own, ends, chars = own_features(texts)
    return np.column_stack([own, *_neighbours(own, ends), np.ones(len(own), np.float32)]), ends, chars


def emissions(own: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-odds of each line: line_features times weights, without making the wide matrix."""
    here, left, right = (own @ weights[i * OWN : (i + 1) * OWN] for i in range(3))
    return here + _neighbours(left, ends)[0] + _neighbours(right, ends)[1] + weights[-1]


#: Cells (documents x lines of the longest) and documents of a block.
CELLS, BLOCK_DOCS = 100_000, 512


def _blocks(ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(documents, their lines' numbers padded with -1), documents of like length together; a block has CELLS cells at most, or one document."""
    n = np.diff(ends)
    order = np.argsort(n, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and to - at < BLOCK_DOCS and (to - at + 1) * n[order[to]] <= CELLS:
            to += 1
        docs = order[at:to]
        steps = np.arange(n[docs].max())
        yield docs, np.where(steps < n[docs][:, None], ends[docs][:, None] + steps, -1)
        at = to


def marginals(emission: np.ndarray, move: np.ndarray, ends: np.ndarray, pairs: bool = False):
    """P(good) of every line, from log-odds of each line and a 2 x 2 table of log weights for moves between labels.

    With pairs also the sum over lines of the moves' probabilities and the log of each document's normaliser.
    """
    out = np.empty(len(emission))
    moved, norm = np.zeros((2, 2)), np.zeros(len(ends) - 1)
    for docs, at in _blocks(ends):
        on = at >= 0
        e = np.stack([np.zeros(at.shape), np.where(on, emission[at], 0.0)], -1)
        d, t = at.shape
        ahead, back = np.zeros((d, t, 2)), np.zeros((d, t, 2))
        ahead[:, 0] = e[:, 0]
        for k in range(1, t):
            p = ahead[:, k - 1, :, None] + move
            ahead[:, k] = np.where(on[:, k, None], np.logaddexp(p[:, 0], p[:, 1]) + e[:, k], ahead[:, k - 1])
        for k in range(t - 2, -1, -1):
            p = move + (e[:, k + 1] + back[:, k + 1])[:, None, :]
            back[:, k] = np.where(on[:, k + 1, None], np.logaddexp(p[..., 0], p[..., 1]), 0.0)
        z = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        both = ahead + back
        out[at[on]] = (1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -500, 500))))[on]
        norm[docs] = z
        if pairs and t > 1:
            joint = ahead[:, :-1, :, None] + move + (e[:, 1:] + back[:, 1:])[:, :, None, :] - z[:, None, None, None]
            moved += np.exp(np.minimum(joint, 0))[on[:, 1:]].sum(0)
    return (out, moved, norm) if pairs else out


def fit(x: np.ndarray, ends: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights of the emission log-odds, 2 x 2 moves): maximises the likelihood of the documents' labels as labels of all their lines."""
    n = np.diff(ends)
    y = np.repeat(labels, n).astype(float)
    inner = np.ones(len(y), bool)
    inner[ends[:-1]] = False
    seen = np.array([[np.sum(inner & (y == 0)), 0.0], [0.0, np.sum(inner & (y == 1))]])
    w = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, STEPS + 1):
        p, moved, _ = marginals(x @ w[:-4], w[-4:].reshape(2, 2), ends, pairs=True)
        g = np.concatenate([x.T @ (y - p), (seen - moved).ravel()]) / len(labels)
        g -= DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w += RATE * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return w[:-4], w[-4:].reshape(2, 2)


def document_scores(texts: list[str | None], model) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    weights, move = model
    own, ends, chars = own_features(texts)
    good = marginals(emissions(own, ends, weights), move, ends)
    size = np.add.reduceat(chars, ends[:-1]) if len(texts) else np.zeros(0)
    weight = np.where(np.repeat(size, np.diff(ends)) > 0, chars, 1)
    total = np.add.reduceat(weight, ends[:-1])
    return np.clip(np.add.reduceat(weight * good, ends[:-1]) / total, 0.0, 1.0)


def _chunks(text: pd.Series, most: int = 4_000_000) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in text:
        t = t if isinstance(t, str) else None
        part.append(t)
        size += len(t or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = TRAIN_DOCS):
    """Fit on at most `sample` labelled documents, those whose hash of the key is least; features are made on the executors."""
    rows = labelled_sample(docs, labels, key, text, label, sample)

    def features(batches):
        for b in batches:
            out = []
            for t, y in zip(b["_t"], b["_y"]):
                x, _, _ = line_features([t if isinstance(t, str) else None])
                if len(x) <= TRAIN_LINES:
                    out.append((int(y), x[:, :OWN].ravel().tolist()))
            yield pd.DataFrame(out, columns=["y", "x"])

    got = rows.mapInPandas(features, "y int, x array<float>").toPandas()
    if not len(got) or got["y"].nunique() < 2:
        return float(got["y"].mean()) if len(got) else 0.5
    own = [np.asarray(x, np.float32).reshape(-1, OWN) for x in got["x"]]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
    zero = np.zeros((1, OWN), np.float32)
    x = np.concatenate([np.column_stack([o, np.concatenate([zero, o[:-1]]), np.concatenate([o[1:], zero])]) for o in own])
    return fit(np.column_stack([x, np.ones(len(x), np.float32)]), ends, got["y"].to_numpy())


def score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with `name`: P(good), from the text alone."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in batches:
            yield pd.Series(np.concatenate([document_scores(part, model) for part in _chunks(t)]) if len(t) else np.zeros(0))

    return docs.withColumn(name, scored(F.col(text)))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that the field takes for good, with their own columns only."""
    model = train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    return score(boxed(docs, _t=F.col("text")), model, "_t", "_quality").where(F.col("_quality") >= least).select("_row.*")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    out = score(docs.select("doc_id", "text"), model)
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op1_quality": op1_quality}
SQL: dict[str, str] = {}
