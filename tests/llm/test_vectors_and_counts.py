"""Vector codes, hard negatives and token counts against plain computation, on ordinary and odd rows."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import codes, counts, negatives, registry
from dialoom.llm.common import scratch_folder, shared_root
from dialoom.llm.tokens import vocabulary_path

SF = "/root/testdata/sf0.001"
CLASH = {"block": 1, "id": "x", "v": 2, "_label": "y", "list": 3, "code": "z", "n": 4, "first": 5, "pair": 6}
VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows, clash=True):
    df = spark.createDataFrame(rows, VECTORS)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()}) if clash else df


def some_vectors(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    x = centers[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.4
    return [(i, [float(np.float32(c)) for c in x[i]], int(rng.integers(0, 4))) for i in range(n)]


ODD = [
    (900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] + [0.0] * 15, 1), (903, [float("inf")] + [0.0] * 15, 2), (904, [0.0] * 16, None), (905, [0.0] * 16, 1), (None, [0.5] * 16, 2),
    (906, [1e30] + [0.0] * 15, 2), (907, [0.25] * 16, 2), (907, [0.25] * 16, 2), (908, [], 3), (909, [0.5] * 5, 3), (910, [0.5] * 5, 1), (911, [-0.5] * 5, None), (912, [0.25] * 16, 1),
]


# ---- 11 vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{(id, vector): (code, error)}, label errors and the digest, by Lloyd's rounds in whole numbers."""
    kept = [(i, v, la) for i, v, la in rows if v is not None and all(x is not None and abs(x) <= codes.MOST / scale for x in v)]
    out, books = [], {}
    for dim in sorted({len(v) for _, v, _ in kept}):
        own = [r for r in kept if len(r[1]) == dim]
        width = -(-dim // parts)
        x = np.zeros((len(own), width * parts), np.int64)
        for row, (_, v, _) in zip(x, own):
            row[:dim] = np.floor(np.array(v, float) * scale)
        x = x.reshape(len(own), parts, width)
        first = sorted(range(len(own)), key=lambda n: (own[n][0] is None, own[n][0] or 0, own[n][1]))[:entries]
        book = x[first].transpose(1, 0, 2).copy()
        near = lambda: ((x[:, :, None] - book[None]) ** 2).sum(3).argmin(2)  # noqa: E731, B023
        for _ in range(rounds):
            a = near()
            for p in range(parts):
                for e in range(len(first)):
                    if (a[:, p] == e).any():
                        book[p, e] = x[a[:, p] == e, p].sum(0) // (a[:, p] == e).sum()
        a = near()
        books[dim] = book
        for n, (i, _, label) in enumerate(own):
            out.append((i, "".join(f"{e:02x}" for e in a[n]), int(((x[n] - book[np.arange(parts), a[n]]) ** 2).sum()), label))
    total = defaultdict(int)
    for _, _, error, label in out:
        total[label] += error
    sha = hashlib.sha256(",".join(str(c) for d in sorted(books) for c in books[d].ravel().tolist()).encode()).hexdigest()
    return sorted((str(i), code, error, total[label], sha) for i, code, error, label in out)


def got_codes(df):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


@pytest.mark.parametrize("rows,kwargs", [(some_vectors(400) + ODD, {"block": 50}), (some_vectors(9), {}), ([(1, [0.5] * 8, None)] * 3, {}), (some_vectors(120, 24, 3), {"parts": 5, "entries": 4, "rounds": 3})])
def test_codes_equal_plain_rounds(spark, rows, kwargs):
    got = codes.compress(vectors(spark, rows), **kwargs)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got_codes(got) == plain_codes(rows, **{k: v for k, v in kwargs.items() if k != "block"})


def test_codes_of_doubles_and_of_nothing(spark):
    rows = some_vectors(60)
    df = vectors(spark, rows).withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert got_codes(codes.compress(df)) == plain_codes(rows)
    assert codes.compress(vectors(spark, rows).limit(0)).count() == 0


def test_heaps_scan_few_and_miss_none():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(3, 4))[rng.integers(0, 3, 3000)] * 9000 + rng.normal(size=(3000, 4)) * 800).astype(np.int64)
    book = x[:6].copy()[None]
    drift, heaps, sums, scanned = np.zeros((1, 6)), None, 0, []
    for _ in range(12):
        heaps, change, n = codes.assign(x, heaps, book[0], drift[0])
        assert (heaps.nearest() == codes.distances(x, book[0]).argmin(1)).all()
        assert all((np.diff(heaps.keys[a:b]) >= 0).all() for a, b in zip(heaps.starts, heaps.starts[1:]))
        sums = sums + change[None]
        after = codes.replaced(book, sums)
        drift, book = codes.drifted(drift, book, after), after
        scanned.append(n)
    assert scanned[0] == 3000 and scanned[-1] < 600, scanned


def test_distances_are_exact_at_any_size():
    x = np.array([[1 << 24, -(1 << 24), 3], [5, 7, -11]], np.int64)
    book = np.array([[-(1 << 24), (1 << 24) - 1, 0], [4, 7, 2]], np.int64)
    assert codes.distances(x, book).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in book] for p in x]


def test_codes_leave_only_their_result(spark):
    from pathlib import Path

    folder = Path(scratch_folder(spark).removeprefix("file:"))
    before, tables = {p.name for p in folder.glob("*")}, len(spark.catalog.listTables())
    codes.compress(vectors(spark, some_vectors(50), clash=False)).count()
    left = {p.name.rsplit("-", 1)[0] for p in folder.glob("*") if p.name not in before}
    assert left == {"codes"} and len(spark.catalog.listTables()) == tables
    assert str(folder).startswith(shared_root(spark).removeprefix("file:"))


# ---- 12 hard negatives


def plain_negatives(rows, asked, positives=5, k=10, window=(30, 90), scale=256):
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and abs(x) <= negatives.MOST / scale for x in v):
            kept[i] = min(kept.get(i, (str(label), [int(c) for c in np.floor(np.array(v, float) * scale)])), (str(label), [int(c) for c in np.floor(np.array(v, float) * scale)]))
    out = []
    for a in filter(asked, kept):
        own, q = kept[a]
        scores = [(-sum(x * y for x, y in zip(q, v)), i, label == own) for i, (label, v) in kept.items() if len(v) == len(q) and i != a]
        for s, p, _ in sorted(x for x in scores if x[2])[:positives]:
            fits = sorted((t, i) for t, i, same in scores if not same and window[0] * -s <= 100 * -t <= window[1] * -s)
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(fits[:k])]
    return sorted(out)


def got_negatives(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


COPIES = [(1000 + i, [0.5, -0.5] * 8, i % 2) for i in range(60)] + [(1100 + i, [0.0] * 16, i % 3) for i in range(40)]


@pytest.mark.parametrize("kwargs", [{}, {"lists": 12, "block": 40}, {"lists": 3, "block": 30, "positives": 2, "negatives": 3, "window": (50, 100)}])
def test_negatives_equal_plain_search(spark, kwargs):
    rows = some_vectors(500) + ODD + COPIES
    got = got_negatives(negatives.hard_negatives(vectors(spark, rows), F.col("id") % 50 == 0, **kwargs))
    assert got == plain_negatives(rows, lambda i: i % 50 == 0, kwargs.get("positives", 5), kwargs.get("negatives", 10), kwargs.get("window", (30, 90)))
    assert got


def test_negatives_of_nothing(spark):
    df = vectors(spark, some_vectors(30))
    assert negatives.hard_negatives(df.limit(0), F.col("id") % 5 == 0).count() == 0
    assert negatives.hard_negatives(df, F.lit(False)).count() == 0
    assert negatives.hard_negatives(df.withColumn("label", F.lit(1)), F.lit(True)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(300, 8)) * 100, rng.normal(size=(20, 8)) * 100
    centers = negatives.fit(x, 9)
    near = negatives._squares(x, centers).argmin(1)
    far = np.sqrt(((x - centers[near]) ** 2).sum(1))
    radius = np.array([far[near == c].max(initial=0) for c in range(len(centers))])
    lower, upper = negatives.bounds(q, centers, radius)
    scores = q @ x.T
    for c in range(len(centers)):
        own = scores[:, near == c]
        assert (own <= upper[:, c, None]).all() and (own >= lower[:, c, None]).all()


# ---- 13 token counts


def hard_texts():
    rng = random.Random(13)
    bits = ["word", "a", " ", "  ", "\n", "\n\n", "\t", "▁", "é", "中文字", "😀", ".", "<s>", "</s>", "<0x0A>", "\r\n", "of the", "1234", "   x", "　", " ", "\x00"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 400))) for _ in range(150)]


@pytest.mark.parametrize("part", [1, 7, 50])
def test_parts_have_the_tokens_of_the_whole(part):
    by = counts.PieceCounter(vocabulary_path(counts.DEFAULT_MODEL), part)
    assert by.cut is not None
    cut = 0
    for text in hard_texts():
        parts, extra = by.parts(text)
        cut += len(parts) > 2
        assert sum(by.lengths(parts)) - extra == by.lengths([text])[0], text
    assert cut > 50


def test_counts_of_odd_rows(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(counts.DEFAULT_MODEL))
    long = " ".join(f"word{i % 977} runs\n" for i in range(40_000)) + "中" * 20_000
    texts = [None, "", " ", long, "the same", "the same", *hard_texts()[:40], *["short text"] * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"n_tokens": F.lit("x"), "_text": F.lit(1), "path": F.lit(2)})
    out = counts.count_tokens(docs, limit=5)
    assert out.columns == ["doc_id", "text", "n_tokens", "_text", "path", "n_bytes", "over_limit"]
    for r in out.collect():
        own = texts[r["doc_id"]] or ""
        n = len(model.encode(own))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(own.encode()), n, n > 5)
    assert counts.count_tokens(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_by_each_library(spark, name):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["A house, a River.", None, "x <s> y", "Grüße 中文"])], "doc_id long, text string")
    got = [r["n_tokens"] for r in counts.count_tokens(docs, vocabulary_path(name)).orderBy("doc_id").collect()]
    texts = ["A house, a River.", "", "x <s> y", "Grüße 中文"]
    if name.endswith(".model"):
        import sentencepiece

        assert got == [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name)).encode(texts)]
    else:
        from tokenizers import Tokenizer

        assert got == [len(x.ids) for x in Tokenizer.from_file(vocabulary_path(name)).encode_batch(texts, add_special_tokens=False)]


def test_count_query(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(counts.DEFAULT_MODEL))
    rows = duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall()
    want = sorted((i, len(t.encode()), len(x), len(x) > 4096) for (i, t), x in zip(rows, model.encode([t for _, t in rows])))
    out = registry.QUERIES["op13_token_counts"](spark, SF)
    assert sorted(map(tuple, out.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())) == want
