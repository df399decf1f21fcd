"""The registered queries on the driver's smallest tables: contracts, SQL, brute force, held-out accuracy."""

import zlib

import duckdb
import numpy as np
import pytest

from dialoom.llm import registry, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(registry.SQL))
def test_same_rows_as_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.SQL[name]).df()
    columns = sorted(want.columns)
    key = lambda d: sorted(map(str, d[columns].itertuples(index=False, name=None)))
    assert sorted(got.columns) == columns and key(got) == key(want)


MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,mod,out", [("op1_quality", "quality", (3, 1), "predicted"), ("op2_toxicity", "toxic", (5, 0), "predicted"), ("op8_language", "lang", (5, 0), "lang_pred")])
def test_held_out(spark, name, label, mod, out):
    """Balanced accuracy on held-out rows: a constant answer has one half, or one of the number of languages."""
    c = duckdb.connect()
    docs, known = (c.sql(f"select * from '{MEDIUM}/{t}.parquet'").df() for t in ("documents", "labels"))
    got = registry.QUERIES[name](spark, MEDIUM).toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % mod[0] == mod[1] for i in got["doc_id"]]).all()
    if out == "predicted":
        assert (got["predicted"] == (got["score"] >= 0.5).astype(int)).all()
    held = got.merge(docs[["doc_id", "lang"]].merge(known, on="doc_id", how="left"), on="doc_id")
    held = held[held["held_out"] & held[label].notna()]
    right = (held[out] == held[label]).groupby(held[label]).mean()
    assert len(right) >= 2 and right.mean() >= 0.85, right


def test_token_queries(spark, duck):
    encoder = tokens.Encoder()
    texts = duck.sql("select doc_id, coalesce(text, '') from documents order by doc_id").fetchall()
    ids = {i: encoder.tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts}
    start, want = 0, []
    for i, _ in texts:
        own = [*ids[i], 2]
        want.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    got = registry.QUERIES["op4_token_shards"](spark, SF).toPandas().sort_values("doc_id")
    assert list(got[["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False, name=None)) == want
    packed = registry.QUERIES["op6_packing"](spark, SF).toPandas()
    total = sum(len(x) + 1 for x in ids.values())
    assert packed["length"].sum() == total
    assert packed["sequence_id"].nunique() <= -(-total // 2048) + 2
    told = packed[["plan_sequences", "plan_bound", "plan_proven"]].drop_duplicates()
    assert len(told) == 1 and told["plan_sequences"][0] == packed["sequence_id"].nunique() >= told["plan_bound"][0]
    assert told["plan_proven"][0] == (told["plan_sequences"][0] == told["plan_bound"][0])


def test_nearest_query(spark, duck):
    rows = duck.sql("select vec_id, embedding from embeddings order by vec_id").fetchall()
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    got = registry.QUERIES["op10_nearest"](spark, SF).toPandas()
    assert set(got["query_id"]) == set(ids[ids % 50 == 0].tolist())
    hit = 0
    for n in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[n]
        s[n] = -9
        own = got[got["query_id"] == ids[n]].sort_values("rank")
        assert (np.diff(own["score"]) <= 0).all()
        hit += len(set(ids[np.argsort(-s)[:5]]) & set(own["vec_id"]))
    assert hit / len(got) >= 0.9


def test_mixing_query(spark, duck):
    """The schedule of the registered query against one that looks for the earliest deadline slot by slot, in fractions."""
    from fractions import Fraction

    from dialoom.llm import mixing

    got = registry.QUERIES["op5_mixing"](spark, SF).toPandas()
    docs = duck.sql("select doc_id, source from documents").fetchall()
    assert sorted(got["doc_id"]) == sorted(i for i, _ in docs)
    counts = got.fillna({"source": ""}).groupby("source")["doc_id"].count().to_dict()
    blocks = sum(-(-n // mixing.BLOCK_ROWS) for n in counts.values())
    slots = mixing.whole_weights(mixing.target_weights(counts), max(mixing.RESOLUTION, min(mixing.MOST_SLOTS, 4 * blocks)))
    total = sum(slots.values())
    weight = {s: Fraction(n, total) for s, n in slots.items()}
    taken = dict.fromkeys(weight, 0)
    want = {}
    for now in range(int(got["slot"].max()) + 1):
        ready = [(-(-(taken[s] + 1) // w), s) for s, w in weight.items() if taken[s] // w <= now]
        _, s = min(ready)
        want[s, taken[s]] = now
        taken[s] += 1
    seen = got.fillna({"source": ""}).drop_duplicates(["source", "block"])
    assert seen["slot"].is_unique and (got.groupby(["source", "block"])["slot"].nunique() == 1).all()
    assert {(s, b): t for s, b, t in zip(seen["source"], seen["block"], seen["slot"])} == {k: v for k, v in want.items() if k[1] < -(-counts[k[0]] // mixing.BLOCK_ROWS)}


def test_a_worker_keeps_its_encoder():
    """The next task of a worker neither reads the vocabulary again nor starts with an empty memory; ids are the library's."""
    from dialoom.llm import shards, tokens

    path = tokens.vocabulary_path()
    one = shards.shared_encoder(path)
    texts = ["Ether thanks, the\nwörd Zuß thiser", "the thanks", "", "a  b <|endoftext|> c"]
    for t in texts * 2:
        assert one.encode(t).tolist() == one.tokenizer.encode(t, add_special_tokens=False).ids
    assert shards.shared_encoder(path) is one and one.pieces


def test_packing_query_keeps_its_encoder(spark):
    """op6_packing reads the vocabulary once a worker, not once a task; the pieces are those of a new encoder."""
    from dialoom.llm import packing

    docs = spark.createDataFrame([(i, f"Ether thanks number {i}, the\nwörd {'so ' * (i * 40)}") for i in range(60)] + [(60, None)], "doc_id long, text string").repartition(6)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = [sorted(map(tuple, packing.pack(docs, keep=keep).select(*columns).collect())) for keep in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) >= 61

    def held(batches):
        import pandas as pd

        from dialoom.llm.tokens import shared_encoder

        for _ in batches:
            yield pd.DataFrame({"read": [shared_encoder.cache_info().currsize]})

    packing.pieces(docs, keep=True).count()
    seen = spark.range(4).repartition(1).mapInPandas(held, "read long").collect()
    assert any(r["read"] for r in seen)
