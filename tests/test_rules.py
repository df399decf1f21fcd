"""Rules, gates, retries and metrics on small rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from dialoom.operators import dedup, dialogue, export, gates, mapping_checks, metrics, models, retry, rules
from dialoom.plans.schemas import DDL, mirror, problems, row_id, schema, with_defaults


def turns(*texts, speaker="A"):
    return [{"index": i, "speaker": speaker, "text": t} for i, t in enumerate(texts)]


def row(**change):
    base = {
        "id": "r1", "original_index": 1, "source_dialogue": turns("We met at Chipotle", "Nice"), "speakers": [{"name_en": "A", "role_in_scene": "friend", "gender_hint": "unknown", "age_group_hint": "20s", "register": "casual", "dominant_emotion": {"type": "joy", "intensity": 3}, "personality_traits": [], "interests_hints": [], "occupation_hint": "", "speech_style_notes": ""}],
        "scene": {"narrative_en": "Two friends talk", "setting": "cafe", "relationship_type": "friendship", "topics": ["food"]},
        "dialogue_decomposed": {"overall_register": "casual", "overall_emotion": {"type": "joy", "intensity": 3}, "speech_acts": ["statement"], "cultural_refs": [{"type": "brand", "term": "chipotle"}]},
        "mapped_refs": [{"term": "chipotle", "ko": "치폴레", "type": "brand", "source": "dict", "retrieved": False, "notes": "", "validation": []}],
        "final_dialogue": turns("치폴레에서 만났어", "좋아", speaker="민수"), "persona": [{"speaker_index": 0, "speaker_name_en": "A", "retrieved_persona": {"name": "민수", "age": 25}}],
    }
    return base | change


def frame(spark, *rows_):
    text = spark.createDataFrame([(json.dumps(r),) for r in rows_], "v string")
    return with_defaults(mirror(with_defaults(text.select(F.from_json("v", schema("stage3")).alias("r")).select("r.*"), "stage3")), "stage3")


def first_rule(df):
    return {r["id"]: r["rule"] for r in df.select("id", F.get("reject_reasons", F.lit(0))["rule"].alias("rule")).collect()}


CASES = {
    "ok": ({}, None),
    "short": ({"final_dialogue": turns("치폴레 만났어")}, "turn_count_parity"),
    "order": ({"final_dialogue": [{"index": 0, "speaker": "B", "text": "치폴레"}, {"index": 9, "speaker": "B", "text": "치폴레"}]}, "turn_index_order"),
    "speaker": ({"persona": [{"speaker_name_en": "Zed", "retrieved_persona": {"name": "x", "age": 3}}]}, "speaker_ref_integrity"),
    "old speaker": ({"persona": [], "speaker_personas": [{"speaker_ref": "Zed"}]}, "speaker_ref_integrity"),
    "latin": ({"final_dialogue": turns("we met at 치폴레 today", "all in English here")}, "ascii_ratio"),
    "surface": ({"final_dialogue": turns("식당에서 만났어", "좋아")}, "mapped_ref_surface"),
    "uncovered": ({"mapped_refs": []}, "cultural_ref_coverage"),
    "script": ({"mapped_refs": [{"term": "chipotle", "ko": "!", "type": "brand", "source": "dict"}], "final_dialogue": turns("치폴레!", "좋아!")}, "mapped_ref_ko_hangul"),
    "type": ({"mapped_refs": [{"term": "Chipotle", "ko": "치폴레", "type": "food", "source": "dict"}], "final_dialogue": turns("치폴레", "치폴레")}, "mapped_ref_type_consistency"),
    "none": ({"final_dialogue": [], "korean_dialogue": []}, None),
}


def test_rules(spark):
    made = [row(id=name, **change) for name, (change, _) in CASES.items() if name != "surface"] + [row(id="surface", final_dialogue=turns("식당에서 만났어", "좋아"))]
    out = rules.apply(frame(spark, *made))
    assert first_rule(out) == {name: want for name, (_, want) in CASES.items()}
    assert all(len(r["reject_reasons"]) <= 1 for r in out.select("reject_reasons").collect())


def test_mirror_and_ids(spark):
    a = frame(spark, row()).first()
    assert a["korean_dialogue"] == a["final_dialogue"]
    got = spark.createDataFrame([(None, 7), ("", 8), ("x", 9)], "id string, n long").select(row_id(F.col("id"), F.col("n")).alias("i")).collect()
    assert [r["i"] for r in got] == ["soda-7", "soda-8", "x"]


def test_problems(spark):
    bad = row(dialogue_decomposed=row()["dialogue_decomposed"] | {"overall_emotion": {"type": "joy", "intensity": 9}})
    found = frame(spark, row(), bad, row(id="x") | {"original_index": None}).select(F.size(problems("stage3")).alias("n")).collect()
    assert [r["n"] for r in found] == [0, 1, 1]
    assert set(DDL) == {"raw", "stage1", "stage2", "stage3", "sft"}


def test_guard(spark):
    rows = [row(id="mail", final_dialogue=turns("치폴레 a.b@c.org", "좋아")), row(id="phone", final_dialogue=turns("치폴레 555-123-4567", "좋아")), row(id="ok")]
    out = gates.guard(frame(spark, *rows), models.always_safe)
    got = {r["id"]: (r["valid"], r["quality"]["pii_pass"]) for r in out.collect()}
    assert got == {"mail": (False, False), "phone": (False, False), "ok": (True, True)}
    done = gates.guard(rules.apply(frame(spark, row(final_dialogue=turns("치폴레")))), lambda x: F.lit(False)).first()
    assert done["quality"]["safety_pass"] is False and len(done["reject_reasons"]) == 1


@pytest.mark.parametrize("text,kinds", [("4111 1111 1111 1111", ["card"]), ("4111 1111 1111 1112", []), ("at 10.0.0.1", ["ip"]), ("999.1.1.1", []), ("123-45-6789", ["ssn"]), ("GB82WEST12345698765432", ["iban"]), (None, []), ("", [])])
def test_pii(spark, text, kinds):
    assert spark.createDataFrame([(text,)], "t string").select(gates.pii_kinds(F.col("t")).alias("k")).first()["k"] == kinds


def test_coherence(spark):
    same = lambda t: F.array(F.lit(1.0), F.lit(0.0))
    turn = lambda t: F.when(F.length(t) % 2 == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    assert gates.coherence(frame(spark, row()), same).first()["quality"]["intra_kr_coherence"] == 1.0
    cut = gates.coherence(frame(spark, row(final_dialogue=turns("ab", "abc"))), turn).first()
    assert cut["quality"]["intra_kr_coherence"] == 0.0 and cut["reject_reasons"][0]["rule"] == "intra_kr_coherence"
    none = gates.coherence(frame(spark, row(final_dialogue=[])), same).first()
    assert none["valid"] and none["quality"]["judge_reasoning"] == {"intra_kr_coherence": "skipped_no_kr"}


def test_judge(spark):
    calls = {"ok": models.fixed_judge(5), "axis_floor": models.fixed_judge(dict.fromkeys(rules.Limits().weights, 5) | {"naturalness": 1}), "aggregate_floor": models.fixed_judge(2)}
    for want, call in calls.items():
        got = gates.judge(frame(spark, row()), call).first()
        assert (got["reject_reasons"][0]["rule"] if got["reject_reasons"] else "ok") == want
    failed = gates.judge(frame(spark, row()), lambda d: models.fixed_judge()(d).withColumn("judge_error", F.lit("Timeout: x"))).first()
    assert failed["reject_reasons"][0]["rule"] == "judge_error" and failed["quality"]["naturalness"] is None


RETRIES = {
    ("stage3.phase3", "safety"): ["none"],
    ("stage3.phase1", "semantic_dup"): ["none"],
    ("stage3.phase1", "exact_dup"): ["none"],
    ("stage3.phase2", "cultural_ref_coverage"): ["maps_ref_redo", "websearch_cultural"],
    ("stage3.phase2", "turn_count_parity"): ["stage1_redecompose"],
    ("stage3.phase2", "ascii_ratio"): ["stage2_rewrite"],
    ("stage3.phase5", "aggregate_floor"): ["stage2_rewrite"],
}


def test_retry_actions(spark):
    made = [row(id=rule, valid=False, reject_reasons=[{"stage": stage, "rule": rule, "detail": ""}]) for stage, rule in RETRIES]
    made.append(row(id="cultural", valid=False, reject_reasons=[{"stage": "stage3.phase5", "rule": "axis_floor", "detail": ""}], quality={"cultural_appropriateness": 2}))
    out = retry.derive(frame(spark, *made, row(id="fine")))
    got = {r["id"]: [a["action"] for a in r["retry_actions"]] for r in out.collect()}
    want = {rule: actions for (_, rule), actions in RETRIES.items()} | {"cultural": ["maps_ref_redo", "websearch_cultural"], "fine": []}
    assert got == want
    assert {r["id"] for r in retry.queue(out).select("id").collect()} == {"cultural_ref_coverage", "turn_count_parity", "ascii_ratio", "aggregate_floor", "cultural"}


def test_repair_budget(spark):
    """Each action once, the budget held, iter + 1."""
    seen = []

    def tool(name, fixes):
        def run(df):
            seen.append(name)
            return df.withColumn("final_dialogue", F.from_json(F.lit(json.dumps(turns("치폴레", "좋아"))), "array<struct<index:int,speaker:string,text:string>>")).withColumn("korean_dialogue", F.col("final_dialogue")) if fixes else df

        return run

    start = retry.derive(rules.apply(frame(spark, row(final_dialogue=turns("치폴레")))))
    fixed = retry.repair(retry.queue(start), {"stage1_redecompose": tool("a", True)}, rules.apply).collect()
    assert fixed[0]["valid"] and fixed[0]["iter"] == 1 and seen == ["a"]
    seen.clear()
    left = retry.repair(retry.queue(start), {"stage1_redecompose": tool("a", False)}, rules.apply).collect()
    assert not left[0]["valid"] and seen == ["a"]


def test_flags(spark):
    cases = [("aiu", "IU", "pop_culture", "", ["non_hangul_ko:warn"]), ("chipotle", "Hom", "brand", "", ["non_hangul_ko:error"]), ("x", "", "food", "", ["ko_empty_or_same:error"]), ("x", " X ", "food", "", ["ko_empty_or_same:error"]), ("x", "엑스", "food", "foo_bar", ["corrupted_token:warn"]), ("x", "게임", "food", "", ["out_of_domain_leak:warn"]), ("x", "엑스", "slang", None, [])]
    df = spark.createDataFrame([c[:4] for c in cases], "t string, k string, y string, n string")
    got = df.select(F.transform(mapping_checks.flags(F.col("t"), F.col("k"), F.col("y"), F.col("n")), lambda f: F.concat_ws(":", f["code"], f["severity"])).alias("f")).collect()
    assert [r["f"] for r in got] == [c[4] for c in cases]


def test_greedy_matches_the_sequential_rule(spark):
    import random

    random.seed(5)
    for _ in range(3):
        n = 14
        pairs = [(a, b, random.uniform(0.9, 1.0)) for a in range(n) for b in range(a + 1, n) if random.random() < 0.25]
        near = {}
        for a, b, s in pairs:
            near.setdefault(b, {})[a] = s
        kept, want = set(), {}
        for j in range(n):
            hit = min((i for i in near.get(j, {}) if i in kept), default=None)
            want[j] = ("kept" if hit is None else "exact" if near[j][hit] >= 0.99 else "semantic", hit)
            if hit is None:
                kept.add(j)
        got = dedup.greedy(spark.range(n).withColumnRenamed("id", "o"), spark.createDataFrame(pairs, "a long, b long, similarity double"), "o").collect()
        assert {r["o"]: (r["label"], r["pivot"]) for r in got} == want


def sequential(vectors, semantic, exact):
    """The rule row by row: (label, pivot) of each."""
    import numpy as np

    kept, want = [], {}
    for j, v in enumerate(vectors):
        want[j] = ("kept", None)
        if v is None or not np.linalg.norm(v):
            continue
        for i in kept:
            c = float(np.dot(v, vectors[i]) / np.linalg.norm(v) / np.linalg.norm(vectors[i]))
            if c >= semantic:
                want[j] = ("exact" if c >= exact else "semantic", i)
                break
        else:
            kept.append(j)
    return want


@pytest.mark.parametrize("at_once", [0, 5, dedup.AT_ONCE])
def test_greedy_in_rounds_and_at_once(spark, at_once):
    import random

    rng = random.Random(3)
    n = 200
    pairs = [(a, b, rng.uniform(0.9, 1.0)) for a in range(n) for b in range(a + 1, min(n, a + 12)) if rng.random() < 0.3]
    near = {}
    for a, b, s in pairs:
        near.setdefault(b, {})[a] = s
    kept, want = set(), {}
    for j in range(n):
        hit = min((i for i in near.get(j, {}) if i in kept), default=None)
        want[j] = ("kept" if hit is None else "exact" if near[j][hit] >= 0.99 else "semantic", hit)
        if hit is None:
            kept.add(j)
    got = dedup.greedy(spark.range(n).withColumnRenamed("id", "o"), spark.createDataFrame(pairs, "a long, b long, similarity double"), "o", at_once=at_once).collect()
    assert {r["o"]: (r["label"], r["pivot"]) for r in got} == want


def near_vectors(n, dims, jitter, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 2, dims))
    both = np.concatenate([base, base[rng.integers(0, n // 8, n - len(base))] + rng.normal(scale=jitter, size=(n - len(base), dims))])
    return both[rng.permutation(n)]


@pytest.mark.parametrize("threshold, tile_rows", [(0.9, None), (0.9, 150), (0.999, None), (0.999, 60), (0.99999, None)])
def test_pairs_of_a_grid(spark, threshold, tile_rows):
    """All pairs, each once, with cells of a grid and without, from few enough rows in the shuffle."""
    import numpy as np

    n = 5_000
    x = near_vectors(n, 8, 0.01 if threshold < 0.9999 else 0.001, 5)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = np.triu(u @ u.T, 1)
    want = {(int(a), int(b)): near[a, b] for a, b in zip(*np.nonzero(near >= threshold))}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(n, [0.0] * 8), (n + 1, None), (n + 2, [float("nan")] * 8)], "o long, v array<double>").repartition(3)
    found = dedup.similar_pairs(df, "o", "v", threshold, tile_rows)
    got = found.collect()
    assert len(got) == len(want) > 100 and {(r["a"], r["b"]) for r in got} == set(want)
    assert max(abs(r["similarity"] - want[r["a"], r["b"]]) for r in got) < 1e-12
    assert (len(dedup._grid(n, 8, threshold)[2]) > 0) == (threshold > 0.99)


@pytest.mark.parametrize("threshold, round_rows", [(0.9, None), (0.9, 300), (0.999, None)])
def test_greedy_without_links(spark, threshold, round_rows):
    x = [v.tolist() for v in near_vectors(3_000, 8, 0.01, 6)]
    df = spark.createDataFrame(list(enumerate(x)), "o long, v array<double>").repartition(3)
    got = {r["o"]: (r["label"], r["pivot"]) for r in dedup.greedy_vectors(df, "o", "v", threshold, 0.9995, round_rows).collect()}
    assert got == sequential([__import__("numpy").array(v) for v in x], threshold, 0.9995) and len({k for k, _ in got.values()}) == 3


def test_a_group_of_near_rows_makes_no_links(spark):
    """4,000 vectors all near each other would be 8 million links; no table holds more rows than there are vectors."""
    from unittest.mock import patch

    x = near_vectors(4_000, 8, 0.0, 7)
    x[:] = x[0] + x * 1e-3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "o long, v array<double>")
    with patch.object(dedup, "similar_pairs", side_effect=AssertionError("links")):
        got = dedup.semantic_dedup(df, "o", "v", 0.9, 0.99).groupBy("label", "pivot").count().collect()
    assert sorted((r["label"], r["pivot"], r["count"]) for r in got) == [("exact", 0, 3_999), ("kept", None, 1)]


def test_copies_follow_their_first_row(spark):
    import random

    rng = random.Random(8)
    base = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(25)] + [[0.0, 0.0, 0.0], None, [-0.0, 0.0, 0.0]]
    vectors = [rng.choice(base) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(vectors)), "o long, v array<double>")
    got = {r["o"]: (r["label"], r["pivot"]) for r in dedup.semantic_dedup(df, "o", "v", 0.9, 0.97).collect()}
    assert got == sequential(vectors, 0.9, 0.97) and len({x for x, _ in got.values()}) == 3


def test_many_equal_rows_and_a_long_chain(spark):
    """100,000 copies and a chain of 1,000 links: few jobs, no pairs among copies."""
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("o"), F.array(F.lit(0.6), F.lit(0.8)).alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("copies", "")
    got = dedup.semantic_dedup(df, "o", "v").groupBy("label", "pivot").count().collect()
    assert sorted((r["label"], r["pivot"], r["count"]) for r in got) == [("exact", 0, n - 1), ("kept", None, 1)]
    spark.sparkContext.setJobGroup("chain", "")
    pairs = spark.range(1_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(0.95).alias("similarity"))
    kept = dedup.greedy(spark.range(1_001).withColumnRenamed("id", "o"), pairs, "o").where("label = 'kept'").collect()
    assert sorted(r["o"] for r in kept) == list(range(0, 1_001, 2))
    jobs = {g: len(tracker.getJobIdsForGroup(g)) for g in ("copies", "chain")}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["copies"] < 80 and jobs["chain"] < 40, jobs


def test_equal_speakers_get_personas_of_their_own(spark):
    """60 speakers of one dialogue who ask for the same: none goes without, none twice; and all that there are where there are fewer."""
    from dialoom.operators import personas
    from dialoom.plans.schemas import SPEAKER
    from dialoom.sources.personas import COLUMNS

    def bank(n):
        own = {"persona_id": F.concat(F.lit("p"), F.col("id")), "occupation": F.when(F.col("id") % 4 == 0, "교사").otherwise("농부"), "persona": F.when(F.col("id") % 3 == 0, "친구").otherwise(""), "age": F.lit(25), "age_bucket": F.lit("20대"), "sex": F.lit("남자")}
        return spark.range(n).select(*[own.get(c, F.lit("")).alias(c) for c in COLUMNS], F.lit("male").alias("gender_key"), F.lit("20s").alias("age_key"))

    speaker = F.from_json(F.lit('{"name_en": "A", "role_in_scene": "teacher", "gender_hint": "male", "age_group_hint": "20s", "register": "casual", "interests_hints": ["friendship"], "personality_traits": []}'), SPEAKER)
    rows = spark.createDataFrame([("d1", 60), ("d2", 1), ("d3", 0)], "id string, n int").select("id", F.array_repeat(speaker, F.col("n")).alias("speakers"))
    for n, want in ((90, 60), (30, 30)):
        got = {r["id"]: r["persona"] for r in personas.select_personas(rows, bank(n), 1).collect()}
        ids = [e["retrieved_persona"]["persona_id"] for e in got["d1"]]
        assert len(ids) == len(set(ids)) == want and len(got["d2"]) == 1 and got.get("d3", []) == []
        assert [e["speaker_index"] for e in got["d1"]] == list(range(want))
        points = [e["selection_metadata"]["match_score"] for e in got["d1"]]
        assert points == sorted(points, reverse=True) and points[0] == 11.0 and {11.0, 8.0, 3.0} <= set(points) and (0.0 in points) == (points.count(0.0) > 0)


def test_hints_let_every_match_through():
    """What a pattern finds in made-up text, its hint and the first pass find too."""
    import random
    import re

    rng = random.Random(11)
    bits = ["a@b.co", "@", "555-123-4567", "(555) 123-4567", "+1 555.123 4567", "123-45-6789", "1.2.3.4", "192.168.10.255", "GB82WEST12345698765432", "DE89370400440532013000", "bc1" + "q5" * 14, "1" + "aB3" * 9, "3" + "Kz9" * 10, "4111111111111111", "4111 1111 1111 1", "4111-1111-1111-1111", " ", "x", "7", ".", "-", "word"]
    patterns = {k: re.compile(p) for k, p in (gates.PII_PATTERNS | {"card": gates.CARD}).items()}
    seen = dict.fromkeys(patterns, 0)
    for _ in range(4_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 6)))
        for k, p in patterns.items():
            if p.search(text):
                seen[k] += 1
                assert re.search(gates.PII_HINTS[k], text) and re.search(gates.PII_ANY, text), (k, text)
    assert min(seen.values()) > 50, seen


def test_bigram_tiles(spark):
    import random
    from itertools import combinations

    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 30)))) for i in range(120)] + [(200 + i, "same words in every row here") for i in range(40)] + [(300, None), (301, "one")]
    sets = [s for s in ({(x, y) for x, y in zip(t.split(), t.split()[1:])} for _, t in rows if t) if s]
    pairs = list(combinations(sets, 2))
    want = sum(1 - len(a & b) / len(a | b) for a, b in pairs) / len(pairs)
    df = spark.createDataFrame(rows, "k long, t string")
    tokens = F.split(F.coalesce("t", F.lit("")), " ")
    for kwargs in ({}, {"tile_rows": 20}, {"tile_grams": 300}):
        got = metrics.bigram_jaccard_diversity(df, "k", tokens, **kwargs).first()
        assert got["pairs"] == len(pairs) and got["diversity"] == pytest.approx(want)
    assert tuple(metrics.bigram_jaccard_diversity(df.where("k = 301"), "k", tokens).first()) == (0, 0.0)
    wide = [[f"w{i} x{j}" for j in range(3_000)] for i in range(3)]
    hashed = [__import__("numpy").array(sorted(hash(g) for g in {*r[:1500], *(f"c{j}" for j in range(2_500))})) for r in wide]
    assert metrics.tile_similarity(hashed, None) == pytest.approx(3 * 2_500 / (2 * 4_000 - 2_500))


def test_bigrams_of_copies_and_of_a_long_row(spark):
    """Copies are one row with a weight: 3,000 of them in tiles of one row would be 4.5 million tasks. A row's bigrams take time in its length."""
    df = spark.range(3_000).select(F.col("id").alias("k"), F.lit("the same words").alias("t"))
    tokens = F.split("t", " ")
    assert tuple(metrics.bigram_jaccard_diversity(df, "k", tokens, tile_rows=1).first()) == (3_000 * 2_999 // 2, 0.0)
    long = " ".join(f"w{i % 39_999}" for i in range(40_000))
    both = spark.createDataFrame([(0, long), (1, long + " w5 w6 w1"), (2, "w0 w1")], "k long, t string")
    got = metrics.bigram_jaccard_diversity(both, "k", tokens, tile_rows=1).first()
    one = 39_999
    want = 1 - (one / (one + 2) + 1 / one + 1 / (one + 2)) / 3
    assert got["pairs"] == 3 and got["diversity"] == pytest.approx(want, abs=1e-12)


def test_index_beyond_a_broadcast(spark):
    """The branch of tiles gives the rows of the branch of broadcasts, ties and vectors without a match among them."""
    import numpy as np
    from dialoom.operators import lookup

    rng = np.random.default_rng(4)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).tolist()
    base = rng.normal(size=(12, 6))
    entries = unit(base[rng.integers(0, 12, 300)] + rng.normal(size=(300, 6)) * 0.2)
    entries[10] = entries[11] = entries[12]
    index = spark.createDataFrame([(i, f"e{i}", v) for i, v in enumerate(entries)], "ord long, ko string, vector array<double>")
    queries = spark.createDataFrame([(f"q{i}", v) for i, v in enumerate(unit(base[rng.integers(0, 12, 80)] + rng.normal(size=(80, 6)) * 0.2))] + [("same", entries[11]), ("none", [0.0] * 6), ("null", None)], "term string, vector array<double>")
    for top, threshold in ((3, 0.65), (2, 0.95), (5, -1.0)):
        got = {c: sorted((r["term"], r["rank"], r["ko"], r["ord"], round(r["similarity"], 9)) for r in lookup.nearest(queries.where("vector is not null"), index, top=top, threshold=threshold, broadcast_bytes=c).collect()) for c in (0, 1 << 30)}
        assert got[0] == got[1 << 30] and len(got[0]) > 80, (top, threshold)
    few = sorted((r["q"], r["o"]) for r in lookup.tiled_hits(queries.select(F.col("term").alias("q"), F.col("vector").alias("v")), index.select(F.col("ord").alias("o"), F.col("vector").alias("v")), 2, 0.9, block=16).collect())
    assert len(few) > 80 and not any(q in ("none", "null") for q, _ in few)


def test_dialogue_levels(spark):
    t = lambda *x: F.from_json(F.lit(json.dumps(turns(*x))), "array<struct<index:int,speaker:string,text:string>>")
    got = spark.range(1).select(dialogue.mixed_levels(t("감사합니다", "고마워")).alias("a"), dialogue.mixed_levels(t("감사합니다", "알겠습니다")).alias("b"), dialogue.mixed_levels(t("", "x")).alias("c")).first()
    assert tuple(got) == (True, False, False)


def test_polish_falls_back(spark):
    draft = F.from_json(F.lit(json.dumps(turns("좋아", "가자"))), "array<struct<index:int,speaker:string,text:string>>")
    refined = lambda *x: F.from_json(F.lit(json.dumps([{"speaker": "A", "text": y} for y in x])), "array<struct<speaker:string,text:string>>")
    none = F.array().cast(dict(f.split(" ", 1) for f in ["persona " + schema("stage2")["persona"].dataType.simpleString()])["persona"])
    people = F.array().cast(schema("stage2")["speakers"].dataType)

    def polish(*x):
        made, error = dialogue.normalise_polish(draft, refined(*x), F.lit("friendship"), none, people)
        r = spark.range(1).select(made.alias("m"), error.alias("e")).first()
        return r["e"] or [t["text"] for t in r["m"]]

    assert polish("정말 좋아", "가자 ok") == ["정말 좋아", "가자"]
    assert polish("고객님 좋아", "가자") == ["좋아", "가자"]
    assert polish("하나") == "turns: 1 for 2"
    assert polish("좋아", " ") == "an empty turn"


def test_metrics_and_export(spark):
    good = frame(spark, row(quality={"reward": {"correctness": 0.9}, "naturalness": 4}), row(id="r2"))
    bad = frame(spark, row(id="b", valid=False, reject_reasons=[{"stage": "stage3.phase2", "rule": "ascii_ratio", "detail": "x"}], retry_actions=[{"action": "stage2_rewrite"}]))
    m = metrics.compute(good, bad).first()
    assert m["rows"].asDict() == {"accepted": 2, "rejected": 1, "total": 3}
    assert m["rewards"]["correctness"]["mean"] == 0.9 and m["rejects"] == {"stage3.phase2:ascii_ratio": 1}
    assert m["retries"]["by_action"] == {"stage2_rewrite": 1} and m["lengths"]["turns"]["p50"] == 2.0
    assert m["diversity"]["diversity"] == 0.0 and m["distinct_n"][1] == 0.5
    empty = metrics.compute(good.limit(0), bad.limit(0)).first()
    assert empty["rows"]["total"] == 0 and empty["rewards"] == {} and empty["distinct_n"] == {1: 0.0, 2: 0.0, 3: 0.0}
    sft = export.sft(good.where("id = 'r1'")).first()
    assert [x["role"] for x in sft["messages"]] == ["user", "assistant"] and sft["metadata"]["quality_score"]["naturalness"]["score"] == 4
    assert "<li>" in export.html_report({"a": {"b": 1.0}})


def _shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_tables_between_steps_leave_no_shuffle_files_and_passes_no_tables(spark):
    from dialoom.plans.case_queries import reasoned
    from dialoom.sources import scratch

    before, flag = _shuffled(spark), spark.conf.get(scratch._CLEANUP)
    made = scratch.checkpointed(spark.range(1000).repartition(5, "id").groupBy("id").count())
    assert not _shuffled(spark) - before and spark.conf.get(scratch._CLEANUP) == flag
    assert made.count() == 1000

    folder = scratch.scratch_folder(spark).removeprefix("file:")
    held = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rows = retry.queue(retry.derive(reasoned(spark, "/root/testdata/sf0.001")))
    done = retry.repair(rows, dict.fromkeys(("maps_ref_redo", "websearch_cultural"), lambda x: x), scratch.checkpointed)
    assert done.count() == rows.count() and done.where("iter > 0").count() == done.count()
    assert len(set(os.listdir(folder)) - held) == 1


def test_copies_of_vectors(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    v = [rng.normal(size=3).tolist() for _ in range(40)]
    v += [v[5], v[7], v[5], [0.0, 1.0, 0.0], [-0.0, 1.0, -0.0]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "id long, v array<double>").repartition(4)
    assert {(r["id"], r["first"]) for r in dedup.vector_copies(rows).collect()} == {(40, 5), (41, 7), (42, 5), (44, 43)}
