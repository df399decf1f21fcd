"""Sources, layers, command line and streaming on small files."""

import json

import pytest
from pyspark.sql import functions as F

from dialoom.functions import stats, text
from dialoom.functions.vectors import cosine
from dialoom.operators import dialogue, lookup, models, normalize, personas
from dialoom.plans import cli, pipeline
from dialoom.plans.schemas import schema
from dialoom.sources import dictionary, jsonl
from dialoom.sources import personas as bank_source
from dialoom.streaming import resume

RAW = [
    {"original_index": 0, "dialogue": ["We ate at Chipotle", "Happy Thanksgiving"], "speakers": ["Ann", "Bob"], "narrative": "lunch"},
    {"original_index": 1, "dialogue": ["Hello", "Hi", "Bye"], "speakers": ["Ann", "Bob", "Ann"]},
    {"id": "own", "original_index": 2, "dialogue": ["My boss called"], "speakers": ["Cy"]},
]
DICTIONARY = {
    "_comment": "x", "Chipotle": {"ko": "치폴레", "type": "brand"}, "thanksgiving": {"ko": "추수감사절", "type": "holiday", "notes": "n"}, "THANKSGIVING!": {"ko": "추석", "type": "holiday"},
    "hidden": {"ko": "숨김", "type": "other", "source": "retrieved"}, "seen": {"ko": "보임", "type": "other", "source": "retrieved", "reviewed": True}, "text": "no entry",
}


def lines(path, rows):
    path.write_text("".join(f"{r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)}\n" for r in rows), encoding="utf-8")
    return str(path)


@pytest.fixture
def entries(spark, tmp_path):
    (tmp_path / "dict.json").write_text(json.dumps(DICTIONARY, ensure_ascii=False), encoding="utf-8")
    return dictionary.read_dictionary(spark, str(tmp_path / "dict.json"))


def test_reading(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", [RAW[0], "", '{"not": "a valid row"}', RAW[1], "[1]", "oops"])
    good, bad = jsonl.read_rows(spark, path, "raw")
    assert {r["_lineno"]: r["original_index"] for r in good.collect()} == {1: 0, 4: 1}
    assert sorted(r["lineno"] for r in bad.collect()) == [3, 5, 6]
    with pytest.raises(Exception, match="a.jsonl:3: "):
        jsonl.read_strict(spark, path, "raw").collect()
    assert jsonl.count_rows(spark, path) == 5 and jsonl.read_objects(spark, str(tmp_path / "none")).count() == 0
    assert [f.name for f in good.schema][1:] == [f.name for f in schema("raw")]


def test_writing(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "x")], "id string, t string")
    jsonl.write_rows(df, f"{tmp_path}/o")
    jsonl.write_rows(df.limit(1), f"{tmp_path}/o", "append")
    raw = [r["value"] for r in spark.read.text(f"{tmp_path}/o").collect()]
    assert len(raw) == 3 and '{"id":"a","t":null}' in raw
    assert sorted(r["id"] for r in jsonl.ids(spark, f"{tmp_path}/o").collect()) == ["a", "b"]
    jsonl.replace_rows(spark.read.json(f"{tmp_path}/o").where("id = 'b'"), f"{tmp_path}/o")
    assert jsonl.count_rows(spark, f"{tmp_path}/o") == 1
    jsonl.replace_rows(spark.read.json(f"{tmp_path}/o").where("id = 'z'"), f"{tmp_path}/o")
    assert not (tmp_path / "o").exists()


@pytest.mark.parametrize("stop", ["before", "after"])
def test_a_swap_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch, stop):
    """Before the pointer moves readers have the old rows, after it the new; the next swap finishes what was left."""
    path = f"{tmp_path}/q"
    jsonl.write_rows(spark.createDataFrame([("a",), ("b",)], "id string"), path)
    read = lambda: sorted(r["id"] for r in jsonl.ids(spark, path).collect())
    name = "_settle_swap" if stop == "after" else "swap"
    with monkeypatch.context() as m:
        m.setattr(jsonl, name, lambda *a: (_ for _ in ()).throw(OSError("power")))
        with pytest.raises(OSError):
            jsonl.replace_rows(spark.createDataFrame([("c",)], "id string"), path)
    assert read() == (["c"] if stop == "after" else ["a", "b"]) and jsonl.count_rows(spark, path) == len(read())
    jsonl.write_rows(spark.createDataFrame([("d",)], "id string"), path, "append")
    assert read() == (["c", "d"] if stop == "after" else ["a", "b", "d"])
    jsonl.replace_rows(spark.read.json(jsonl.located(spark, path)).where("id = 'd'"), path)
    assert read() == ["d"] and jsonl.located(spark, path) == path and not (tmp_path / "q.current").exists()
    # a run that breaks off while the old folder is gone and the new one has not moved yet
    jsonl.write_rows(spark.createDataFrame([("e",)], "id string"), f"{path}.v-1")
    (tmp_path / "q.current").write_text(f"{path}.v-1")
    assert read() == ["e"]
    jsonl.replace_rows(spark.createDataFrame([("f",)], "id string"), path)
    assert read() == ["f"]


def test_a_torn_file_is_repaired(spark, tmp_path):
    """A file that was cut in the middle of a line: what stands before it stays, and a resumed run gives each identifier once."""
    folder = tmp_path / "out"
    folder.mkdir()
    body = "".join(json.dumps({"id": f"r{i}", "text": "x" * i}) + "\n" for i in range(200))
    (folder / "part-0.json").write_text(body[: body.index('"r150"') + 3])
    (folder / "part-1.json").write_text(json.dumps({"id": "whole"}) + "\n\n")
    (folder / "part-2.json").write_text(json.dumps({"id": "first"}) + "\nnot json\n" + json.dumps({"id": "lost"}) + "\n")
    assert jsonl.repair(spark, str(folder)) == 3 and jsonl.repair(spark, str(folder)) == 0
    done = jsonl.ids(spark, str(folder))
    assert {r["id"] for r in done.collect()} == {f"r{i}" for i in range(150)} | {"whole", "first"}
    rows = spark.range(200).select(F.concat(F.lit("r"), "id").alias("id"))
    jsonl.write_rows(dialogue.unfinished(rows, done), str(folder), "append")
    again = [r["id"] for r in spark.read.json(jsonl.located(spark, str(folder))).where("id like 'r%'").collect()]
    assert sorted(again) == sorted(f"r{i}" for i in range(200))
    assert jsonl.repair(spark, str(folder)) == 0


@pytest.mark.parametrize("limit", [None, 0, 7, 25, 1000])
def test_staged_source(spark, tmp_path, limit):
    """Parts in the order of their names, positions over all of them, columns of other names; a limit opens no row group beyond it."""
    from dialoom.sources import staged

    staged.register(spark)
    rows = [(i, [f"t{i}"] if i % 4 else [], ["A"] if i % 5 else None, None if i % 3 else f"n{i}") for i in range(60)]
    schema = "position long, turns array<string>, speakers array<string>, story string"
    for n in range(3):
        spark.createDataFrame(rows[20 * n : 20 * n + 20], schema).coalesce(1).write.parquet(f"{tmp_path}/set/part={n}")
    options = {"path": f"{tmp_path}/set", "name": "owner/soda:train", "dialogue": "turns", "narrative": "story"} | ({} if limit is None else {"limit": str(limit)})
    got = spark.read.format("dialoom_staged").options(**options).load()
    key = lambda df: sorted(map(str, df.collect()))
    want = jsonl.staged_dataset(spark.createDataFrame(rows, schema), "owner/soda:train", limit, dialogue="turns", narrative="story")
    assert key(got) == key(want)
    parts = staged.StagedReader(options).partitions()
    assert sum(p.rows for p in parts) == min(60, 60 if limit is None else limit) and len([p for p in parts if p.rows]) == {None: 3, 0: 0, 7: 1, 25: 2, 1000: 3}[limit]


def test_a_batch_costs_what_it_holds(spark, tmp_path, monkeypatch):
    """Only the first batch looks at what is there already; keys seen earlier are state."""
    (tmp_path / "in").mkdir()
    looked = []
    ids = jsonl.ids
    monkeypatch.setattr(resume.jsonl, "ids", lambda *a, **k: looked.append(a[1]) or ids(*a, **k))
    run = lambda: resume.validated(spark, f"{tmp_path}/in", "raw", f"{tmp_path}/out", f"{tmp_path}/ck", lambda d: d).awaitTermination()
    jsonl.write_rows(spark.createDataFrame([("old",)], "id string"), f"{tmp_path}/out")
    for n in range(4):
        lines(tmp_path / "in" / f"{n}.json", [RAW[2] | {"id": f"n{n}"}, RAW[2] | {"id": "n0"}, RAW[2] | {"id": "old"} if n == 0 else RAW[2] | {"id": f"n{n}"}])
        run()
    want = ["n0", "n1", "n2", "n3", "old"]
    got = lambda: sorted(r["id"] for r in spark.read.json(f"{tmp_path}/out", schema="id string").collect())
    assert len(looked) == 1 and got() == want
    # a run that was stopped between its output and its commit: the batch runs again and adds nothing
    for f in (tmp_path / "ck/commits").glob("*3*"):
        f.unlink()
    assert resume.uncommitted(spark, f"{tmp_path}/ck") == 3
    run()
    assert len(looked) == 2 and got() == want and resume.uncommitted(spark, f"{tmp_path}/ck") is None


def test_staged_dataset_limits_positions(spark):
    df = spark.createDataFrame([(0, ["a"], ["x"], None), (1, [], ["x"], "n"), (2, ["b"], ["y"], "n")], "position long, dialogue array<string>, speakers array<string>, narrative string")
    assert [r["id"] for r in jsonl.staged_dataset(df, "owner/soda:train", 2).collect()] == ["soda-0"]


def test_dictionary(spark, entries):
    seen = {r["key"]: r["ko"] for r in dictionary.index(entries).collect()}
    assert seen == {"chipotle": "치폴레", "thanksgiving": "추석", "seen": "보임"}
    assert "hidden" in {r["key"] for r in dictionary.index(entries, use_unreviewed=True).collect()}
    found = spark.createDataFrame([("hidden", "새", "other", ""), ("Chipotle", "x", "brand", ""), ("Costco", "코스트코", "brand", "")], "en string, ko string, type string, notes string")
    grown = dictionary.add_entries(entries, found)
    got = {r["en"]: (r["ko"], r["reviewed"]) for r in grown.collect()}
    assert got["hidden"] == ("새", False) and got["Costco"] == ("코스트코", False) and got["Chipotle"][0] == "치폴레"


def test_lookup_cascade(spark, entries):
    index = dictionary.index(entries)
    terms = spark.createDataFrame([("Thanksgiving!", "holiday", "c"), ("  CHIPOTLE ", "brand", "c"), ("unknown", "slang", "c")], "term string, type string, context string")
    resolve = lambda d: d.withColumns({"ko": F.lit(None).cast("string"), "notes": F.lit("web")})
    got = {r["term"].strip(): (r["mapped"]["ko"], r["mapped"]["source"]) for r in lookup.map_terms(terms, index, resolve=resolve).collect()}
    assert got == {"Thanksgiving!": ("추석", "dict"), "CHIPOTLE": ("치폴레", "dict"), "unknown": ("unknown", "web+llm")}
    vectors = lookup.build_index(index.withColumn("ord", F.monotonically_increasing_id()), models.embed)
    hits = lookup.nearest(spark.createDataFrame([("q",)], "term string").withColumn("vector", F.array(*[F.lit(0.35355)] * 8)), vectors, top=2, threshold=-1.0)
    assert hits.count() == 2 and lookup.clear_hits(hits, margin=-1.0).count() == 1


def test_normalisers(spark):
    df = spark.createDataFrame([("Happiness", "9", "2013", "Boy", "a/b, A,,c", "Thanks")], "e string, i string, a string, g string, l string, s string")
    r = df.select(normalize.emotion_type(F.col("e")).alias("e"), normalize.intensity(F.col("i")).alias("i"), normalize.age_group(F.col("a")).alias("a"), normalize.gender(F.col("g")).alias("g"), normalize.split_list(F.col("l")).alias("l"), normalize.speech_acts(F.array("s", F.lit("nonsense"))).alias("s")).first()
    assert tuple(r) == ("joy", 5, "teen", "male", ["a", "b", "c"], ["greeting"])
    halves = spark.createDataFrame([("2.5",), ("3.5",), ("x",), (None,)], "i string").select(normalize.intensity(F.col("i")).alias("i")).collect()
    assert [x["i"] for x in halves] == [2, 4, 3, 3]


def test_text(spark):
    df = spark.createDataFrame([("　 a \t b ",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(text.clean_text("t")).collect()] == ["a b", "", ""]
    assert [r[0] for r in df.select(F.round(text.ascii_ratio("t"), 3)).collect()][::2] == [0.25, 0.0]
    toks = spark.createDataFrame([("a\tb  c\nd ",)], "t string").select(text.blank_tokens("t").alias("x")).first()["x"]
    assert toks == ["a\tb", "c", "d"]
    levels = spark.createDataFrame([("감사합니다",), ("고마워",), ("감사합니다 고마워",), ("음",)], "t string").select(text.speech_level("t").alias("l")).collect()
    assert [x["l"] for x in levels] == ["polite", "casual", "mixed", "unknown"]


def test_nearest_rank(spark):
    for n in (1, 2, 4, 5, 40):
        df = spark.range(n).select(F.col("id").alias("v"))
        r = stats.nearest_rank(df, "v").first()
        assert (r["p50"], r["p95"], r["n"]) == (round(0.5 * (n - 1)), round(0.95 * (n - 1)), n)
    assert tuple(stats.nearest_rank(spark.range(0).select(F.col("id").alias("v")), "v").first()) == (0.0, 0.0, 0.0, 0)
    with pytest.raises(Exception, match="different sizes"):
        spark.range(1).select(cosine(F.array(F.lit(1.0)), F.array(F.lit(1.0), F.lit(2.0)))).collect()


def people(spark):
    rows = [(f"p{i}", 20 + i % 9, "20대", "여자" if i % 2 else "남자", "서울", "교사" if i % 5 == 0 else "회사원", "차분한 사람", f"id{i}", "학교 교육", "", "", "음악", "요리") for i in range(60)]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'age' else 'string'}" for c in bank_source.COLUMNS))


def test_personas(spark, tmp_path):
    bank_source.write_bank(people(spark), f"{tmp_path}/bank")
    bank = bank_source.read_bank(spark, f"{tmp_path}/bank")
    assert bank_source.read_bank(spark, f"{tmp_path}/bank", ["male"], ["20s"]).count() == 30
    speaker = {"name_en": "A", "role_in_scene": "teacher", "gender_hint": "female", "age_group_hint": "20s", "register": "casual", "dominant_emotion": {"type": "neutral", "intensity": 3}, "personality_traits": [], "interests_hints": [], "occupation_hint": "", "speech_style_notes": ""}
    rows = spark.createDataFrame([(json.dumps([speaker, speaker | {"name_en": "B"}]),)], "s string").select(F.lit("d1").alias("id"), F.from_json("s", schema("stage2")["speakers"].dataType).alias("speakers"))
    got = personas.select_personas(rows, bank, 7).first()["persona"]
    assert [e["speaker_name_en"] for e in got] == ["A", "B"]
    assert len({e["retrieved_persona"]["persona_id"] for e in got}) == 2
    # 교사 in the occupation: 8; 학교, 교육 in the text: 3 each; calm: a half
    assert all(e["selection_metadata"]["match_score"] == 14.5 and e["retrieved_persona"]["sex"] == "여자" for e in got)
    again = personas.select_personas(rows, bank, 7).first()["persona"]
    assert got == again


@pytest.mark.parametrize("mode", dialogue.MODES)
def test_modes(mode):
    m = dialogue.Mode(mode)
    assert m.polish == m.mapped_refs == (mode == "default") and m.persona == (mode != "direct")
    assert dialogue.queue_path("x/out.jsonl", "invalid") == "x/out.invalid.jsonl" and dialogue.dataset_token(" a b/") == "a-b"
    with pytest.raises(ValueError):
        dialogue.Mode("other")


def test_layers_from_the_command_line(spark, tmp_path):
    source = lines(tmp_path / "raw.jsonl", RAW)
    (tmp_path / "dict.json").write_text(json.dumps(DICTIONARY, ensure_ascii=False), encoding="utf-8")
    bank_source.write_bank(people(spark), f"{tmp_path}/bank")

    def decompose(df):
        payload = {"dialogue_decomposed": {"overall_register": "CASUAL", "overall_emotion": {"type": "Love", "intensity": "4"}, "speech_acts": ["inform"], "cultural_refs": [{"type": "brand", "term": "Chipotle"}, {"type": "Holiday", "term": "Thanksgiving"}, {"type": "food", "term": "absent"}]}}
        return df.withColumns({"payload": F.from_json(F.lit(json.dumps(payload)), normalize.PAYLOAD), "failure": F.lit(None).cast("string")})

    def generate(df):
        turns = F.to_json(F.transform("source_dialogue", lambda t: F.struct(t["speaker"].alias("speaker"), F.lit("치폴레 추석").alias("text"))))
        return df.withColumns({"payload": F.parse_json(turns), "failure": F.when(F.col("id") == "own", "Timeout: x")})

    calls = pipeline.Models(decompose=decompose, generate=generate)
    assert cli.main(["all", "--input", source, "--out", f"{tmp_path}/w", "--dictionary", f"{tmp_path}/dict.json", "--bank", f"{tmp_path}/bank"], spark, calls) == 0
    first = {r["id"]: r for r in spark.read.schema(schema("stage1")).json(f"{tmp_path}/w/stage1").collect()}
    assert set(first) == {"soda-0", "soda-1", "own"}
    assert [m["ko"] for m in first["soda-0"]["mapped_refs"]] == ["치폴레", "추석"] and first["soda-1"]["mapped_refs"] == []
    assert first["soda-0"]["dialogue_decomposed"]["overall_emotion"]["type"] == "joy" and first["soda-0"]["source_dialogue"][1]["speaker"] == "Bob"
    assert [r["id"] for r in jsonl.ids(spark, f"{tmp_path}/w/out.retry-errors.jsonl").collect()] == ["own"]
    assert pipeline.retry_source(spark, f"{tmp_path}/w/out.jsonl").endswith("retry-errors.jsonl")
    made = {p.name for p in (tmp_path / "w/stage3").iterdir()}
    assert made == {"accepted", "rejected", "retry_queue", "repaired", "reject_details", "parse_errors", "dataset_metrics"}
    metrics = json.loads(spark.read.text(f"{tmp_path}/w/stage3/dataset_metrics").first()[0])
    assert metrics["rows"] == {"accepted": 2, "rejected": 0, "total": 2}
    assert jsonl.count_rows(spark, f"{tmp_path}/w/reports/sft") == 2
    # nothing is left to do
    assert pipeline.run_second(spark, f"{tmp_path}/w/stage1", f"{tmp_path}/w/out.jsonl", calls) == {"saved": 0, "retry_error": 0, "invalid": 0}
    # the queue once more: the call works now, the row goes to the output and the queue is gone
    again = pipeline.Models(decompose=decompose, generate=lambda df: generate(df).withColumn("failure", F.lit(None).cast("string")))
    assert cli.main(["retry", "--input", f"{tmp_path}/w/out.jsonl", "--out", f"{tmp_path}/w"], spark, again) == 0
    assert {r["id"] for r in jsonl.ids(spark, f"{tmp_path}/w/out.jsonl").collect()} == {"soda-0", "soda-1", "own"}
    assert jsonl.ids(spark, f"{tmp_path}/w/out.retry-errors.jsonl").count() == 0
    # repair can be reached
    assert cli.main(["3", "--input", f"{tmp_path}/w/out.jsonl", "--out", f"{tmp_path}/w2", "--dictionary", f"{tmp_path}/dict.json", "--repair"], spark, again) == 0


def test_repair_tools(spark, tmp_path, entries):
    from tests.test_rules import frame, row, turns

    broken = row(mapped_refs=[], final_dialogue=turns("치폴레", "좋아"))
    broken["source_dialogue"] = turns("We met at Chipotle", "Nice")
    calls = pipeline.Models()
    limits = pipeline.rules.Limits(ascii_ratio_max=1.0, coherence_floor=-1.0)
    first = pipeline.validate(frame(spark, broken).withColumn("_ord", F.lit(0)), calls, limits).drop("_ord")
    assert first.first()["reject_reasons"][0]["rule"] == "cultural_ref_coverage"
    tools = pipeline.repair_tools(calls, dictionary.index(entries), None)
    done = pipeline.retry.repair(first, tools, lambda x: pipeline.revalidate(x, calls, limits), limits).first()
    assert done["valid"] and done["iter"] == 1 and done["mapped_refs"][0]["ko"] == "치폴레"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines(tmp_path / "in" / "a.json", [RAW[2], RAW[2], "junk"])
    run = lambda: resume.validated(spark, f"{tmp_path}/in", "raw", f"{tmp_path}/out", f"{tmp_path}/ck", lambda d: d.withColumn("seen", F.lit(1))).awaitTermination()
    run()
    lines(tmp_path / "in" / "b.json", [RAW[2], RAW[2] | {"id": "new"}])
    run()
    assert sorted(r["id"] for r in spark.read.json(f"{tmp_path}/out").collect()) == ["new", "own"]
    assert [r["error"] for r in spark.read.json(f"{tmp_path}/out-errors").collect()] == ["not a JSON object"]


def test_client_model(spark):
    def make():
        def call(r):
            if r["id"] == "b":
                raise TimeoutError("slow")
            return {"answer": r["id"] * 2}

        return call

    got = models.client_model(make, "answer string", threads=2)(spark.createDataFrame([("a",), ("b",)], "id string")).collect()
    assert {(r["id"], r["answer"], r["failure"]) for r in got} == {("a", "aa", None), ("b", None, "TimeoutError: slow")}
    verdicts = spark.createDataFrame([('{"User Safety": "safe"}',), ('{"S1": "Yes"}',), ("none",)], "v string").select(models.safety_verdict(F.col("v")).alias("s")).collect()
    assert [r["s"] for r in verdicts] == [True, False, False]
