import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import corpus, relational, responses
from corpusloom.plans import pipelines
from corpusloom.sources import tables
from corpusloom.streaming import resume


def test_csv_with_quotes_feeds_and_missing_cells(spark, tmp_path):
    rows = [("a", 'x "q"\ny'), ("b", None), ("c", "NaN"), ("d", "nan of it")]
    tables.write_csv(spark.createDataFrame(rows, "id string, translation string"), f"file://{tmp_path}/s")
    got = {r.id: r.translation for r in tables.read_csv(spark, f"file://{tmp_path}/s", tables.SCHEMAS["sample_submission"]).collect()}
    assert got == {"a": 'x "q"\ny', "b": None, "c": None, "d": "nan of it"}


def test_missing_files_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.require_files(spark, f"file://{tmp_path}/none")
    assert tables.read_optional(spark, f"file://{tmp_path}/none", "a string").count() == 0
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert relational.pick_column(df, ["x", "b"]) == "b"
    with pytest.raises(ValueError):
        relational.require_columns(df, ["a", "z"])


def test_shortest_path_wins(spark, tmp_path):
    for d in ("deep/er", "deep"):
        (tmp_path / d).mkdir(parents=True, exist_ok=True)
        (tmp_path / d / "train.csv").write_text("x")
    assert tables.find_file(spark, "train.csv", [f"file://{tmp_path}", "file:///no/such"]).endswith("/deep/train.csv")
    assert tables.find_file(spark, "none.csv", [f"file://{tmp_path}"]) is None


def test_environment_wins(tmp_path):
    p = tmp_path / ".env"
    p.write_text("# c\nA=1\nB='two'\n\nbad\n")
    assert tables.read_env(str(p), {"A": "9"}) == {"A": "9", "B": "two"}


def test_log_and_done_keys(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    log = spark.createDataFrame([("k1", "", "{\"a\":1}"), ("k2", "boom", None), ("k3", "", "{}")], "input_key string, error string, parsed string")
    tables.append_jsonl(log, path)
    (tmp_path / "log" / "broken.json").write_text('{"input_key": "k9", \n')
    assert [r.input_key for r in tables.done_keys(spark, path).collect()] == ["k1"]
    assert {r.input_key for r in tables.done_keys(spark, path, only_parsed=False).collect()} >= {"k1", "k2", "k3"}
    assert tables.done_keys(spark, f"file://{tmp_path}/none").count() == 0


def test_history_widens(spark, tmp_path):
    path = f"file://{tmp_path}/h"
    tables.append_history(spark, path, spark.createDataFrame([("r1", 1)], "run string, a int"))
    got = tables.append_history(spark, path, spark.createDataFrame([("r2", 2)], "run string, b int"))
    assert {(r.run, r.a, r.b) for r in got.collect()} == {("r1", 1, None), ("r2", None, 2)}


def test_submission_guard(spark):
    ok = spark.createDataFrame([(1, "a"), (2, "b")], "id int, translation string")
    assert relational.unique_key_or_error(ok, "id", ["translation"]) is ok
    for bad in ([(1, "a"), (1, "b")], [(1, None)]):
        with pytest.raises(ValueError):
            relational.unique_key_or_error(spark.createDataFrame(bad, "id int, translation string"), "id", ["translation"])


def flaky(prompt):
    if "fail" in prompt:
        raise RuntimeError("down")
    return json.dumps({"found": True, "confidence": 0.9, "translation_english": prompt.upper()})


def test_calls_are_retried_and_errors_kept(spark):
    prompts = spark.createDataFrame([("a||1||o1", "hello"), ("a||2||o2", "fail")], "input_key string, prompt string")
    log = {r.input_key: r for r in responses.call_model(prompts, flaky, retries=2, wait=lambda k: 0.0).collect()}
    assert (log["a||1||o1"].error, log["a||1||o1"].attempts) == ("", 1)
    assert (log["a||2||o2"].error, log["a||2||o2"].attempts) == ("down", 2)
    assert [responses.backoff(k) for k in (1, 2, 3, 9)] == [2, 4, 8, 8]
    assert responses.check_budget(prompts.withColumn("prompt", F.repeat("prompt", 1000)), 100).count() == 0


def test_silver_pairs(spark):
    short = spark.createDataFrame([("a", "1", "o1", "page_text_ref", 0.82, "src"), ("a", "2", "o2", "page_text_ref", 0.82, "src2")], "pdf_name string, page string, oare_id string, match_source string, match_confidence double, transliteration string")
    pairs = {"found": True, "confidence": 0.9, "pairs": [{"source_sentence": "s", "target_sentence_english": " t "}, {"source_sentence": "", "target_sentence_english": "u"}, {"target_sentence_english": " "}], "akkadian_from_page_text": [str(i) for i in range(12)]}
    log = spark.createDataFrame([("a||1||o1", "x " + json.dumps(pairs)), ("a||2||o2", json.dumps({"found": "false", "confidence": 1, "translation_english": "v"})), ("zz", "{}")], "input_key string, raw_text string")
    got = pipelines.silver(short, log).orderBy("pair_index").collect()
    assert [(r.source_transliteration, r.target_translation_english, r.pair_index) for r in got] == [("s", "t", 0), ("src", "u", 1)]
    assert got[0].akkadian_from_page_text == " | ".join(str(i) for i in range(10)) and got[0].language_detected == "other"
    again = spark.createDataFrame([("a||2||o2", json.dumps({"found": True, "confidence": "0.85", "pairs": [], "translation_english": "v"}))], "input_key string, raw_text string")
    assert [(r.source_transliteration, r.target_translation_english) for r in pipelines.silver(short, again).collect()] == [("src2", "v")]
    assert pipelines.silver(short, again, pipelines.ReplyOptions(min_target_chars=15)).count() == 0


def test_corpus_keeps_the_first_source(spark):
    a = spark.createDataFrame([("x y", "one two"), ("z", "too short")], "source string, target string")
    b = spark.createDataFrame([(" x  y ", "other text"), ("p q", "r s")], "source string, target string")
    assert {(r.source, r.target, r.provenance) for r in corpus.merge_sources(a=a, b=b).collect()} == {("x y", "one two", "a"), ("p q", "r s", "b")}


def test_resumed_stream_sees_each_file_once(spark, tmp_path):
    src, out, ck = (f"file://{tmp_path}/{n}" for n in ("in", "out", "ck"))
    work = lambda b: b.withColumn("twice", F.col("v") * 2)
    for v in (1, 2):
        spark.createDataFrame([(v,)], "v int").coalesce(1).write.mode("append").parquet(src)
        rows = resume.process_new(spark, src, "v int", work, out, ck)
        assert sorted(r.twice for r in rows.collect()) == [2 * i for i in range(1, v + 1)]


def test_rolling_load(spark):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2024-01-01 00:00:00', 5), (1, timestamp_ntz'2024-01-01 00:01:00', 7), (1, timestamp_ntz'2024-01-01 00:01:01', 1) t(k, ts, n)")
    got = [(r.window_requests, r.window_tokens, r.admitted) for r in resume.admitted(resume.rolling_load(df, "k", "ts", "n"), 2, 10).orderBy("ts").collect()]
    assert got == [(1, 5, True), (2, 12, False), (2, 8, True)]


def test_next_documents_skip_before_limit(spark):
    docs = spark.createDataFrame([(str(i),) for i in range(6)], "oare_id string")
    done = spark.createDataFrame([("0",), ("1",)], "oare_id string")
    assert [r.oare_id for r in pipelines.next_documents(docs, done, pipelines.AlignOptions(max_docs=2)).collect()] == ["2", "3"]
    assert pipelines.next_documents(docs, done, pipelines.AlignOptions(resume=False)).count() == 6


def test_row_ids_and_buckets(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS g")
    got = {r.id: r.n for r in relational.row_ids(df, "n", "g", "id").collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(range(100), key=lambda i: (i % 7, i)) and sorted(got.values()) == list(range(100))
    rows = relational.length_buckets(df, "g", 3, 10, "id").collect()
    assert sorted({r.bucket for r in rows}) == [0, 1, 2] and sum(r.bucket == 2 for r in rows) == 34


def test_programs_on_files(spark, tmp_path):
    from corpusloom.__main__ import main

    src = tmp_path / "in"
    src.mkdir()
    (src / "train.csv").write_text('oare_id,transliteration,translation\nd,"a-na A-šùr um-ma","To Assur"\n')
    (src / "marks.csv").write_text("text_uuid,sentence_uuid,sentence_obj_in_text,first_word_obj_in_text,first_word_transcription,line_number,translation\nd,s1,1,1,a-na,1,To\nd,s2,2,3,um-ma,2,Say\n")
    (src / "publications.csv").write_text('pdf_name,page,page_text,has_akkadian\nx,1,"see KTS 12\nend",True\n')
    (src / "published_texts.csv").write_text(",".join(c.split()[0] for c in tables.SCHEMAS["published_texts"].split(", ")) + "\no1,,P111111,,KTS 12" + "," * 13 + "t\n")
    main(["pairs", "--input", f"file://{src}", "--output", f"file://{tmp_path}/out", "--markers", "marks.csv"], spark)
    main(["link", "--input", f"file://{src}", "--output", f"file://{tmp_path}/out"], spark)
    assert [r.source_sentence_raw for r in spark.read.parquet(f"file://{tmp_path}/out/pairs").orderBy("sentence_obj_in_text").collect()] == ["a-na A-šùr", "um-ma"]
    assert spark.read.parquet(f"file://{tmp_path}/out/history").first().sentence_pairs == 2
    assert [(r.oare_id, r.page_text) for r in spark.read.parquet(f"file://{tmp_path}/out/shortlist").collect()] == [("o1", "see KTS 12 end")]


def echo_alignment(prompt):
    """A model that pairs the first words on both sides and leaves the rest over, once."""
    import json

    doc = json.loads(prompt)["document"]
    source, target = doc["full_transliteration"].split(), doc["full_translation"].split()
    rest = [" ".join(x[1:]) for x in (source, target)]
    return json.dumps({"oare_id": doc["oare_id"], "pairs": [{"source_sentence": source[0], "target_sentence": target[0], "confidence": "0.9"}], "leftover_source_text": rest[0], "leftover_target_text": rest[1]})


def echo_page(prompt):
    if "page 2" in prompt:
        raise RuntimeError("no answer")
    return '{"found": true, "confidence": 0.95, "translation_english": "a long translation"}'


def test_programs_that_call_a_model(spark, tmp_path):
    from corpusloom.__main__ import main

    src, out = tmp_path / "in", f"file://{tmp_path}/out"
    src.mkdir()
    (src / "train.csv").write_text('oare_id,transliteration,translation\nd1,a-na um-ma x,To Say y\nd2,qí-bi,Speak\nd3,no markers,None here\n')
    (src / "sentence_markers.csv").write_text("text_uuid,sentence_uuid,sentence_obj_in_text,first_word_obj_in_text,first_word_transcription,line_number,translation\nd1,s1,1,1,a-na,1,To\nd2,s2,1,1,qí-bi,1,Speak\n")
    run = ["align", "--input", f"file://{src}", "--output", out, "--client", "test_sources:echo_alignment", "--max-docs", "1"]
    main(run, spark)
    pairs = lambda: sorted((r.oare_id, r.alignment_pass, r.source_sentence_raw) for r in spark.read.parquet(f"{out}/pairs").collect())
    assert pairs() == [("d1", "first", "a-na"), ("d1", "second", "um-ma")]
    main(run, spark)  # the next document
    main([*run, "--no-second-pass"], spark)  # none is left
    assert pairs()[2:] == [("d2", "first", "qí-bi")] and spark.read.parquet(f"{out}/history").count() == 2
    short = spark.createDataFrame([("f", "1", "o1", "page_text_ref", 0.82, "a-na", "text"), ("f", "2", "o1", "page_text_ref", 0.82, "a-na", "text")], "pdf_name string, page string, oare_id string, match_source string, match_confidence double, transliteration string, page_text string")
    short.write.parquet(f"{out}/short")
    read = ["read", "--shortlist", f"{out}/short", "--output", f"{out}/read", "--client", "test_sources:echo_page", "--retries", "1", "--callers", "2"]
    main(read, spark)
    main(read, spark)  # sends only the page that failed
    log = tables.read_jsonl(spark, f"{out}/read/calls", responses.LOG).collect()
    assert sorted((r.input_key, r.error) for r in log) == [("f||1||o1", ""), ("f||2||o1", "no answer"), ("f||2||o1", "no answer")]
    assert [r.target_translation_english for r in spark.read.parquet(f"{out}/read/silver").collect()] == ["a long translation"]


def test_limiter():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s))
        now[0] += s

    limit = responses.Limiter(2, 100, lambda: now[0], sleep)
    for tokens in (40, 40, 10, 95):
        limit.admit(tokens)
    assert slept == [60, 60] and now[0] == 120
    with pytest.raises(ValueError):
        limit.admit(101)
    with pytest.raises(ValueError):
        responses.call_model(None, echo_page, requests_per_minute=3, callers=4)


def test_seeded_split_is_stable(spark):
    df = spark.range(2000)
    one = {r.id: r.split for r in relational.seeded_split(df, 0.05, 42, "id").collect()}
    assert one == {r.id: r.split for r in relational.seeded_split(df.repartition(7), 0.05, 42, "id").collect()}
    assert 60 < sum(v == "valid" for v in one.values()) < 140
