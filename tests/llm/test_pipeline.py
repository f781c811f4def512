import duckdb
import pytest

from llm import brute
from corpusloom.llm import toxicity

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.train(docs, labels)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    rows = [(i, t) for i, t in rows if machine.score((t or "").encode()) < toxicity.CUT]
    rows = [(i, t) for i, t, *_ in brute.lines(rows)]
    keep = {i for i, _, c in brute.near_groups(rows) if i == c}
    rows = [(i, t) for i, _, _, t in brute.substrings([r for r in rows if r[0] in keep])]
    got = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, SF)
        assert got.columns == list(corpus_pipeline.COLUMNS)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == sorted((i, t, len(t)) for i, t in rows)
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in rows} and max(r.offset + r.length for r in packed) <= 4096


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, n_words long, n_lines string, n_cut int, component_id long, score double, toxic int, length long, Text string, `a.b` string, __score double"


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, "x", "en", "a", 1), (3, "x", "en", "a", 1), (None, "y z", "en", "a", 3), (None, "y z", "en", "a", 3), (4, "long " * 30_000, "en", "a", 1)]
    docs = spark.createDataFrame([(*r, 1, "l", 1, 1, 0.9, 1, 1, "t", "x", 0.9) for r in rows], CLASHING)
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        kept.append(docs.count())
    # one of the two empty texts stays, repeated ids share their fate, a group of null ids keeps its rows
    assert kept[:4] == [7, 7, 6, 6] and kept[4] == 5 + -(-30_001 // 4096)


def test_empty_table(spark):
    docs = spark.createDataFrame([], CLASHING)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
