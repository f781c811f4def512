from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import align, link, relational
from corpusloom.plans import pipelines

MARKERS = "text_uuid string, sentence_uuid string, sentence_obj_in_text double, first_word_obj_in_text double, first_word_transcription string, line_number string, translation string, sentence_row_id long"


def frames(spark, text, markers):
    train = spark.createDataFrame([("d", text, "T."), ("bare", "one two", "x"), ("empty", " ", "y")], "oare_id string, transliteration string, translation string")
    rows = [("d", f"s{k}", float(k), place, word, str(k), f"sentence {k}", k) for k, (word, place) in enumerate(markers, 1)]
    return train, spark.createDataFrame([*rows, ("gone", "s", 1.0, 1.0, "a", "1", "t", 90), ("empty", "e", 1.0, 1.0, "a", "1", "t", 91)], MARKERS)


MARKS = [("a-na", 1.0), ("umma", 3.0), ("xyz", 5.0), ("zzz", None)]


def test_three_tiers(spark):
    out = pipelines.build_pairs(*frames(spark, "a-na A-šùr um-ma pu-zur qí-bi", MARKS))
    rows = out["pairs"].orderBy("sentence_row_id").collect()
    assert [(r.source_start_word_idx - 1, r.boundary_method) for r in rows] == [(0, "marker_search"), (2, "marker_search"), (4, "first_word_obj_fallback"), (4, "proportional_fallback")]
    assert [r.source_sentence_raw for r in rows] == ["a-na A-šùr", "um-ma pu-zur", "qí-bi", "qí-bi"]
    assert [r.target_sentence for r in rows] == ["sentence 1", "sentence 2", "sentence 3", "sentence 4"]
    assert {(r.text_uuid, r.unmatched_reason) for r in out["unmatched"].collect()} == {("bare", "no_sentence_markers"), ("empty", "alignment_not_generated")}
    cover = {r.text_uuid: (r.expected_sentence_rows, r.produced_sentence_rows, r.coverage_percent) for r in out["coverage"].collect()}
    assert cover == {"d": (4, 4, 100.0), "bare": (0, 0, 0.0), "empty": (1, 0, 0.0)}
    assert out["ready"].count() == 4


def test_tokens_without_letters_match_unless_strict(spark):
    train, marks = frames(spark, "a-na A-šùr um-ma pu-zur qí-bi É ki-ma", MARKS)
    loose = pipelines.build_pairs(train, marks)["pairs"].orderBy("sentence_row_id").collect()
    assert [r.source_start_word_idx - 1 for r in loose] == [0, 2, 5, 5] and {r.boundary_method for r in loose} == {"marker_search"}
    strict = pipelines.build_pairs(train, marks, pipelines.PairOptions(strict_empty=True))["pairs"].orderBy("sentence_row_id").collect()
    assert [r.boundary_method for r in strict][2:] == ["first_word_obj_fallback", "proportional_fallback"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "ab", "b-c", "", "c"]), min_size=1, max_size=12), st.lists(st.tuples(st.sampled_from(["a", "abc", "bc", "zz", ""]), st.one_of(st.none(), st.integers(0, 20))), max_size=6))
def test_starts_are_in_the_document(tokens, marks):
    n = len(tokens)
    got = align.resolve_starts(tokens, [m for m, _ in marks], [None if p is None else min(p, n - 1) for _, p in marks])
    assert len(got) == len(marks) and all(0 <= s < n for s, _ in got)


@given(st.lists(st.integers(-5, 30), max_size=8), st.integers(1, 20))
def test_slices_never_fall_nor_are_empty(starts, n):
    got = align.slices(starts, n)
    assert len(got) == len(starts) and all(0 <= a < b <= n for a, b in got) and all(x[0] <= y[0] for x, y in zip(got, got[1:]))
    assert [a for a, _ in align.slices(sorted(s for s in starts if 0 <= s < n), n)] == sorted(s for s in starts if 0 <= s < n)


def test_verdicts():
    source, target = "a b c d e f", "one two three four"
    pairs = [("a b", "one"), ("", "x"), ("z", "one"), ("a b", "one"), ("b a", "two"), ("a", "two"), ("c d", "two"), ("d c", "three"), ("c d e", "three")]
    got = [(k, r) for k, r, *_ in align.judge_pairs(pairs, source, target, set())]
    assert got == [(1, "accepted"), (2, "empty_source_or_target"), (3, "not_exact_substring"), (4, "duplicate_pair"), (5, "not_exact_substring"), (6, "order_position_not_found"), (7, "accepted"), (8, "not_exact_substring"), (9, "order_position_not_found")]
    assert [r for _, r, *_ in align.judge_pairs([("a b", "one"), ("a b", "two")], "a b a b", "one two", set())] == ["accepted", "near_duplicate_overlap"]


def test_two_passes_and_status(spark):
    docs = spark.createDataFrame([("d", "a b c d", "one two three four"), ("e", "x", "y")], "oare_id string, transliteration string, translation string")
    first = spark.createDataFrame([("d", '{"pairs": [{"source_sentence": "a b", "target_sentence": "one two", "confidence": 0.5}], "leftover_source_text": "c d"}'), ("e", "no json")], "oare_id string, reply string")
    second = spark.createDataFrame([("d", '{"pairs": [{"source_sentence": "a b", "target_sentence": "one two"}, {"source_sentence": "c d", "target_sentence": "three four"}]}')], "oare_id string, reply string")
    verdicts = align.two_passes(docs, first, second)
    assert sorted((r.alignment_pass, r.reason) for r in verdicts.collect()) == [("first", "accepted"), ("second", "accepted"), ("second", "duplicate_pair")]
    status = {r.oare_id: r for r in align.alignment_status(docs, first, verdicts).collect()}
    assert (status["d"].status, status["d"].produced_pairs, status["d"].second_pass_added_pairs) == ("completed", 2, 1)
    assert (status["e"].status, status["e"].produced_pairs) == ("llm_error", 0)
    assert align.leftovers(align.alignment_status(docs, first, verdicts)).count() == 1
    assert align.validation_issues(verdicts).count() == 1 and align.aligned_pairs(verdicts).count() == 2


def test_four_tiers_of_links(spark):
    pages = spark.createDataFrame([("vol P111111", "1", "text P222222 and KTS 12", "True"), ("KTS 12", "2", None, " true"), ("x", "3", "P222222", "false")], "pdf_name string, page string, page_text string, has_akkadian string")
    published = spark.createDataFrame([("o1", "P111111|P222222", "KTS 12", "kts 12|ab", None, "t")], "oare_id string, cdli_id string, label string, aliases string, publication_catalog string, transliteration string")
    out = pipelines.link_pages(pages, published)
    assert sorted((r.page, r.match_source, r.match_confidence, r.matched_cdli) for r in out["matches"].collect()) == [("1", "page_text_cdli", 0.95, "P222222"), ("1", "page_text_ref", 0.82, ""), ("1", "pdf_name_cdli", 0.7, "P111111"), ("2", "pdf_name_ref", 0.76, "")]
    assert [(r.page, r.match_source, r.llm_ready) for r in out["shortlist"].collect()] == [("1", "page_text_cdli", 1)]
    assert link.page_matches(pages, published, akkadian_only=False).count() == 5
    assert tuple(out["summary"].first()) == (4, 1, 1, 1, 1)


def test_first_match_by_prefix(spark):
    left = spark.createDataFrame([("ab",), ("abcd",), ("",), (None,), ("zz",)], "p string")
    right = spark.createDataFrame([("abx", 2), ("abcde", 1), ("b", 3)], "f string, n int")
    got = {r.p: r.n for r in relational.prefix_lookup(left, right, "p", "f", right.n.asc()).collect()}
    assert got == {"ab": 1, "abcd": 1, "": None, None: None, "zz": None}
