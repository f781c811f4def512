from pyspark.sql import functions as F

from corpusloom.functions import jsons as J
from corpusloom.functions import text as X


def values(spark, texts, expr):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", expr.alias("v")).collect()
    return [r.v for r in sorted(rows)]


def test_transliteration_with_and_without_tag_brackets(spark):
    texts = ["[KÙ.BABBAR] il₅ [x] ... ḫa", "a-lim{ki} [ ... ] Ḫa!", "[... ...] <qí>-bi₄", "um-ma: A/B?", None, ""]
    assert values(spark, texts, X.normalize_transliteration("t")) == ["KÙ BABBAR il5 <gap> <big_gap> ha", "a-lim{ki} <big_gap> Ha", "<big_gap> <big_gap> qí-bi4", "um-ma A B", "", ""]
    assert values(spark, texts, X.normalize_transliteration("t", False)) == ["KÙ BABBAR il5 gap big_gap ha", "a-lim{ki} big_gap Ha", "big_gap big_gap qí-bi4", "um-ma A B", "", ""]


def test_match_tokens(spark):
    assert values(spark, ["A-šùr", "É", "Puzur₄-{d}UTU", "[x]", "Ṣí-lu"], X.token_for_match("t")) == ["a-šr", "", "puzur4-dutu", "gap", "ṣ-lu"]
    assert values(spark, ["A-šùr"], X.compact_token("t")) == ["ašr"]


def test_unicode_space(spark):
    assert values(spark, ["a  b \x1cc ", "\t", None], X.collapse_space("t")) == ["a b c", "", ""]
    assert values(spark, [" a  b ", "", None], X.word_count("t")) == [2, 0, 0]


def test_identifiers(spark):
    t = ["see BM 12345 and CCT 4 10a, P123456", "p.12 Kt 93/k 145", None]
    assert values(spark, t, X.publication_refs("t")) == [["BM12345", "CCT410A"], ["KT93"], []]
    assert values(spark, t, X.cdli_ids("t")) == [["P123456"], [], []]
    assert values(spark, [" a | |b|", None], X.split_multi_value("t")) == [["a", "b"], []]


def test_snippet(spark):
    text = "x" * 300 + " Needle " + "y" * 300
    assert values(spark, [text], X.snippet("t", F.lit("needle"), 10)) == ["x" * 9 + " Needle " + "y" * 9]
    assert values(spark, [text, ""], X.snippet("t", F.lit("none"), 10)) == ["x" * 20, ""]


def test_first_sentence(spark):
    assert values(spark, ["One. Two!", "no end", "", None, "a <b>! c"], X.first_sentence("t")) == ["One.", "no end.", "unknown", "unknown", "a b!"]


def test_diacritics_gaps_and_characters(spark):
    assert values(spark, ["sza-ru2 bi3-tim s,a-bi t,up E₂"], X.ascii_to_diacritics("t")) == ["ša-rú bì-tim ṣa-bi ṭup É"]
    assert values(spark, ["a x b … [..] ....c <gap>"], X.unify_gaps("t")) == ["a <gap> b <gap> <gap> <gap>c <gap>"]
    assert values(spark, ["x x x (3 broken lines) (large break) xx [ x ] ex"], X.unify_gaps("t", True)) == ["<gap> <gap> <gap> <gap> <gap> ex"]
    assert values(spark, ["ḫaʾ₅—ₓ–"], X.plain_characters("t")) == ["ha5--"]


def test_decimals(spark):
    assert values(spark, ["0.33333 ma 1.66667 2.12345 7.0000 a1.5000b 3.25 0.5001 12.99999", "none", None], X.snap_decimals("t")) == ["0.33333 ma 1.66666 2.12345 7 a1.5000b 3.25 0.5 12.99999", "none", ""]


def test_hints_and_postprocess(spark):
    assert values(spark, ["DUMU KÙ.BABBAR", "nothing"], X.commodity_hints("t")) == ["DUMU KÙ.BABBAR [Commodities: silver, son]", "nothing"]
    got = values(spark, ["PN gave 0.5 shekel [Commodities: tin] ... ... of of of tin , now .. (so)", None], X.postprocess("t"))
    assert got == ["<gap> gave ½ shekel <gap> of tin, now. so", ""]
    assert values(spark, ["a2 [x] 0.25000"], X.preprocess("t")) == ["translate Akkadian to English: á <gap> 0.25"]


def test_split_buckets(spark):
    ids = ["a1", "doc-7", "004a7dbd-57ce-46f8-9691-409be61c676e", "0126cd13-acf7-4cd5-8373-f1e7b54d824e"]
    assert values(spark, ids, X.split_bucket("t", "deep_past_split_v1")) == [9444, 5253, 1888, 9597]
    assert values(spark, ids, X.split_bucket("t", "deep_past_seq2seq_v1")) == [8355, 2738, 32, 3860]
    assert values(spark, ids, X.split_name("t", 0.1, "deep_past_seq2seq_v1")) == ["train", "train", "valid", "train"]


def test_numbers(spark):
    assert values(spark, ["1", "3.0", "0", "-2", "x", None, "99"], X.word_index("t", F.lit(5))) == [0, 2, None, None, None, None, 4]
    assert values(spark, ["", None, "abc", "a" * 9], X.estimated_tokens("t")) == [0, 0, 1, 2]


def test_ngrams(spark):
    assert values(spark, ["abcd", "ab"], X.char_ngrams("t", 3)) == [["abc", "bcd"], ["ab"]]
    assert values(spark, ["ab"], X.padded_ngrams("t")) == [[" ab", "ab ", " ab "]]
    assert values(spark, ["a"], X.padded_ngrams("t")) == [[" a "]]


def test_positions(spark):
    assert values(spark, ["abcabc"], X.position("t", F.lit("bc"))) == [1]
    assert values(spark, ["abcabc"], X.position("t", F.lit("bc"), 1)) == [4]
    assert values(spark, ["abcabc"], X.position("t", F.lit(""))) == [-1]


def test_replies(spark):
    t = ['```json\n{"found": true}\n```', 'Sure: {"found": "TRUE", "confidence": "0.9", "pairs": []} bye', "[1]", "{bad", None, '{"found": 1, "pairs": "no"}']
    assert [r is not None for r in values(spark, t, J.json_object("t"))] == [True, True, False, False, False, True]
    assert values(spark, t, J.true_flag(J.parse_reply("t")["found"])) == [True, True, False, False, False, False]
    assert values(spark, t, J.number_or_zero(J.parse_reply("t")["confidence"])) == [0.0, 0.9, 0.0, 0.0, 0.0, 0.0]


def test_prompt(spark):
    assert values(spark, ["x{y}", None], J.page_prompt("a {t} b {{t}", t="t")) == ["a x{y} b {x{y}", "a  b {"]
