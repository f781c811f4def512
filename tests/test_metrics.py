import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import metrics, select

WORDS = st.lists(st.sampled_from(["the", "cat", "sat", "on", "a", "mat."]), max_size=8).map(" ".join)


def rows(spark, pairs):
    return spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "id int, hyp string, ref string")


def col(df, c):
    return [r[c] for r in sorted(df.collect())]


def brute_char_f(h, r, n=6, beta=2.0):
    h, r = h.strip().lower(), r.strip().lower()
    if not h or not r:
        return 0.0
    grams = lambda t: Counter([t[i : i + n] for i in range(len(t) - n + 1)] if len(t) >= n else [t])
    a, b = grams(h), grams(r)
    hit = sum((a & b).values())
    p, q = hit / sum(a.values()), hit / sum(b.values())
    return 0.0 if p + q == 0 else (1 + beta**2) * p * q / (beta**2 * p + q)


def brute_bleu(h, r):
    h, r = h.lower().split(), r.lower().split()
    logs = 0.0
    for n in range(1, 5):
        a, b = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (h, r))
        hit = sum((a & b).values())
        if n == 1 and not hit:
            return 0.0
        logs += math.log((hit or 0.1) / max(1, sum(a.values()))) / 4
    return math.exp(logs) * (1 if len(h) >= len(r) else math.exp(1 - len(r) / len(h)))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), min_size=1, max_size=12))
def test_sentence_scores_against_brute_force(spark, pairs):
    df = rows(spark, pairs)
    assert col(metrics.char_f(df), "char_f") == pytest.approx([brute_char_f(h, r) for h, r in pairs])
    assert col(metrics.sentence_bleu(df), "bleu") == pytest.approx([brute_bleu(h, r) for h, r in pairs])


def test_identical_texts_score_highest(spark):
    df = rows(spark, [("The cat sat on the mat.", "The cat sat on the mat."), ("a b", None)])
    assert col(metrics.chrf(df), "chrf") == pytest.approx([100.0, 0.0])
    one = rows(spark, [("The cat sat on the mat.", "The cat sat on the mat.")])
    assert tuple(metrics.corpus_score(one).first()) == pytest.approx((100.0, 100.0, 100.0))


def test_chrf_by_hand(spark):
    # characters: orders 1 and 2 of "ab" and "ac": 1 of 2, 0 of 1; words: 0 of 1; two-word order has no totals
    got = col(metrics.chrf(rows(spark, [("ab", "ac")])), "chrf")
    assert got == pytest.approx([100 * (1 / 2 + 0 + 0) / 3])


def test_13a_tokens(spark):
    got = spark.createDataFrame([('Hello, "world"! It costs 1,000.5-dollars &amp; more.',)], "t string").select(metrics.tokenize_13a("t")).first()[0]
    assert got == ["Hello", ",", '"', "world", '"', "!", "It", "costs", "1,000.5", "-", "dollars", "&", "more", "."]


def test_corpus_bleu_smooths_orders_without_hits(spark):
    got = metrics.corpus_bleu(rows(spark, [("a b x d", "a b c d")])).first().bleu
    # 3 of 4, 1 of 3, then 1/2 of 2 and 1/4 of 1
    assert got == pytest.approx(100 * (3 / 4 * 1 / 3 * 1 / (2 * 2) * 1 / (4 * 1)) ** 0.25)


def test_consensus(spark):
    pools = spark.createDataFrame([(1, ["the cat sat", "the cat sat down", "a dog", "the cat sat"]), (2, ["only"]), (3, []), (4, [" ", ""])], "id int, pool array<string>")
    geo = {r.id: r.text for r in select.mbr_geo(pools).collect()}
    assert geo == {1: geo[1], 2: "only", 3: "", 4: ""} and geo[1].startswith("the cat")
    chrf = {r.id: (r.text, r.unique_candidates) for r in select.mbr_chrf(pools).collect()}
    assert chrf[1][1] == 3 and chrf[1][0].startswith("the cat") and chrf[2] == ("only", 1) and chrf[3] == (None, 0)


def test_nearest_is_the_text_itself(spark):
    train = spark.createDataFrame([(1, "um-ma A-šùr"), (2, "a-na Puzur"), (3, "a-na Puzur")], "id int, x string")
    test = spark.createDataFrame([(9, "a-na Puzur"), (8, "qqq")], "id int, x string")
    assert [(r.test_id, r.train_id, r.similarity) for r in select.nearest(train, test).collect()] == [(9, 2, 1.0)]
