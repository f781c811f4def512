"""Rules that SQL cannot say, against plain Python over drawn texts."""

import json
import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import jsons as J
from corpusloom.functions import text as X
from corpusloom.operators import relational, select
from corpusloom.streaming import resume

SPACE = r"[\s\x1c-\x1f]"
PARTS = [
    "x", "X", "xx", "x x", "x x x", "[x]", "[ x ]", "(x)", "( x )", "...", "....", "…", "……", "[...]", "[....]", "<gap>", "< gap >", "<GAP>", "<big_gap>", "<big gap>", "big gap", "big-gap", "(break)",
    "(large break)", "(3 broken lines)", "(1 broken line)", "PN", "PNs", "aPN", "the", "the the", "The the", "a a a", "word", "word.", "..", ",,", " ,", " .", " :", ";", "[Commodities: tin, silver]", "[commodities: x]",
    "0.33333", "12.33333", "0.123455", "2.345675", "7.000045", "1.99999", "3.16666", "5.0004", "0.50001", "a1.23456", "1.23456b", "1.23456/2", "/1.23456", "10.5", "0.8333", "0.25", "0.5", "1.0.33333",
    "sz", "s,", "t,", "a2", "e3", "U₂", "i₃", "ḫ", "Ḫ", "ₓ", "—", "–", "ʾ", "KÙ.BABBAR", "gín", "DUMU", "MA.NA", "ANŠE", "É", "+", "⌈a⌉", "(", ")", "1", "9.99999", "\t", "\n", "  ", " ",
]


def drawn(n=700):
    rng = random.Random(11)
    return ["", None, " ", *PARTS, *(rng.choice(["", " "]).join(rng.choice(PARTS) for _ in range(rng.randint(1, 9))) for _ in range(n))]


def gaps(t, wide=False):
    narrow = [r"<\s*gap\s*>", r"\.{3,}", r"…+", r"\[\.+\]", r"\bx\b"]
    wider = [r"<\s*big[\s_\-]*gap\s*>", r"<\s*gap\s*>", r"\bbig[\s_\-]*gap\b", r"\bx(?:\s+x)+\b", r"\.{3,}", r"…+", r"\[\.+\]", r"\[\s*x\s*\]", r"\(\s*x\s*\)", r"(?<!\w)x{2,}(?!\w)", r"(?<!\w)x(?!\w)", r"\(\s*large\s+break\s*\)", r"\(\s*break\s*\)", r"\(\s*\d+\s+broken\s+lines?\s*\)"]
    return re.sub("|".join(wider if wide else narrow), "<gap>", t or "", flags=re.I)


def five_places(x):
    """By exact fractions, a tie to the even neighbour."""
    n = Fraction(x) * 10**5
    down = math.floor(n)
    up = n - down > Fraction(1, 2) or n - down == Fraction(1, 2) and down % 2
    digits = str(down + up).rjust(6, "0")
    return (digits[:-5] + "." + digits[-5:]).rstrip("0").rstrip(".")


def snapped(t):
    def number(m):
        x = float(m[0])
        whole = math.floor(x + 1e-12)
        value, written = min(X.SNAPPED_DECIMALS, key=lambda v: abs(x - whole - v[0]))
        return f"{whole}.{written}" if abs(x - whole - value) <= 2e-3 else five_places(x)

    return re.sub(r"(?<![\w/])\d+\.\d{4,}(?![\w/])", number, t or "")


def collapsed(t):
    return re.sub(f"{SPACE}+", " ", t).strip(" ")


def pre(t):
    t = t or ""
    for a, b in (("sz", "š"), ("SZ", "Š"), ("s,", "ṣ"), ("S,", "Ṣ"), ("t,", "ṭ"), ("T,", "Ṭ")):
        t = t.replace(a, b)
    for digits, accented in (("2₂", "áéíúÁÉÍÚ"), ("3₃", "àèìùÀÈÌÙ")):
        for vowel, letter in zip("aeiuAEIU", accented):
            t = re.sub(f"{vowel}[{digits}]", letter, t)
    t = gaps(t, True).translate(str.maketrans("ḫḪ₀₁₂₃₄₅₆₇₈₉—–", "hH0123456789--", "ʾₓ"))
    t = collapsed(snapped(t))
    named = list(dict.fromkeys(v for k, v in X.COMMODITIES.items() if k.upper() in t.upper()))[:4]
    return X.PROMPT_PREFIX + (f"{t} [Commodities: {', '.join(named)}]" if named else t)


def post(t):
    t = re.sub(r"\s*\[Commodities:[^\]]*\]", "", t or "", flags=re.I)
    t = re.sub(r"\bPN\b", "<gap>", gaps(t, True))
    for a, b in X.FRACTION_GLYPHS.items():
        t = t.replace(a, b)
    t = re.sub(r"(?:<gap>\s*){2,}", "<gap>", t).replace("<gap>", "")
    t = "".join(c for c in t if c not in X.FORBIDDEN).replace("", " <gap> ")
    t = re.sub(r"\b(\w+)(?:\s+\1\b)+", r"\1", t)
    return collapsed(re.sub(r"([.,])\1+", r"\1", re.sub(r"\s+([.,:])", r"\1", t)))


def test_texts_against_plain_rules(spark):
    rows = drawn()
    df = spark.createDataFrame(list(enumerate(rows)), "id long, text string")
    out = df.select("id", X.unify_gaps("text").alias("gaps"), X.unify_gaps("text", True).alias("wide"), X.snap_decimals("text").alias("snapped"), X.preprocess("text").alias("pre"), X.postprocess("text").alias("post"), X.or_default(X.postprocess("text"), "broken text").alias("filled"))
    for r in out.collect():
        t = rows[r.id]
        assert (r.gaps, r.wide, r.snapped) == (gaps(t), gaps(t, True), snapped(t)), t
        assert (r.pre, r.post, r.filled) == (pre(t), post(t), post(t) or "broken text"), t


def test_five_places(spark):
    rng = random.Random(2)
    numbers = [f"{rng.randrange(10 ** rng.randint(0, 9))}.{rng.randrange(10**5):05d}5" for _ in range(3000)] + ["0.123455", "2.345675", "12345678.123455", "0.015625", "0.046875", "1.0000005", "0.000015", "8.99999500000001"]
    got = spark.createDataFrame([(n,) for n in numbers], "n string").select("n", X._five_places(F.col("n").cast("double")).alias("v")).collect()
    assert [(r.n, r.v) for r in got] == [(n, f"{float(n):.5f}") for n in numbers]


def test_alignment_payload(spark):
    clues = [(1.0, "a-na"), (2.0, "ša \"q\"\n")]
    df = spark.createDataFrame([("t1", "a-na Ḫa/ti", "to \\ 'x' é", clues), ("t2", None, "", [])], "oare_id string, s string, t string, c array<struct<n: double, w: string>>")
    got = {r.oare_id: json.loads(r.p) for r in df.select("oare_id", J.alignment_payload("oare_id", "s", "t", "c", "Align.", ["Copy.", "Order."]).alias("p")).collect()}
    for i, s, t, c in (("t1", "a-na Ḫa/ti", "to \\ 'x' é", clues), ("t2", "", "", [])):
        assert got[i] == {"instructions": {"task": "Align.", "hard_rules": ["Copy.", "Order."], "output_json_schema": J.ALIGNMENT_REPLY}, "document": {"oare_id": i, "full_transliteration": s, "full_translation": t, "sentence_clues": [{"n": n, "w": w} for n, w in c]}}


def test_rolling_load(spark):
    rng = random.Random(4)
    rows = [(k, "hot" if k % 3 else f"u{k % 5}", rng.randrange(0, 3000), rng.randrange(9)) for k in range(600)]
    df = spark.createDataFrame(rows, "id long, user string, at long, tokens long").withColumn("ts", F.timestamp_seconds("at"))
    got = {r.id: (r.window_requests, r.window_tokens) for r in resume.rolling_load(df, "user", "ts", "tokens", 60).collect()}
    for i, user, at, _ in rows:
        near = [t for _, u, a, t in rows if u == user and at - 60 <= a <= at]
        assert got[i] == (len(near), sum(near))


def test_positions(spark):
    a = spark.createDataFrame([(i,) for i in (5, 3, 9)], "id long").repartition(3)
    b = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "k long, text string").repartition(2)
    assert sorted((r.id, r.text) for r in relational.by_position(a, b, ["id"], ["k"]).collect()) == [(3, "a"), (5, "b"), (9, "c")]
    with pytest.raises(ValueError):
        relational.by_position(a, b.filter("k > 1"), ["id"], ["k"])


@pytest.mark.parametrize("block", [256, 3])
def test_nearest_in_tasks_and_by_join(spark, monkeypatch, block):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 5))) for _ in range(40)]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
    train = spark.createDataFrame([(i, text()) for i in range(60)] + [(100, "same text"), (90, "same text")], "id long, x string")
    test = spark.createDataFrame([(i, text()) for i in range(20)] + [(77, "same text"), (78, "zzzz"), (79, "")], "id long, x string")
    monkeypatch.setattr(select, "QUERY_BLOCK", block)
    one = sorted(map(tuple, select.nearest(train, test).collect()))
    monkeypatch.setattr(select, "QUERY_POSTINGS", 0)
    assert one == sorted(map(tuple, select.nearest(train, test).collect())) and (77, 90, 1.0) in one and not {78, 79} & {r[0] for r in one}


def test_nearest_holds_a_few_queries_at_a_time(spark, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))
    train = [(i, text()) for i in range(90)] + [(3, "two rows of one id"), (None, "no id"), (200, "again"), (150, "again")]
    test = [(i, text()) for i in range(30)] + [(50, "no id"), (51, "again"), (None, "again"), (52, "~~")]

    def bags(rows):
        found = {}
        for i, x in rows:
            for w in x.split():
                found.setdefault(i, Counter()).update(f" {w} "[k : k + n] for n in (3, 4, 5) for k in range(len(w) + 3 - n))
        return found

    have, asked = bags(train), bags(test)
    idf = {g: math.log((1 + len(train)) / (1 + n)) + 1 for g, n in Counter(g for b in have.values() for g in b).items()}
    unit = lambda b: {g: n * idf[g] / math.sqrt(sum((m * idf[h]) ** 2 for h, m in b.items() if h in idf)) for g, n in b.items() if g in idf}
    have, asked = {i: unit(b) for i, b in have.items() if i is not None}, {i: unit(b) for i, b in asked.items() if i is not None}
    want = {}
    for i, b in asked.items():
        near = [(-round(sum(w * c.get(g, 0) for g, w in b.items()), 9), j) for j, c in have.items() if b.keys() & c.keys()]
        if near:
            want[i] = min(near)[::-1]

    held = []
    to_arrow = type(spark.range(0)).toArrow
    monkeypatch.setattr(type(spark.range(0)), "toArrow", lambda df: [held.append(sum(map(len, (t := to_arrow(df)).column("ws").to_pylist()))), t][1])
    for name, value in (("QUERY_BLOCK", 4), ("QUERY_POSTINGS", 300), ("BLOCK_BYTES", 1000)):
        monkeypatch.setattr(select, name, value)
    got = select.nearest(spark.createDataFrame(train, "id long, x string"), spark.createDataFrame(test, "id long, x string"))
    got = {r.test_id: (r.train_id, r.similarity) for r in got.collect()}
    assert {i: j for i, (j, _) in got.items()} == {i: j for i, (j, _) in want.items()} and all(abs(s + want[i][1]) < 2e-9 for i, (_, s) in got.items())
    assert len(held) > 1 and max(held) <= 300
