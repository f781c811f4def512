"""Quality rules with adaptive thresholds (operator 1).

One pass measures every document. A second, tiny, step sketches the distribution of each ratio per language and source and
turns its quantiles into fences; documents beyond a fence of their own group are not kept.

The quantile sketch is a log-linear histogram: exact below 64, 32 buckets for each power of two above, so a quantile is
within 1/32 of its true value. Sketches merge by adding counts, whatever the order, so results are the same on every run.

A fence lies a multiple of the distance between the median and a tail quantile beyond that quantile, so both its place and
its width come from the group. No fence has a floor of its own: where most documents of a group have no symbols at all,
its fence is there. A group's quantiles are drawn towards those of its language, and a language's towards those of all
documents, as if ``PRIOR`` documents of the parent were among its own: a small group leans on its parent, a large one on
itself, and no size is treated differently from the next.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, as_docs, materialise, out_batch, rows_of

SYMBOLS = b"#*$%&|<>"

#: metric -> (the tail quantile, in thousandths; its distances from the median that the fence lies beyond it; whether there is a lower fence too)
FENCES: dict[str, tuple[int, int, bool]] = {
    "symbols": (850, 2, False),  # symbols for 10,000 words
    "dup_lines": (980, 1, False),  # repeated lines in 10,000 lines
    "repeats": (950, 3, False),  # words in repeated windows in 10,000 words
    "word_len": (850, 3, True),  # thousandths of characters a word
}
#: Documents of the parent that count beside a group's own.
PRIOR = 50

STATS = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string())] + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")])


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word, repeated lines, words in repeated 3-word windows."""
    words = text.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0
    word_bytes = text.translate(None, WHITE)
    chars = len(word_bytes) if word_bytes.isascii() else len(word_bytes.decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, end = Counter(windows), 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return n, chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated


def _measure_all(batches):
    for ids, texts, langs, sources in rows_of(batches, "doc_id", "text", "lang", "source"):
        m = list(zip(*map(measure, texts)))
        yield out_batch(STATS, doc_id=ids, lang=langs, source=sources, n_words=m[0], word_chars=m[1], n_symbols=m[2], n_lines=m[3], n_dup_lines=m[4], n_repeat_words=m[5])


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """A row of measures for each document; a null or empty text measures zero throughout."""
    base = as_docs(docs, id_col, text_col, (lang_col, source_col)).toDF("doc_id", "text", "lang", "source")
    return base.mapInArrow(_measure_all, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")


def bucket_of(v: str) -> str:
    """SQL for the sketch's bucket of a value of 0 or more."""
    e = f"(length(bin({v})) - 1)"
    return f"CASE WHEN {v} < 64 THEN {v} ELSE 64 + ({e} - 6) * 32 + shiftright({v}, {e} - 5) - 32 END"


def bucket_floor(b: str) -> str:
    """SQL for the smallest value of a bucket."""
    return f"CASE WHEN {b} < 64 THEN {b} ELSE shiftleft(32L + ({b} - 64) % 32, cast(({b} - 64) div 32 + 1 as int)) END"


RATIOS = {
    "symbols": "n_symbols * 10000 div greatest(n_words, 1)",
    "dup_lines": "n_dup_lines * 10000 div greatest(n_lines, 1)",
    "repeats": "n_repeat_words * 10000 div greatest(n_words, 1)",
    "word_len": "word_chars * 1000 div greatest(n_words, 1)",
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def sketches(stats: DataFrame) -> DataFrame:
    """lang, source, metric, bucket, cnt: the mergeable sketches, over documents that pass the base rules."""
    long = stats.filter(f"NOT ({BASE_FAILED})").selectExpr("lang", "source", "stack(4, " + ", ".join(f"'{m}', cast({e} as bigint)" for m, e in RATIOS.items()) + ") AS (metric, value)")
    return long.selectExpr("lang", "source", "metric", f"cast({bucket_of('value')} as bigint) AS bucket").groupBy("lang", "source", "metric", "bucket").agg(F.count("*").alias("cnt"))


def quantiles(sk: DataFrame, level: list[str]) -> DataFrame:
    """n and the quantiles lo, mid and hi (bucket floors) of each metric, of the sketches merged to a level."""
    keys = [*level, "metric"]
    tail = "CASE metric " + " ".join(f"WHEN '{m}' THEN {f[0]}" for m, f in FENCES.items()) + " END"
    merged = sk.groupBy(*keys, "bucket").agg(F.sum("cnt").alias("cnt"))
    by = Window.partitionBy(*keys)
    ranked = merged.select(*keys, F.expr(bucket_floor("bucket")).alias("floor"), F.sum("cnt").over(by.orderBy("bucket")).alias("upto"), F.sum("cnt").over(by).alias("n"), F.expr(tail).alias("tail"))
    at = lambda share: F.expr(f"min(CASE WHEN upto * 1000 >= n * ({share}) THEN floor END)")
    return ranked.groupBy(*keys).agg(F.max("n").alias("n"), at("1000 - tail").alias("lo"), at("500").alias("mid"), at("tail").alias("hi"))


def thresholds(stats: DataFrame, prior: int = PRIOR) -> DataFrame:
    """lang, source and, for each metric, its fences: a row for each language and source among the documents."""
    sk = materialise(sketches(stats), "sketch")

    def wide(q: DataFrame, keys: list[str], tag: str) -> DataFrame:
        cols = [F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{tag}_{m}_{c}") for m in FENCES for c in ("lo", "mid", "hi", "n")]
        return q.groupBy(*[F.col(k).alias(f"{tag}_{k}") for k in keys]).agg(*cols)

    own, by_lang, whole = wide(quantiles(sk, ["lang", "source"]), ["lang", "source"], "o"), wide(quantiles(sk, ["lang"]), ["lang"], "l"), wide(quantiles(sk, []), [], "a")
    out = stats.select("lang", "source").distinct()
    out = out.join(own, F.col("lang").eqNullSafe(F.col("o_lang")) & F.col("source").eqNullSafe(F.col("o_source")), "left")
    out = out.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
    out = out.withColumn("a", whole.select(F.struct("*")).scalar()).select("*", "a.*")  # one row, as a scalar subquery

    def drawn(tag: str, m: str, c: str, parent: str) -> str:
        own = f"coalesce({tag}_{m}_n, 0L)"
        return f"(({own} * coalesce({tag}_{m}_{c}, 0L) + {prior}L * ({parent})) div ({own} + {prior}L))"

    cols = []
    for m, (_, times, two_sided) in FENCES.items():
        lo, mid, hi = (drawn("o", m, c, drawn("l", m, c, f"a_{m}_{c}")) for c in ("lo", "mid", "hi"))
        cols.append(F.expr(f"{hi} + {times} * ({hi} - {mid})").alias(f"max_{m}"))
        if two_sided:
            cols.append(F.expr(f"{lo} - {times} * ({mid} - {lo})").alias(f"min_{m}"))
    return out.select("lang", "source", *cols)


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", prior: int = PRIOR) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row of ``docs``.

    Null or empty texts have no words, so they fail the base rules. A null language or source is a group of its own.
    Repeated rows are judged alike, each with a row of its own. An empty table gives an empty result. Columns other
    than the four named are not read, whatever their names. Results are the same on every run.
    """
    stats = materialise(text_stats(docs, id_col, text_col, lang_col, source_col), "stats")
    fences = thresholds(stats, prior).withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    joined = stats.join(fences, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    within = " AND ".join([f"({RATIOS[m]}) <= max_{m}" for m in FENCES] + [f"({RATIOS[m]}) >= min_{m}" for m, f in FENCES.items() if f[2]])
    return joined.selectExpr("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", f"({BASE_FAILED}) AS base_failed", f"NOT ({BASE_FAILED}) AND coalesce({within}, true) AS kept")
