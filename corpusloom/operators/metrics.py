"""Translation metrics from n-gram counts (SIM-01 to SIM-09, AGG-11, AGG-13).

What the n-grams are made of, characters or words, is worked out as columns; the bags of both sides of a pair are then
counted and compared on Arrow batches, so a pair is one row throughout and nothing is shuffled. ``pairs`` is a frame of
``id``, ``hyp`` and ``ref`` with unique ids.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

PUNCTUATION = r"!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"


#: kind -> (what it is made of: a text or an array of words; n; whether a shorter text is its own only n-gram)
Grams = dict[str, tuple[Callable[[Column], Column], int, bool]]
COUNTS = (T.StructField("kind", T.StringType()), T.StructField("hit", T.LongType()), T.StructField("n_hyp", T.LongType()), T.StructField("n_ref", T.LongType()))


def bag(items: str | list[str], n: int, whole: bool) -> Counter:
    """The n-grams of a text or of a list of words."""
    if whole and 0 < len(items) < n:
        return Counter([items])
    if isinstance(items, str):
        return Counter([items[i : i + n] for i in range(len(items) - n + 1)])
    return Counter(zip(*[items[i:] for i in range(n)]))


def shared(a: Counter, b: Counter) -> int:
    """AGG-11: the size of two bags' intersection."""
    a, b = (a, b) if len(a) < len(b) else (b, a)
    return sum([min(c, b[g]) for g, c in a.items() if g in b])


def parts_of(grams: Grams) -> dict[Callable[[Column], Column], int]:
    """The different things that n-grams are made of, numbered."""
    return {f: k for k, f in enumerate(dict.fromkeys(f for f, _, _ in grams.values()))}


def overlaps(pairs: DataFrame, grams: Grams) -> DataFrame:
    """id, kind, hit, n_hyp, n_ref: for every kind of n-gram the size of the bags' intersection and of the bags."""
    parts = parts_of(grams)
    kinds = [(kind, parts[f], n, whole) for kind, (f, n, whole) in grams.items()]
    rows = pairs.select("id", *[f(F.col(c)).alias(f"{c}{k}") for f, k in parts.items() for c in ("hyp", "ref")])

    def count(batches):
        for b in batches:
            cols = [c.to_pylist() for c in b.columns[1:]]
            out, at = [], []
            for i in range(b.num_rows):
                for kind, k, n, whole in kinds:
                    h, r = bag(cols[2 * k][i], n, whole), bag(cols[2 * k + 1][i], n, whole)
                    out.append((kind, shared(h, r), h.total(), r.total()))
                    at.append(i)
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), *columns], names=["id", "kind", "hit", "n_hyp", "n_ref"])

    return rows.mapInArrow(count, T.StructType([pairs.schema["id"], *COUNTS]))


def _f(p: Column, r: Column, beta: float) -> Column:
    return F.when(p + r > 0, (1 + beta**2) * p * r / F.greatest(beta**2 * p + r, F.lit(1e-300))).otherwise(0.0)


def char_grams(n: int = 6) -> Grams:
    return {"c": (X._text, n, True)}


def word_grams(orders: int = 4) -> Grams:
    return {str(n): (X.words, n, False) for n in range(1, orders + 1)}


def char_f_of(counts: DataFrame, beta: float = 2.0) -> DataFrame:
    score = _f(F.col("hit") / F.greatest("n_hyp", F.lit(1)), F.col("hit") / F.greatest("n_ref", F.lit(1)), beta)
    return counts.select("id", score.alias("char_f"))


def char_f(pairs: DataFrame, n: int = 6, beta: float = 2.0) -> DataFrame:
    """SIM-02: id, char_f. Texts are trimmed and in lower case; a text shorter than n is its own only n-gram; blank: 0."""
    clean = lambda c: F.lower(X.collapse_space_ends(X._text(c)))
    return char_f_of(overlaps(pairs.select("id", clean("hyp").alias("hyp"), clean("ref").alias("ref")), char_grams(n)), beta)


def _wide(counts: DataFrame, kinds: list[str], *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(*[F.sum(F.when(F.col("kind") == k, F.col(c))).alias(f"{c}_{k}") for k in kinds for c in ("hit", "n_hyp", "n_ref")])


def bleu_of(counts: DataFrame, epsilon: float = 0.1) -> DataFrame:
    kinds = [str(n) for n in range(1, 5)]
    w = _wide(counts, kinds, "id")
    logs = [F.log(F.when(F.col(f"hit_{k}") > 0, F.col(f"hit_{k}").cast("double")).otherwise(epsilon) / F.greatest(F.col(f"n_hyp_{k}"), F.lit(1))) for k in kinds]
    brevity = F.when(F.col("n_hyp_1") >= F.col("n_ref_1"), 1.0).otherwise(F.exp(1 - F.col("n_ref_1") / F.greatest(F.col("n_hyp_1"), F.lit(1))))
    return w.select("id", F.when(F.col("hit_1") > 0, brevity * F.exp((logs[0] + logs[1] + logs[2] + logs[3]) / 4)).otherwise(0.0).alias("bleu"))


def sentence_bleu(pairs: DataFrame, epsilon: float = 0.1) -> DataFrame:
    """SIM-03: id, bleu: four orders, an order without hits counts as ``epsilon`` hits, 0 without a common word."""
    rows = pairs.select("id", F.lower(X._text("hyp")).alias("hyp"), F.lower(X._text("ref")).alias("ref"))
    return bleu_of(overlaps(rows, word_grams()), epsilon)


def geo(char_f_col: str, bleu_col: str) -> Column:
    return F.sqrt((F.col(char_f_col) + 1e-6) * (F.col(bleu_col) + 1e-6))


def geo_score(pairs: DataFrame) -> DataFrame:
    """SIM-05: id, char_f, bleu, geo."""
    return char_f(pairs).join(sentence_bleu(pairs), "id").select("id", "char_f", "bleu", geo("char_f", "bleu").alias("geo"))


def split_punctuation(c: Column) -> Column:
    """Words with one mark of punctuation at their end, or else at their start, taken off."""

    def parts(w: Column) -> Column:
        n = F.length(w)
        return (
            F.when(n == 1, F.array(w))
            .when(w.rlike(f"[{PUNCTUATION}]$"), F.array(F.substring(w, F.lit(1), n - 1), F.substring(w, n, F.lit(1))))
            .when(w.rlike(f"^[{PUNCTUATION}]"), F.array(F.substring(w, 1, 1), F.substring(w, F.lit(2), n)))
            .otherwise(F.array(w))
        )

    return F.flatten(F.transform(X.words(c), parts))


def solid(c: Column) -> Column:
    """A text without its white space."""
    return F.regexp_replace(X._text(c), f"{X.SPACE}+", "")


def chrf_grams(chars: int = 6, words: int = 2) -> Grams:
    return {f"c{n}": (solid, n, False) for n in range(1, chars + 1)} | {f"w{n}": (split_punctuation, n, False) for n in range(1, words + 1)}


def _chrf_score(kinds: list[str], beta: float) -> Column:
    used = [(F.col(f"n_hyp_{k}") > 0) & (F.col(f"n_ref_{k}") > 0) for k in kinds]
    orders = sum((F.when(u, 1).otherwise(0) for u in used), F.lit(0))
    mean = lambda side: sum((F.when(u, F.col(f"hit_{k}") / F.greatest(F.col(f"{side}_{k}"), F.lit(1))).otherwise(0.0) for k, u in zip(kinds, used)), F.lit(0.0)) / F.greatest(orders, F.lit(1))
    return 100 * _f(mean("n_hyp"), mean("n_ref"), beta)


def chrf_of(counts: DataFrame, chars: int = 6, words: int = 2, beta: float = 2.0) -> DataFrame:
    kinds = list(chrf_grams(chars, words))
    return _wide(counts, kinds, "id").select("id", _chrf_score(kinds, beta).alias("chrf"))


def chrf(pairs: DataFrame, chars: int = 6, words: int = 2, beta: float = 2.0) -> DataFrame:
    """SIM-06: id, chrf (0 to 100)."""
    return chrf_of(overlaps(pairs, chrf_grams(chars, words)), chars, words, beta)


def corpus_chrf(pairs: DataFrame, chars: int = 6, words: int = 2, beta: float = 2.0) -> DataFrame:
    """SIM-08: one row, from the sums of all pairs' counts."""
    grams = chrf_grams(chars, words)
    w = _wide(overlaps(pairs, grams), list(grams))
    return w.select(_chrf_score(list(grams), beta).alias("chrf"))


def tokenize_13a(c: Column | str) -> Column:
    """The published mteval-13a tokens of a text, case kept."""
    v = X._text(c)
    for a, b in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        v = F.replace(v, F.lit(a), F.lit(b))
    v = F.concat(F.lit(" "), v, F.lit(" "))
    v = F.regexp_replace(v, r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 ")
    v = F.regexp_replace(v, r"([^0-9])([\.,])", "$1 $2 ")
    v = F.regexp_replace(v, r"([\.,])([^0-9])", " $1 $2")
    return X.words(F.regexp_replace(v, r"([0-9])(-)", "$1 $2 "))


def token_grams(orders: int = 4) -> Grams:
    return {str(n): (tokenize_13a, n, False) for n in range(1, orders + 1)}


def _bleu_score(kinds: list[str]) -> Column:
    logs, zeros, empty = F.lit(0.0), F.lit(0), F.lit(False)
    for k in kinds:
        hit, total = F.col(f"hit_{k}"), F.col(f"n_hyp_{k}")
        zeros = zeros + F.when(hit == 0, 1).otherwise(0)
        logs = logs + F.log(F.when(hit > 0, hit / F.greatest(total, F.lit(1))).otherwise(1 / (F.pow(F.lit(2.0), zeros) * F.greatest(total, F.lit(1)))))
        empty = empty | (F.coalesce(total, F.lit(0)) == 0)
    brevity = F.when(F.col("n_hyp_1") >= F.col("n_ref_1"), 1.0).otherwise(F.exp(1 - F.col("n_ref_1") / F.greatest(F.col("n_hyp_1"), F.lit(1))))
    return F.when(empty | (F.col("hit_1") == 0), 0.0).otherwise(100 * brevity * F.exp(logs / len(kinds)))


def corpus_bleu(pairs: DataFrame) -> DataFrame:
    """SIM-07: one row: four orders summed over the corpus; the kth order without hits counts as 1 / 2^k of a hit."""
    grams = token_grams()
    return _wide(overlaps(pairs, grams), list(grams)).select(_bleu_score(list(grams)).alias("bleu"))


def corpus_score(pairs: DataFrame) -> DataFrame:
    """SIM-09: one row: bleu, chrf and their geometric mean, from one pass over the pairs."""
    tokens, chars = token_grams(), chrf_grams()
    w = _wide(overlaps(pairs, tokens | chars), [*tokens, *chars])
    both = w.select(_bleu_score(list(tokens)).alias("bleu"), _chrf_score(list(chars), 2.0).alias("chrf"))
    return both.select("bleu", "chrf", X.geometric_mean("bleu", "chrf").alias("score"))
