"""Toxicity scores by a factorisation machine over hashed terms (operator 8).

A text's terms, runs of letters in lower case, are hashed to ``BUCKETS``. The machine scores the set of buckets:
bias + linear weights + the inner products of the factor vectors of all pairs, so that two terms that are harmless apart can
weigh together. Weights are learned from a bounded sample of labelled documents: at most ``TRAIN_ROWS``, the first by
a hash of doc_id; every document is scored.

Learning keeps all buckets that at least ``MIN_DOCS`` sampled documents have and whose presence tells about the label (a
likelihood-ratio statistic over ``TELLING``); others weigh nothing. It minimises log loss with an L2 penalty by full-batch
Adam from a fixed start, so a score is an estimate of the probability of the label, and the same on every run.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_docs, numbered, out_batch, place_of, rows_of, slices

BUCKETS = 1 << 20
FACTORS, MIN_DOCS = 4, 3
#: The likelihood-ratio statistic that one bucket in a hundred passes by chance.
TELLING = 6.63
TRAIN_ROWS = 12_000
CUT = 0.3
#: Terms remembered by each Python worker before it starts afresh; longer terms than LONG are not.
MEMO, LONG = 100_000, 64

TERMS = pa.schema([("doc_id", pa.int64()), ("terms", pa.list_(pa.int32()))])
SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
#: All but ASCII letters and the bytes of other scripts' letters divides terms.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else (b + 32 if 65 <= b <= 90 else 32) for b in range(256))


def terms_of(text: bytes) -> set[bytes]:
    return set(text.translate(_LETTERS).split())


def bucket(term: bytes) -> int:
    return zlib.crc32(term) % BUCKETS


class Machine:
    """Weights of the kept buckets: ``index`` maps a bucket to a row of ``w`` and ``v``."""

    def __init__(self, bias: float, buckets: np.ndarray, w: np.ndarray, v: np.ndarray):
        self.bias, self.buckets, self.w, self.v = bias, buckets, w, v
        self.index = {int(b): i for i, b in enumerate(buckets)}
        self.known: dict[bytes, int] = {}

    def features(self, text: bytes) -> list[int]:
        known = self.known
        if len(known) > MEMO:
            known.clear()
        terms, long = terms_of(text), []
        for t in terms.difference(known):
            if len(t) > LONG:
                long.append(t)
            else:
                known[t] = self.index.get(bucket(t), -1)
        found = set(map(known.__getitem__, terms.difference(long) if long else terms))
        found.update(self.index.get(bucket(t), -1) for t in long)
        found.discard(-1)
        return sorted(found)

    def score(self, text: bytes) -> float:
        f = self.features(text)
        v = self.v[f]
        z = self.bias + self.w[f].sum() + 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def __getstate__(self):
        return self.bias, self.buckets, self.w, self.v

    def __setstate__(self, state):
        self.__init__(*state)


def _telling(counts: np.ndarray, toxic: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """The likelihood-ratio statistic of presence against label, for each bucket."""
    cells = [(toxic, counts * n_toxic / n), (counts - toxic, counts * (n - n_toxic) / n), (n_toxic - toxic, (n - counts) * n_toxic / n), (n - counts - n_toxic + toxic, (n - counts) * (n - n_toxic) / n)]
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * sum(np.where(o > 0, o * np.log(o / e), 0.0) for o, e in cells)


def _sums(values: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows by group; ``of`` is sorted."""
    out = np.zeros((size, *values.shape[1:]), values.dtype)
    if len(of):
        starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        out[of[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


class Design:
    """The ones of a sparse matrix of documents and features, by document."""

    def __init__(self, doc: np.ndarray, feature: np.ndarray, docs: int, features: int):
        self.doc, self.feature, self.docs, self.features = doc, feature, docs, features
        self.by_feature = np.argsort(feature, kind="stable")

    def gradients(self, params: list[np.ndarray], labels: np.ndarray, penalty: float) -> list[np.ndarray]:
        """Of the mean log loss plus half the penalty times the squared weights, by bias, linear weights and factors."""
        (b, w, v), doc, feature, by = params, self.doc, self.feature, self.by_feature
        own = v[feature]
        xv = _sums(own, doc, self.docs)
        z = b[0] + _sums(w[feature], doc, self.docs) + 0.5 * ((xv**2).sum(axis=1) - _sums((own**2).sum(axis=1), doc, self.docs))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / self.docs
        gx = _sums(g[doc][by], feature[by], self.features)
        gv = _sums((g[:, None] * xv)[doc][by], feature[by], self.features)
        return [np.array([g.sum()]), gx + penalty * w, gv - gx[:, None] * v + penalty * v]


def fit(terms: list[np.ndarray], labels: np.ndarray, steps: int = 200, rate: float = 0.05, penalty: float = 1e-4, seed: int = 7) -> Machine:
    """Learn from sets of buckets and labels of 0 and 1. Without both labels the score is the same for all texts."""
    n, n_toxic = len(labels), int(labels.sum())
    prior = (n_toxic + 0.5) / (n + 5)
    empty = Machine(float(np.log(prior / (1 - prior))), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    if not 0 < n_toxic < n:
        return empty
    rows = np.repeat(np.arange(n), [len(t) for t in terms])
    flat = np.concatenate(terms).astype(np.int64)
    counts = np.bincount(flat, minlength=BUCKETS)
    gain = _telling(counts, np.bincount(flat, weights=labels[rows], minlength=BUCKETS), n, n_toxic)
    gain[counts < MIN_DOCS] = 0
    kept = np.flatnonzero(gain > TELLING)
    if not len(kept):
        return empty
    at = np.full(BUCKETS, -1)
    at[kept] = np.arange(len(kept))
    ok = at[flat] >= 0
    design = Design(rows[ok], at[flat[ok]], n, len(kept))
    rng = np.random.default_rng(seed)
    params = [np.array([empty.bias]), np.zeros(len(kept)), rng.normal(0, 0.05, (len(kept), FACTORS))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, steps + 1):
        for p, d, m, s in zip(params, design.gradients(params, labels, penalty), first, second):
            m += 0.1 * (d - m)
            s += 0.001 * (d * d - s)
            p -= rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-8)
    return Machine(float(params[0][0]), kept, params[1], params[2])


def sample_terms(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """toxic, terms (buckets) of at most ``rows`` labelled documents, never of those held out."""
    usable = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = usable.filter(~held_out("of")).orderBy(F.xxhash64("of"), "of").limit(rows)

    def all_terms(batches):
        for ids, texts in rows_of(batches, "doc_id", "text"):
            yield out_batch(TERMS, doc_id=ids, terms=[sorted({bucket(t) for t in terms_of(x)}) for x in texts])

    texts = as_docs(docs, id_col, text_col)
    picked = texts.join(F.broadcast(chosen), texts.doc_id == chosen.of)  # at most `rows` small rows
    ids = picked.select("doc_id", "text").mapInArrow(all_terms, "doc_id long, terms array<int>")
    return ids.join(F.broadcast(chosen), ids.doc_id == chosen.of).select("doc_id", "toxic", "terms")


def held_out(col: str = "doc_id"):
    """Rows that never teach: crc32 of doc_id's digits leaves 2 when divided by 4."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """The sample's buckets come to the driver, at most ``rows`` lists; of rows that repeat a doc_id one teaches."""
    got = sample_terms(docs, labels, rows, id_col, text_col).toArrow().sort_by([("doc_id", "ascending")])
    ids = got.column("doc_id").to_pylist()
    terms, label, seen = [], [], None
    for i, t, y in zip(ids, got.column("terms").to_pylist(), got.column("toxic").to_pylist()):
        if i != seen:
            terms.append(np.array(t, np.int32))
            label.append(y)
        seen = i
    return fit(terms, np.array(label, np.float64))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null and empty texts have no terms and take the bias alone. A null doc_id counts as not held out. Rows that repeat
    are scored each on its own; an empty table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # weights of BUCKETS buckets at most, whatever the input

    def score_all(batches):
        m = shared.value
        for ids, texts in rows_of(batches, "doc_id", "text"):
            yield out_batch(SCORES, doc_id=ids, score=list(map(m.score, texts)))

    scored = as_docs(docs, id_col, text_col).mapInArrow(score_all, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def with_score(docs: DataFrame, machine: Machine, name: str = "score", text_col: str = "text") -> DataFrame:
    """Every row of ``docs``, with all its columns, and its score in a last column ``name``; see score."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = numbered(docs)
    schema = T.StructType([*rows.schema, T.StructField("score", T.DoubleType())])

    def score_all(batches):
        m = shared.value
        for b in slices(batches):
            scores = pa.array([m.score(t) for t in b.column(b.num_columns - 1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], scores], names=schema.names)

    texts = rows.withColumn("score", F.coalesce(F.col(place_of(docs, text_col)).cast("binary"), F.lit(b"")))
    return texts.mapInArrow(score_all, schema).toDF(*docs.columns, name)
