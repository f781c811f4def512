"""Substring deduplication by repeated-phrase automata (operator 10).

A window is ``WINDOW`` consecutive words of one document; a word goes if a window over it also starts in a document
with a smaller doc_id. Work on all windows would shuffle a row a word, so windows are narrowed down by phrases:

1. *Recurring phrases.* A window's phrase is the ``PHRASE``-word run in it with the least hash. Windows with the same words
   have the same phrase, and neighbouring windows mostly share one, so a document has about one phrase for 20 words.
   Counting documents by phrase hash finds the phrases that more than one document may have. They go to the tasks as a
   Bloom filter of a fixed size (``FILTER_BITS``): what is broadcast does not grow with the data. A false hit costs work, not results.
2. *Passages.* Every document is streamed; each run of windows whose phrase is in the filter is a passage, and its words go
   to the shard that its phrase hashes to.
3. *Automata.* A shard confirms, word for word, which of its phrases more than one document has, compiles those into an
   Aho-Corasick automaton over word numbers, and streams all its passages through it. The automaton's hits are the
   occurrences: only windows with a hit of their phrase are compared, by all their words, in order of doc_id.
4. Documents drop the words that spans of repeated windows cover.

Phrases in more than ``HOT_ROWS`` documents are *hot*, which tasks know from a second filter. Their passages are not dealt
out by phrase. Equal ones form a class, known by 128 bits: the passages of all but its first document go whole. For one of
each class, the task that has it compiles the automaton of its phrases, and the windows that it locates become rows of
128-bit digests, whose first documents are found with map-side combining and handed back by a join that adaptive execution
can split. So a passage that a third of all documents share is no single task's work, and a cold phrase that the filter
takes for hot has the same result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_docs, materialise, numbered, place_of, rows_of, slices, spread

WINDOW, PHRASE = 50, 10
SPAN = WINDOW - PHRASE + 1  # phrases in a window
FILTER_BITS = 1 << 27
HOT_ROWS = 2_000
#: Words of the passages for which one automaton is compiled, and windows of a text that are looked at together.
SHARD_WORDS, SLAB = 400_000, 1 << 18
#: Bytes of passages in one batch of rows.
BATCH = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

PHRASES = pa.schema([("phrase", pa.int64()), ("doc_id", pa.int64())])
FOUND = pa.schema([("phrase", pa.int64()), ("hot", pa.bool_()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("at", pa.int32()), ("place", pa.int32()), ("n_words", pa.int32()), ("passage", pa.binary())])
WINDOWS = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("at", pa.int32())])
SPANS = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
FOUND_DDL = "phrase long, hot boolean, doc_id long, digest long, at int, place int, n_words int, passage binary"


def _powers(base: np.uint64) -> np.ndarray:
    return np.cumprod(np.full(SLAB + WINDOW, base, np.uint64))


_POWERS, _INVERSES = _powers(_BASE), _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)))


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words: a polynomial in the words' hashes, then mixed."""
    n = len(hashes)
    sums = np.cumsum(hashes * _POWERS[:n])
    x = sums[size - 1 :].copy()
    x[1:] -= sums[: n - size]
    x *= _INVERSES[: n - size + 1]
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours."""
    have = 1
    while have * 2 <= size:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (size - have)], x[size - have :]) if size > have else x


def _slabs(words: list[bytes]) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """A text's windows, some at a time: where they start, their words, the hashes of the phrases there, and each window's least."""
    for a in range(0, len(words) - WINDOW + 1, SLAB):
        part = words[a : a + SLAB + WINDOW - 1]
        grams = _grams(np.fromiter(map(xxhash.xxh3_64_intdigest, part), np.uint64, len(part)), PHRASE)
        yield a, part, grams, _least(grams, SPAN)


def _phrases(batches):
    for ids, texts in rows_of(batches, "doc_id", "text"):
        found, of = [], []
        for i, t in zip(ids, texts):
            own = [least[np.concatenate(([True], least[1:] != least[:-1]))] for _, _, _, least in _slabs(t.split())]
            if own:
                found.append(np.unique(np.concatenate(own)))
                of.append(np.full(len(found[-1]), i, np.int64))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(of))], schema=PHRASES)


def _bits(phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (phrases % np.uint64(FILTER_BITS)).astype(np.int64), ((phrases >> np.uint64(32)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter_of(recurring: DataFrame) -> np.ndarray:
    """The Bloom filter of ``recurring(phrase)``, two bits a phrase, as 64-bit words: at most FILTER_BITS / 64 rows come to the driver."""

    def words(batches):
        for b in batches:
            for bits in _bits(b.column(0).to_numpy().view(np.uint64)):
                at, inverse = np.unique(bits >> 6, return_inverse=True)
                value = np.zeros(len(at), np.uint64)
                np.bitwise_or.at(value, inverse, np.uint64(1) << (bits & 63).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(value.view(np.int64))], names=["at", "value"])

    got = recurring.select("phrase").mapInArrow(words, "at long, value long").groupBy("at").agg(F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[got.column("at").to_numpy()] = got.column("value").to_numpy().view(np.uint64)
    return out


def _in_filter(bloom: np.ndarray, phrases: np.ndarray) -> np.ndarray:
    a, b = _bits(phrases)
    one = np.uint64(1)
    return ((bloom[a >> 6] >> (a & 63).astype(np.uint64)) & (bloom[b >> 6] >> (b & 63).astype(np.uint64)) & one).astype(bool)


def text_digest(text: bytes) -> int:
    """As Spark's xxhash64: tells rows with one doc_id and different texts apart."""
    d = xxhash.xxh64_intdigest(text, 42)
    return d - (1 << 64) if d >> 63 else d


def _passages(batches, bloom: np.ndarray, hot_bloom: np.ndarray | None):
    """Every document's runs of windows with one phrase that may recur, with the words of all those windows."""

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FOUND)], schema=FOUND)

    rows, size = [], 0
    for ids, texts in rows_of(batches, "doc_id", "text"):
        for i, t in zip(ids, texts):
            digest = None
            for start, words, grams, least in _slabs(t.split()):
                cuts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]))
                phrases = least[cuts[:-1]]
                for k in np.flatnonzero(_in_filter(bloom, phrases)).tolist():
                    a, b, phrase = int(cuts[k]), int(cuts[k + 1]), phrases[k]
                    hot = hot_bloom is not None and bool(_in_filter(hot_bloom, phrases[k : k + 1])[0])
                    digest = text_digest(t) if digest is None else digest
                    for c in range(a, b, WINDOW):
                        e = min(b, c + WINDOW)
                        passage = b" ".join(words[c : e + WINDOW - 1])
                        rows.append((int(phrase.view(np.int64)), hot, i, digest, start + c, int(np.argmax(grams[c : e + SPAN - 1] == phrase)), e - c + WINDOW - 1, passage))
                        size += len(passage)
                        if size >= BATCH:
                            yield batch(rows)
                            rows, size = [], 0
    if rows:
        yield batch(rows)


#: doc_id, digest, at, place in the passage where its phrase begins, and the passage's words.
Passage = tuple[int, int, int, int, list[bytes]]


class Shard:
    """Passages by phrase, and the automaton of the confirmed phrases among them."""

    def __init__(self):
        self.size, self.groups = 0, defaultdict(list)

    def add(self, phrase: int, i: int, digest: int, at: int, place: int, passage: bytes) -> None:
        words = passage.split(b" ")
        self.groups[phrase].append((i, digest, at, place, words))
        self.size += len(words)

    def occurrences(self, confirmed: bool) -> Iterator[list[tuple[Passage, list[int]]]]:
        """For each phrase its passages that the automaton finds it in, with the windows over a hit. Phrases have to be in passages of two documents, unless ``confirmed``."""
        numbers: dict[bytes, int] = {}
        machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for g, rows in enumerate(self.groups.values(), 1):
            holders: dict[tuple[bytes, ...], int] = {}
            for i, _, _, place, words in rows:
                phrase = tuple(words[place : place + PHRASE])
                if confirmed or holders.setdefault(phrase, i) != i:
                    machine.add_word(tuple([numbers.setdefault(w, len(numbers) + 1) for w in phrase]), g)
        if not numbers:
            return
        machine.make_automaton()
        for g, rows in enumerate(self.groups.values(), 1):
            found = []
            for row in rows:
                words = row[4]
                n, windows, done = len(words) - WINDOW + 1, [], 0
                for end, of in machine.iter(tuple([numbers.get(w, 0) for w in words])):
                    if of == g:
                        at = end - PHRASE + 1
                        windows += range(max(done, at - SPAN + 1), min(at + 1, n))
                        done = max(done, min(at + 1, n))
                if windows:
                    found.append((row, windows))
            if found:
                yield found


def _window_texts(words: list[bytes], windows: list[int]) -> Iterator[bytes]:
    joined = b" ".join(words)
    starts = list(accumulate([len(w) + 1 for w in words], initial=0))
    return (joined[starts[k] : starts[k + WINDOW] - 1] for k in windows)


def _repeated(found: list[tuple[Passage, list[int]]]) -> Iterator[tuple[int, int, int, int]]:
    """Spans of windows that an earlier document has; the passages of a phrase come in order of doc_id."""
    seen: dict[bytes, int] = {}
    for (i, digest, at, _, words), windows in found:
        first = None
        last = None
        for k, text in zip(windows, _window_texts(words, windows)):
            if seen.setdefault(text, i) < i:
                if last != k - 1 or first is None:
                    if first is not None:
                        yield i, digest, at + first, at + last + WINDOW
                    first = k
                last = k
        if first is not None:
            yield i, digest, at + first, at + last + WINDOW


def _confirm(batches):
    """Rows sorted by (phrase, doc_id, at) to the spans that go."""

    def flush(shard):
        spans = [s for found in shard.occurrences(False) for s in _repeated(found)]
        if spans:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*spans), SPANS)], schema=SPANS)

    shard, last = Shard(), None
    for rows in rows_of(batches, "phrase", "doc_id", "digest", "at", "place", "passage"):
        for row in zip(*rows):
            if row[0] != last and shard.size >= SHARD_WORDS:
                yield from flush(shard)
                shard = Shard()
            last = row[0]
            shard.add(*row)
    yield from flush(shard)


def _hot_windows(batches):
    """A row for each window that the automaton of the hot phrases locates."""

    def flush(shard):
        out = [(xxhash.xxh3_128_digest(text), i, digest, at + k) for found in shard.occurrences(True) for (i, digest, at, _, words), windows in found for k, text in zip(windows, _window_texts(words, windows))]
        for a in range(0, len(out), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[a : a + 100_000]), WINDOWS)], schema=WINDOWS)

    shard = Shard()
    for rows in rows_of(batches, "phrase", "doc_id", "digest", "at", "place", "passage"):
        for row in zip(*rows):
            shard.add(*row)
            if shard.size >= SHARD_WORDS:
                yield from flush(shard)
                shard = Shard()
    yield from flush(shard)


def _hot_spans(found: DataFrame) -> DataFrame:
    """Equal passages are a class: all but those of its first document go whole, and only the first one's windows are compared with other classes'."""
    known = found.withColumn("copy", F.unhex(F.md5("passage")))
    classes = known.groupBy("copy").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).filter("first_doc < last_doc")
    classes = materialise(classes.select("copy", "first_doc"), "classes").hint("merge")
    later = known.select("copy", "doc_id", "digest", "at", "n_words").join(classes, "copy").filter("doc_id > first_doc")
    whole = later.select("doc_id", "digest", F.col("at").alias("first"), (F.col("at") + F.col("n_words")).alias("last"))
    reps = known.join(classes, "copy", "left").filter("first_doc IS NULL OR doc_id = first_doc").select("phrase", "doc_id", "digest", "at", "place", "passage")
    windows = materialise(reps.mapInArrow(_hot_windows, "key binary, doc_id long, digest long, at int"), "windows")
    first = windows.groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).filter("first_doc < last_doc")
    first = materialise(first, "first")  # so that both sides of the join are plain shuffles, which can be split where a window is hot
    again = windows.join(first.hint("merge"), "key").filter("doc_id > first_doc")
    return whole.unionByName(again.select("doc_id", "digest", F.col("at").alias("first"), (F.col("at") + WINDOW).alias("last")))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text), first, last: spans of words (from 0, last not included) that windows of earlier documents cover; they may overlap."""
    spark = docs.sparkSession
    rows = as_docs(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    counted = rows.mapInArrow(_phrases, "phrase long, doc_id long").groupBy("phrase").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    recurring = materialise(counted.filter("least < most").select("phrase", "n"), "phrases")
    hot = recurring.filter(F.col("n") > HOT_ROWS)
    some_hot = not hot.isEmpty()
    shared = spark.sparkContext.broadcast((_filter_of(recurring), _filter_of(hot) if some_hot else None))
    found = rows.mapInArrow(lambda b: _passages(b, *shared.value), FOUND_DDL)
    found = materialise(found, "passages") if some_hot else found
    met = spread(found.filter("NOT hot").drop("hot"), "phrase").sortWithinPartitions("phrase", "doc_id", "at")
    spans = met.mapInArrow(_confirm, "doc_id long, digest long, first int, last int")
    return spans.unionByName(_hot_spans(found.filter("hot").drop("hot"))) if some_hot else spans


def _kept_words(text: bytes, spans) -> tuple[int, int, bytes]:
    words = text.split()
    if not spans:
        return len(words), 0, b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for first, last in zip(spans[::2], spans[1::2]):
        gone[first] += 1
        gone[last] -= 1
    keep = (np.cumsum(gone)[:-1] == 0).tolist()
    left = [w for w, k in zip(words, keep) if k]
    return len(words), len(words) - len(left), b" ".join(left)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs``, with all its columns, its text as the kept words joined by one space, and n_words (before)
    and n_removed. Columns of ``docs`` with those two names are replaced; all others stay, whatever their names.

    Null and empty texts have no words. Documents of fewer than 50 words have no window and lose nothing. Windows are judged
    on the input. Rows with a null doc_id are in no order and lose nothing; rows that share a doc_id are one document to
    the order: neither is earlier than the other, and each loses what windows of smaller ids cover in its own text. An empty table gives
    an empty result.
    """
    docs = docs.drop("n_words", "n_removed")
    spans = repeated_spans(docs, id_col, text_col)
    lists = spans.groupBy(F.col("doc_id").alias("of"), "digest").agg(F.flatten(F.collect_list(F.array("first", "last"))).alias("spans"))
    return _without(docs, materialise(lists, "spans"), id_col, text_col)


def _without(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows, text = numbered(docs), F.coalesce(F.col(place_of(docs, text_col)).cast("binary"), F.lit(b""))
    same = (F.col(place_of(docs, id_col)).cast("long") == F.col("of")) & (F.xxhash64(text) == F.col("digest"))
    others = [c for c in rows.columns if c != place_of(docs, text_col)]
    joined = rows.join(spans.hint("merge"), same, "left").select(*others, text.alias("text"), "spans")  # spans grow with the documents: never broadcast
    schema = T.StructType([rows.schema[c] for c in others] + [T.StructField("text", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = schema.names

    def drop(batches):
        for b in slices(batches):
            n, removed, kept = zip(*map(_kept_words, b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(kept, pa.binary()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())], names=names)

    out = joined.mapInArrow(drop, schema)
    return out.select(*[F.col("text").cast("string") if c not in others else F.col(c) for c in rows.columns], "n_words", "n_removed").toDF(*docs.columns, "n_words", "n_removed")
