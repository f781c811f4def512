"""Line deduplication by pairwise alignment (operator 5).

A line is a run between line feeds with at least one word; lines are known by the XXH64 of their bytes. Documents with the
same lines in the same order are a class: its earliest document (smallest doc_id) represents it, and the others lose all
their lines to it. Representatives that overlap are found through shared keys: every document that has a key is paired
with the earliest that does, never all pairs of a group. Keys are the lines, the pairs of neighbouring lines, and the
shortest runs of lines of ``MIN_WORDS`` words from each line on and up to it, so that a block meets the earliest document
that has those runs and not only the earliest ones that have its lines. The longer keys are rare where single lines are
common; no key is too common to count, whatever share of all documents has it.

Each pair is aligned by patience diff: the lines that either document has exactly once are matched in order (the
longest increasing run; of equally long ones the one that patience sorting from the left finds, which takes the lowest
line at each step back), and the stretches between matches are treated in the same way; a stretch without such a line is
aligned by a longest common subsequence; equal lines next to a match join it. The aligned blocks of ``MIN_WORDS`` words or
more leave the later document.

The earlier document of many pairs travels once for every ``PARTNERS`` of them, and is aligned with each in turn.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_docs, materialise, numbered, out_batch, place_of, rows_of, slices, spread
from .substrings import text_digest

MIN_WORDS, PARTNERS = 5, 1000
#: Cells of a table of longest common subsequences that are held at once, in bits; larger ones are split.
TABLE = 1 << 28

LINES = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("sequence", pa.binary()), ("n_words", pa.int64()), ("lines", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64()))])
CUTS = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("spans", pa.list_(pa.int32()))])


def _rows_of_table(a: list[int], b: list[int]) -> list[int]:
    """The table's rows for sequences a and b as bits: a zero at k in row i counts one more up to k than up to k - 1."""
    at: dict[int, int] = {}
    for k, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << k
    mask = (1 << len(b)) - 1
    rows = [mask]
    keep = len(a) * len(b) <= TABLE
    for x in a:
        v = rows[-1]
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & mask
        if keep:
            rows.append(v)
        else:
            rows[-1] = v
    return rows


def _lengths(row: int, n: int) -> np.ndarray:
    """How long the longest common subsequence is up to each of n places."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-n // 8) or 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate(([0], np.cumsum(bits == 0)))


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence as positions, rising."""
    if not a or not b:
        return []
    if len(a) * len(b) > TABLE and len(a) > 1:  # a's halves are aligned with the parts of b that suit them best
        half = len(a) // 2
        before, after = _lengths(_rows_of_table(a[:half], b)[-1], len(b)), _lengths(_rows_of_table(a[half:][::-1], b[::-1])[-1], len(b))
        j = int(np.argmax(before + after[::-1]))
        return _common(a[:half], b[:j]) + [(x + half, y + j) for x, y in _common(a[half:], b[j:])]
    if len(a) == 1:
        return [(0, len(b) - 1 - b[::-1].index(a[0]))] if a[0] in b else []
    rows, out, x, y = _rows_of_table(a, b), [], len(a), len(b)
    while x and y:
        if a[x - 1] == b[y - 1]:
            x, y = x - 1, y - 1
            out.append((x, y))
        elif rows[x] >> y - 1 & 1:  # without b's last line it is as long
            y -= 1
        else:
            x -= 1
    return out[::-1]


def longest_common(a: list[int], b: list[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """A longest common subsequence of a[a0:a1] and b[b0:b1] as positions."""
    in_a, in_b = set(a[a0:a1]), set(b[b0:b1])
    xs, ys = [i for i in range(a0, a1) if a[i] in in_b], [j for j in range(b0, b1) if b[j] in in_a]
    return [(xs[i], ys[j]) for i, j in _common([a[i] for i in xs], [b[j] for j in ys])]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (i, j), both rising, with a[i] == b[j]."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        times_a, times_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {x: j for j, x in enumerate(b[b0:b1], b0) if times_b[x] == 1}
        both = [(i, at[x]) for i, x in enumerate(a[a0:a1], a0) if times_a[x] == 1 and x in at]
        tails, ends, back = [], [], [-1] * len(both)  # the longest rising run of j
        for k, (_, j) in enumerate(both):
            p = bisect_left(tails, j)
            back[k] = ends[p - 1] if p else -1
            tails[p : p + 1], ends[p : p + 1] = [j], [k]
        k, run = ends[-1] if ends else -1, []
        while k >= 0:
            run.append(both[k])
            k = back[k]
        if not run:
            out += longest_common(a, b, a0, a1, b0, b1)
        else:
            run.reverse()
            out += run
            for (i0, j0), (i1, j1) in zip([(a0 - 1, b0 - 1), *run], [*run, (a1, b1)]):
                todo.append((i0 + 1, i1, j0 + 1, j1))
    return sorted(out)


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """First and last position in b of aligned blocks (neighbours in both) that hold at least ``min_words`` words."""
    cut, first, last = [], 0, None
    for i, j in [*patience(a, b), (-9, -9)]:
        if last != (i - 1, j - 1):
            if last and sum(words[first : last[1] + 1]) >= min_words:
                cut.append((first, last[1]))
            first = j
        last = (i, j)
    return cut


def _split(text: bytes) -> list[bytes]:
    return [x for x in text.split(b"\n") if x.strip()]


def keys_of(lines: np.ndarray, words: list[int], min_words: int = MIN_WORDS) -> list[int]:
    """The different lines, pairs of neighbouring lines and shortest runs of ``min_words`` words, each as 64 bits."""
    n, spans = len(words), set()
    upto = [0, *accumulate(words)]
    for i in range(n):
        spans.add((i, min(i + 2, n)))
        if (j := bisect_left(upto, upto[i] + min_words)) <= n:
            spans.add((i, j))
        if upto[i + 1] >= min_words:
            spans.add((bisect_right(upto, upto[i + 1] - min_words) - 1, i + 1))
    raw = lines.tobytes()
    runs = {xxhash.xxh64_intdigest(raw[8 * i : 8 * j], 1) for i, j in spans if j > i + 1}
    return list({*lines.tolist(), *np.fromiter(runs, np.uint64, len(runs)).view(np.int64).tolist()})


def _hash_lines(batches, min_words: int):
    for ids, texts in rows_of(batches, "doc_id", "text"):
        lines = [_split(t) for t in texts]
        hashes = [np.fromiter(map(xxhash.xxh64_intdigest, x), np.uint64, len(x)).view(np.int64) for x in lines]
        words = [[len(w.split()) for w in x] for x in lines]
        yield out_batch(
            LINES, doc_id=ids, digest=list(map(text_digest, texts)), sequence=[xxhash.xxh3_128_digest(h.tobytes()) for h in hashes], n_words=list(map(sum, words)),
            lines=hashes, words=words, keys=[keys_of(h, w, min_words) for h, w in zip(hashes, words)],
        )


def _align(batches, min_words: int):
    """Rows sorted by (first, part, later): a document comes before those that are aligned with it."""
    theirs: list[int] = []
    for later, ids, digests, lines, words in rows_of(batches, "later", "doc_id", "digest", "lines", "words"):
        out = []
        for is_later, i, digest, mine, n in zip(later, ids, digests, lines, words):
            if not is_later:
                theirs = mine
            elif cuts := common_blocks(theirs, mine, n, min_words):
                out.append((i, digest, [x for c in cuts for x in c]))
        if out:
            yield out_batch(CUTS, **dict(zip(CUTS.names, zip(*out))))


def _drop_lines(batches, names: list[str]):
    """The last three columns of a batch are the text, the spans that go, and whether all goes; those before them are passed on."""
    for b in slices(batches):
        out, n_lines, n_cut = [], [], []
        for t, spans, whole in zip(*(b.column(b.num_columns - k).to_pylist() for k in (3, 2, 1))):
            lines, k, left = t.split(b"\n"), -1, []
            gone = {x for a, z in zip((spans or ())[::2], (spans or ())[1::2]) for x in range(a, z + 1)}
            cut = 0
            for x in lines:
                if x.strip():
                    k += 1
                    if whole or k in gone:
                        cut += 1
                        continue
                left.append(x)
            out.append(b"\n".join(left) if cut else t)
            n_lines.append(k + 1)
            n_cut.append(cut)
        columns = [*b.columns[:-3], pa.array(out, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_cut, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def line_cuts(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text), spans (first and last of its lines with words, from 0, in turn; they may overlap), whole
    (all lines go): a row for each document that loses lines."""
    rows = as_docs(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    ddl = "doc_id long, digest long, sequence binary, n_words long, lines array<long>, words array<int>, keys array<long>"
    lines = materialise(rows.mapInArrow(lambda b: _hash_lines(b, min_words), ddl), "lines")
    classes = lines.groupBy("sequence").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).filter("n > 1").select(F.col("sequence").alias("of"), "rep")
    named = lines.select("doc_id", "digest", "sequence", "n_words")
    members = materialise(named.join(classes.hint("merge"), named.sequence == F.col("of")).filter("rep < doc_id").select("doc_id", "digest", "n_words").distinct(), "members")
    reps = lines.join(members.hint("merge"), ["doc_id", "digest"], "left_anti").select("doc_id", "digest", "lines", "words", "keys")
    # of rows that share a doc_id, the one with the least digest stands for them as the earlier document
    again = materialise(reps.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("digest").alias("least")).filter("n > 1").select(F.col("doc_id").alias("again"), "least"), "again")
    if again.isEmpty():
        reps = materialise(reps.withColumn("stands", F.lit(True)), "reps")
    else:
        known = reps.dropDuplicates(["doc_id", "digest"]).join(again, F.col("doc_id") == F.col("again"), "left")
        reps = materialise(known.withColumn("stands", F.coalesce(F.col("digest") == F.col("least"), F.lit(True))).drop("again", "least"), "reps")
    has = reps.select("doc_id", "digest", "stands", F.explode("keys").alias("key"))
    firsts = has.filter("stands").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    firsts = materialise(firsts if not again.isEmpty() else firsts.filter("n > 1"), "firsts").select("key", "first")
    pairs = has.select("doc_id", "digest", "key").join(firsts.hint("merge"), "key").filter("first < doc_id").select("first", "doc_id", "digest").distinct()
    pairs = materialise(pairs, "pairs")
    parts = materialise(pairs.groupBy("first").agg(F.expr(f"cast(ceil(count(*) / {PARTNERS}) as int)").alias("parts")), "parts")
    part = F.expr("pmod(xxhash64(doc_id, digest), parts)").cast("int")
    later = pairs.join(parts.hint("merge"), "first").select("first", part.alias("part"), F.lit(True).alias("later"), "doc_id", "digest")
    later = later.join(reps.select("doc_id", "digest", "lines", "words").hint("merge"), ["doc_id", "digest"]).select("first", "part", "later", "doc_id", "digest", "lines", "words")
    early = reps.filter("stands").join(parts.hint("merge"), F.col("doc_id") == F.col("first"))
    early = early.select("first", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.lit(False).alias("later"), "doc_id", "digest", "lines", F.lit(None).cast("array<int>").alias("words"))
    met = spread(early.unionByName(later), "first", "part").sortWithinPartitions("first", "part", "later")
    cuts = met.mapInArrow(lambda b: _align(b, min_words), "doc_id long, digest long, spans array<int>")
    cuts = cuts.groupBy("doc_id", "digest").agg(F.flatten(F.collect_set("spans")).alias("spans")).withColumn("whole", F.lit(False))
    whole = members.filter(F.col("n_words") >= min_words).select("doc_id", "digest", F.lit(None).cast("array<int>").alias("spans"), F.lit(True).alias("whole"))
    return cuts.unionByName(whole)


def drop_common_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs``, with all its columns, its text without the lines that an earlier document has, and n_lines
    (with words, before) and n_cut. Columns of ``docs`` with those two names are replaced; all others stay, whatever their
    names.

    Decisions are made on the input, not on what is left of earlier documents. Documents that lose every line stay, with
    what blank lines they had. A null text comes back empty. Rows with a null doc_id have no place in the order and stay as
    they are. Rows that share a doc_id are no earlier than each other: each loses what smaller ids have, and of their texts
    the one with the least hash stands for them as the earlier document. Lines that occur twice in a document are one key to
    the search. An empty table gives an empty result.
    """
    docs = docs.drop("n_lines", "n_cut")
    cuts = materialise(line_cuts(docs, min_words, id_col, text_col), "cuts").withColumnsRenamed({"doc_id": "of"})
    rows, text = numbered(docs), F.coalesce(F.col(place_of(docs, text_col)).cast("binary"), F.lit(b""))
    others = [c for c in rows.columns if c != place_of(docs, text_col)]
    same = (F.col(place_of(docs, id_col)).cast("long") == F.col("of")) & (F.xxhash64(text) == F.col("digest"))
    joined = rows.join(cuts.hint("merge"), same, "left").select(*others, text.alias("text"), "spans", "whole")  # cuts grow with the documents: never broadcast
    schema = T.StructType([rows.schema[c] for c in others] + [T.StructField("text", T.BinaryType()), T.StructField("n_lines", T.LongType()), T.StructField("n_cut", T.LongType())])
    names = schema.names
    out = joined.mapInArrow(lambda b: _drop_lines(b, names), schema)
    return out.select(*[F.col("text").cast("string") if c not in others else F.col(c) for c in rows.columns], "n_lines", "n_cut").toDF(*docs.columns, "n_lines", "n_cut")
