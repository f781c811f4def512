"""Packing documents into sequences by best fit and swap-based local search (operator 4).

Only lengths matter to a packing, and there are at most ``CAPACITY`` of them, so the plan is made from the histogram of
piece lengths. Bins with the same lengths in them form a class with a count. Best fit, by falling length, splits or
fills whole classes at a time and leaves at most about three classes for each length, however many documents there are.

The local search then works on underfull bins: it moves a piece from one to another, exchanges one piece for one, or
two for one, always so that the sum of squared fills grows, which drives the emptier bin towards empty; an empty bin
is gone. It takes the emptiest bins first and stops when no exchange is left, or when there are no more bins than all
lengths together need (the packing is whole at every step). Exchanges also act on as many bins of two classes as both
have. A pair of classes without an exchange is not looked at again, and the classes that a bin has exchanges with are
found from arrays of all pieces and pairs of pieces.

Documents take their places by rank: the plan says which ranks of a length go to which sequences, and a document's
rank within its length is counted in salted groups, so a length that a third of all documents share is no bottleneck.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_docs, materialise, out_batch, rows_of
from .wordbpe import encoder

CAPACITY = 4096

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PLACED = pa.schema([*PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])

Bin = tuple[int, ...]  # lengths, falling


def best_fit(lengths: dict[int, int], capacity: int = CAPACITY) -> Counter[Bin]:
    """Bins by their lengths, from the number of pieces of each length: every piece goes to the fullest bin that takes it."""
    by_room: list[Counter[Bin]] = [Counter() for _ in range(capacity + 1)]
    open_rooms = np.zeros(capacity + 1, bool)

    def put(room: int, b: Bin, n: int) -> None:
        by_room[room][b] += n
        open_rooms[room] = True

    for size in sorted(lengths, reverse=True):
        left = lengths[size]
        while left:
            room = size + int(np.argmax(open_rooms[size:])) if open_rooms[size:].any() else -1
            if room < 0:
                each = capacity // size
                if left >= each:
                    put(capacity - each * size, (size,) * each, left // each)
                if rest := left % each:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            b, n = next(iter(by_room[room].items()))
            each = min(room // size, left)
            # a bin keeps the least room it can have after the first piece, so the next pieces go on into it
            take = min(n, left // each)
            by_room[room][b] -= take
            if not by_room[room][b]:
                del by_room[room][b]
            open_rooms[room] = bool(by_room[room])
            put(room - each * size, (*b, *(size,) * each), take)
            left -= take * each
    out: Counter[Bin] = Counter()
    for c in by_room:
        out.update(c)
    return out


def _pairs(b: Bin) -> list[tuple[int, int]]:
    """The different pairs of pieces in a bin."""
    times = sorted(Counter(b).items(), reverse=True)
    return [(p, q) for i, (p, n) in enumerate(times) for q, _ in times[i + (n < 2) :]]


def _steps(x: Bin, y: Bin, capacity: int):
    """Better pairs of bins than x and y, fill(x) >= fill(y): a step adds d > 0 to x, which grows the squares since x is fuller."""
    room = capacity - sum(x)
    xs, ys = sorted(set(x), reverse=True), sorted(set(y), reverse=True)
    best, step = 0, None
    for b in ys:
        if best < b <= room:
            best, step = b, ((), (b,))
        for a in xs:
            if best < b - a <= room:
                best, step = b - a, ((a,), (b,))
    if best < room:
        for a, c in _pairs(x):
            for b in ys:
                if best < b - a - c <= room:
                    best, step = b - a - c, ((a, c), (b,))
    if best < room:
        for b, c in _pairs(y):
            for a in xs:
                if best < b + c - a <= room:
                    best, step = b + c - a, ((a,), (b, c))
    return step


class _Classes:
    """The classes of underfull bins: how many bins each has, and all their pieces and pairs of pieces in arrays."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.number = capacity, [], {}
        self.fill, self.count, self.waits = np.zeros(64, np.int64), np.zeros(64, np.int64), np.zeros(64, bool)  # waits: may have an exchange with a fuller class
        self.parts = [[np.zeros(64, np.int32), np.zeros(64, np.int64), 0] for _ in range(2)]  # values, whose, how many; pieces, then sums of pairs

    def add(self, b: Bin) -> int:
        k = self.number[b] = len(self.bins)
        self.bins.append(b)
        if k == len(self.fill):
            self.fill, self.count, self.waits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.fill, self.count, self.waits))
        self.fill[k] = sum(b)
        for part, values in zip(self.parts, (sorted(set(b)), sorted({p + q for p, q in _pairs(b)}))):
            end = part[2] + len(values)
            while end > len(part[0]):
                part[0], part[1] = np.concatenate([part[0], np.zeros_like(part[0])]), np.concatenate([part[1], np.zeros_like(part[1])])
            part[0][part[2] : end], part[1][part[2] : end], part[2] = values, k, end
        return k

    def squeeze(self) -> None:
        """Forget classes without bins."""
        rows = [(self.bins[k], self.count[k], self.waits[k]) for k in np.flatnonzero(self.count).tolist()]
        self.__init__(self.capacity)
        for b, n, waits in rows:
            k = self.add(b)
            self.count[k], self.waits[k] = n, waits

    def partners(self, k: int, fuller: bool) -> np.ndarray:
        """Classes with bins that are fuller than class k (or as full) and grow by a step with it, or emptier ones that it grows by."""
        n, b, c = len(self.bins), self.bins[k], self.capacity
        single, double = np.array(sorted({0, *b})), np.array(sorted({p + q for p, q in _pairs(b)}), np.int64)
        at, far = np.arange(2 * c + 1), 4 * c
        found = np.zeros(n, bool)
        if fuller:  # what the other gives up, and how much more it gets from k at least
            up = lambda v: np.append(v, far)[np.searchsorted(v, at, "right")] - at
            one, two = up(single[1:]), up(double)
            gains = (np.minimum(one, two), one)
            room = c - self.fill[:n]
            found |= (room >= one[0]) & (self.fill[:n] >= self.fill[k])
        else:  # what the other gives, and how much less it gets from k at most
            down = lambda v: at - np.append(-far, v)[np.searchsorted(v, at, "left")]
            one = down(single)
            gains = (np.minimum(one, down(double)), down(single[1:]))
            room = np.full(n, c - self.fill[k])
        for (values, whose, m), gain in zip(self.parts, gains):
            found[whose[:m][gain[values[:m]] <= room[whose[:m]]]] = True
        found &= (self.fill[:n] >= self.fill[k] if fuller else self.fill[:n] <= self.fill[k]) & (self.count[:n] > 0)
        found[k] &= self.count[k] > 1
        return np.flatnonzero(found)


def local_search(bins: Counter[Bin], capacity: int = CAPACITY) -> Counter[Bin]:
    """Fewer or equally many bins with the same pieces in them: as few as can be, or no exchange is left."""
    full = Counter({b: n for b, n in bins.items() if sum(b) == capacity})
    under = _Classes(capacity)
    for b, n in bins.items():
        if n and sum(b) < capacity:
            k = under.add(b)  # may make the arrays anew
            under.count[k] = n
    spare = sum(bins.values()) - -(-sum(sum(b) * n for b, n in bins.items()) // capacity)
    under.waits[: len(under.bins)] = True
    todo = [(int(under.fill[k]), k) for k in range(len(under.bins))]
    heapq.heapify(todo)

    def again(k: int) -> None:
        if not under.waits[k]:
            under.waits[k] = True
            heapq.heappush(todo, (int(under.fill[k]), k))

    while todo and spare > 0:
        low = todo[0][1]
        found = under.partners(low, fuller=True) if under.count[low] else ()
        if not len(found):
            heapq.heappop(todo)
            under.waits[low] = False
            continue
        high = int(found[np.argmax(under.fill[found])])
        step = _steps(under.bins[high], under.bins[low], capacity)
        n = int(min(under.count[high], under.count[low]) if high != low else under.count[low] // 2)
        give, take = Counter(step[0]), Counter(step[1])
        new_high = tuple(sorted((Counter(under.bins[high]) - give + take).elements(), reverse=True))
        new_low = tuple(sorted((Counter(under.bins[low]) - take + give).elements(), reverse=True))
        for k in (high, low):
            under.count[k] -= n
        for b in (new_high, new_low):
            if not b:
                spare -= n
            elif sum(b) == capacity:
                full[b] += n
            else:
                k = under.number[b] if b in under.number else under.add(b)
                had, under.count[k] = int(under.count[k]), under.count[k] + n
                if had < 2:  # new pairs: with the others, or of two bins of the class itself
                    again(k)
                    if not had:
                        found = under.partners(k, fuller=False)
                        for other in found[~under.waits[found]].tolist():
                            again(other)
        if len(under.bins) > 256 and 2 * np.count_nonzero(under.count) < len(under.bins):
            under.squeeze()
            todo = [(int(under.fill[k]), k) for k in np.flatnonzero(under.waits).tolist()]
            heapq.heapify(todo)
    full.update({b: n for b, n in zip(under.bins, under.count.tolist()) if n})
    return full


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, pieces a bin, first sequence, offset in the bin), by length and rank: each serves the ranks up to the next row's."""
    packed = local_search(best_fit(lengths, capacity), capacity)
    slots, sequence = defaultdict(list), 0
    for b in sorted(packed):
        offset = 0
        for size, k in sorted(Counter(b).items(), reverse=True):
            slots[size].append((packed[b], k, sequence, offset))
            offset += size * k
        sequence += packed[b]
    rows = []
    for size in sorted(slots):
        rank = 0
        for n, k, first, offset in slots[size]:
            rows.append((size, rank, k, first, offset))
            rank += n * k
    return rows


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids with the end id, cut where they are longer than a sequence."""

    def cut(batches):
        e, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        for ids, texts in rows_of(batches, "doc_id", "text"):
            rows = []
            for i, raw in zip(ids, e.encode_many(texts)):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield out_batch(PIECES, **dict(zip(PIECES.names, zip(*rows))))

    return as_docs(docs, id_col, text_col).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row for each piece of every document.

    Null and empty texts are the end id alone. Rows that repeat a doc_id are packed each on its own; ties between equal
    pieces are broken by doc_id, piece and checksum. An empty table gives an empty result; other columns are not read.
    The driver sees one number for each length and a plan of at most a few rows for each class of bins.
    """
    pieces = materialise(cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = materialise(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    rows = plan({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)  # at most `capacity` rows
    sizes, ranks, ks, firsts, offsets = (np.array(c, np.int64) for c in (zip(*rows) if rows else [()] * 5))
    shared = docs.sparkSession.sparkContext.broadcast((sizes, ranks, ks, firsts, offsets))  # a few rows for each class of bins, see best_fit
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("nth", within - 1).join(before, ["length", "salt"]).select(*PIECES.names, (F.col("before") + F.col("nth")).alias("rank"))

    def place(batches):
        sizes, ranks, ks, firsts, offsets = shared.value
        for b in batches:
            if b.num_rows:
                length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
                lo, hi = np.searchsorted(sizes, length, "left"), np.searchsorted(sizes, length, "right")
                while (open_ := hi - lo > 1).any():  # the last row of the length whose first rank is not above
                    mid = (lo + hi) // 2
                    up = ranks[np.minimum(mid, len(ranks) - 1)] <= rank
                    lo, hi = np.where(open_ & up, mid, lo), np.where(open_ & ~up, mid, hi)
                past = rank - ranks[lo]
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(firsts[lo] + past // ks[lo]), pa.array(offsets[lo] + past % ks[lo] * length)], schema=PLACED)

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
