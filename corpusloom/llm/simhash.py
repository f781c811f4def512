"""SimHash near-duplicates by anchor-point covering (operator 2).

Fingerprints of 64 bits link when at most ``THRESHOLD`` bits differ. The bits are cut into blocks whose own
thresholds sum to ``THRESHOLD - blocks + 1``: two linked fingerprints must agree within the threshold of at least
one block, since otherwise each block would add its threshold plus one and the sum would pass ``THRESHOLD``.

Within a block the anchors are the words of a covering code. Every fingerprint has a home, the anchor within the
code's covering radius R, and is replicated to every anchor within R plus the block's threshold t; by the triangle
inequality a linked pair meets at the home of either one. Homes are compared with what their anchor received.
The code of a block is a product of perfect Hamming codes (R = 1 each) and single bits (R = 0).

Copies share a fingerprint, so only distinct fingerprints travel. An anchor's links leave it as a forest (one link
for each fingerprint that joins a group), never as all pairs; anchors with very many homes are split into chunks,
each of which gets all the anchor's replicas, so no task holds more than ``CHUNK`` homes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_docs, materialise, out_batch, rows_of, spread
from .components import connected_components

THRESHOLD = 4
SHINGLE = 4
CHUNK = 4096

#: (threshold, segments): a segment of 2^r - 1 bits holds a Hamming code, one written as 0 is a single bit. 22 + 22 + 20 bits, 31 anchors.
Blocks = tuple[tuple[int, tuple[int, ...]], ...]
BLOCKS: Blocks = ((1, (15,) + (0,) * 7), (1, (15,) + (0,) * 7), (0, (15,) + (0,) * 5))
#: 31 + 33 bits, 203 anchors, some hundredth of the comparisons.
WIDE_BLOCKS: Blocks = ((1, (31,)), (2, (31, 0, 0)))
#: Distinct fingerprints from which on comparisons cost more than replicas, so that the wide blocks serve. Both plans give the same links.
WIDE_FROM = 1 << 27

PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
MEETINGS = pa.schema([("anchor", pa.int64()), ("visitor", pa.int8()), ("fp", pa.int64()), ("rep", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes) -> int:
    """The SimHash of a text, unsigned; 0 if it has no words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    if n < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[: n - SHINGLE] + 1)).tolist()
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], 42) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())])
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 8)  # big-endian digests: the first byte holds the highest bits
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(batches):
    for ids, texts in rows_of(batches, "doc_id", "text"):
        fps = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
        yield out_batch(PRINTS, doc_id=ids, fp=fps.view(np.int64))


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for every row."""
    return as_docs(docs, id_col, text_col).mapInArrow(_fingerprints, "doc_id long, fp long")


def _hamming_syndrome(x: np.ndarray, bits: int) -> np.ndarray:
    """XOR of the 1-based positions of the set bits: 0 for a code word, else the position to flip."""
    s = np.zeros_like(x)
    for i in range(bits):
        s ^= ((x >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return s


def _anchors_of_segment(x: np.ndarray, bits: int, excess: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(e, rows, anchors): the segment's anchors that lie R + e from x, for e up to excess; home (within R) is e = 0."""
    one, rows = np.uint64(1), np.arange(len(x))
    if not bits:
        return [(0, rows, x)] + ([(1, rows, x ^ one)] if excess else [])
    s = _hamming_syndrome(x, bits)
    home = np.where(s > 0, x ^ (one << (np.maximum(s, one) - one)), x)
    found = [(0, rows, home)]
    if excess > 2:
        raise ValueError("a block's threshold is 2 at most")
    flip = lambda *places: np.bitwise_or.reduce([one << (np.asarray(p, np.uint64) - one) for p in places])
    if excess:  # code words at distance 2 = R + 1: flip positions i < j with i ^ j = s; a code word has none, as its next ones are 3 away
        for i in range(1, bits + 1):
            j = s ^ np.uint64(i)
            ok = np.flatnonzero((s > 0) & (j > np.uint64(i)) & (j <= np.uint64(bits)))
            found.append((1, ok, x[ok] ^ (flip(i) | flip(j[ok]))))
    if excess > 1:  # and at distance 3 = R + 2: i < j < k with i ^ j ^ k = s
        for i in range(1, bits + 1):
            for j in range(i + 1, bits + 1):
                k = s ^ np.uint64(i ^ j)
                ok = np.flatnonzero((k > np.uint64(j)) & (k <= np.uint64(bits)))
                found.append((2, ok, x[ok] ^ (flip(i) | flip(j) | flip(k[ok]))))
    return found


def meetings(fps: np.ndarray, blocks: Blocks = BLOCKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor keys, visitor flags (0: this is the fingerprint's home) and row numbers: where each fingerprint goes."""
    keys, visits, rows = [], [], []
    low = 0
    for b, (t, segments) in enumerate(blocks):
        part = [(0, np.arange(len(fps)), np.zeros(len(fps), np.uint64))]  # (excess so far, rows, anchor bits)
        at = 0
        for seg in segments:
            width = seg or 1
            x = (fps >> np.uint64(low + at)) & np.uint64((1 << width) - 1)
            options = _anchors_of_segment(x, seg, t)
            nxt: dict[int, list] = {}
            for e0, r0, a0 in part:
                for e1, r1, a1 in options:
                    if e0 + e1 <= t:
                        if len(r1) == len(fps):
                            r, a = r0, a0 | (a1[r0] << np.uint64(at))
                        else:
                            pos = np.full(len(fps), -1)
                            pos[r1] = np.arange(len(r1))
                            got = pos[r0]
                            r, a = r0[got >= 0], a0[got >= 0] | (a1[got[got >= 0]] << np.uint64(at))
                        if len(r):
                            nxt.setdefault(e0 + e1, []).append((r, a))
            part = [(e, np.concatenate([r for r, _ in v]), np.concatenate([a for _, a in v])) for e, v in nxt.items()]
            at += width
        for e, r, a in part:
            keys.append((np.uint64(b) << np.uint64(56)) | a)
            visits.append(np.full(len(r), int(e > 0), np.int8))
            rows.append(r)
        low += at
    return np.concatenate(keys).view(np.int64), np.concatenate(visits), np.concatenate(rows)


def _homes(batches, blocks: Blocks):
    """The anchors that are homes, one for each fingerprint and block."""
    alone = tuple((0, segments) for _, segments in blocks)
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(meetings(b.column(0).to_numpy().view(np.uint64), alone)[0])], names=["anchor"])


def _meet(batches, blocks: Blocks):
    for b in batches:
        fps, reps = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
        for at in range(0, len(fps), 20_000):
            key, visit, row = meetings(fps[at : at + 20_000], blocks)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(visit), pa.array(fps[at:][row].view(np.int64)), pa.array(reps[at:][row])], schema=MEETINGS)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same groups as the given ones, one for each node but a group's least."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _compare(home_key, home_fp, home_rep, key, fp, rep, pairs: int = 1 << 21):
    """Compare members with the homes of their anchor (both sorted by key), and yield a forest of the links found."""
    lo, hi = np.searchsorted(home_key, key, "left"), np.searchsorted(home_key, key, "right")
    counts = hi - lo
    some = np.flatnonzero(counts)
    at = 0
    while at < len(some):
        upto = np.cumsum(counts[some[at : at + pairs]])
        n = max(1, int(np.searchsorted(upto, pairs, "right")))
        rows = some[at : at + n]
        at += n
        c = counts[rows]
        right = np.repeat(rows, c)
        left = np.arange(len(right)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(lo[rows], c)
        near = (np.bitwise_count(home_fp[left] ^ fp[right]) <= THRESHOLD) & (home_rep[left] != rep[right])
        if near.any():
            a, b = _forest(home_rep[left[near]], rep[right[near]])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=LINKS)


def _compare_sorted(batches):
    """Rows sorted by (anchor, chunk, visitor): homes of a group come before its visitors. The homes of the group that a batch ends in are carried on."""
    kept, mark = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)), None
    for b in batches:
        if not b.num_rows:
            continue
        key, chunk, visitor, fp, rep = (b.column(i).to_numpy() for i in range(5))
        fp = fp.view(np.uint64)
        new = np.concatenate(([False], (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])))
        group = np.cumsum(new)
        if len(kept[0]) and (key[0], chunk[0]) == mark:
            ids = np.zeros(len(kept[0]), np.int64)
            hk, hf, hr = (np.concatenate(p) for p in ((ids, group[visitor == 0]), (kept[1], fp[visitor == 0]), (kept[2], rep[visitor == 0])))
        else:
            hk, hf, hr = group[visitor == 0], fp[visitor == 0], rep[visitor == 0]
        yield from _compare(hk, hf, hr, group, fp, rep)
        last = hk == group[-1]
        kept, mark = (hk[last], hf[last], hr[last]), (key[-1], chunk[-1])


def near_links(prints: DataFrame, chunk: int = CHUNK, blocks: Blocks = BLOCKS) -> DataFrame:
    """a, b: links between ``rep`` numbers of ``prints(fp long, rep long)``, distinct by fp, that join all fingerprints within THRESHOLD bits."""
    met = prints.select("fp", "rep").mapInArrow(lambda b: _meet(b, blocks), "anchor long, visitor byte, fp long, rep long")
    homes = prints.select("fp").mapInArrow(lambda b: _homes(b, blocks), "anchor long").groupBy("anchor").agg(F.count("*").alias("homes")).filter(F.col("homes") > chunk)
    hot = materialise(homes.selectExpr("anchor AS hot_anchor", f"cast(ceil(homes / {chunk}) as int) AS chunks"), "hot")
    if hot.isEmpty():
        dealt = met.select("anchor", F.lit(0).alias("chunk"), "visitor", "fp", "rep")
    else:  # homes go to one chunk, and also visit the anchor's other chunks, as all visitors do
        dealt = met.join(hot, met.anchor == hot.hot_anchor, "left").selectExpr("anchor", "explode(sequence(0, coalesce(chunks, 1) - 1)) AS chunk", "chunks", "visitor", "fp", "rep")
        dealt = dealt.selectExpr("anchor", "chunk", "cast(CASE WHEN visitor = 0 AND (chunks IS NULL OR pmod(xxhash64(fp), chunks) = chunk) THEN 0 ELSE 1 END as tinyint) AS visitor", "fp", "rep")
    return spread(dealt, "anchor", "chunk").sortWithinPartitions("anchor", "chunk", "visitor").mapInArrow(_compare_sorted, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: Blocks | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the smallest doc_id reachable over links) for every row.

    Null and empty texts have fingerprint zero and link like any other. Copies and repeated rows share their fingerprint
    and so their component; a null doc_id is never a component's name unless the component has no other. An empty table
    gives an empty result. Columns other than the two named are not read. Without ``blocks`` the plan goes by the number
    of distinct fingerprints; the result is the same.
    """
    rows = materialise(simhash(docs, id_col, text_col), "prints")
    prints = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("rep", F.monotonically_increasing_id()), "distinct")
    if blocks is None:
        blocks = WIDE_BLOCKS if prints.count() >= WIDE_FROM else BLOCKS
    links = connected_components(near_links(prints, blocks=blocks))
    grouped = prints.join(links, prints.rep == links.node, "left").select("fp", "least", F.coalesce("root", "rep").alias("root"))
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "root").select(F.col("fp").alias("of_fp"), "component_id")
    out = rows.join(named, rows.fp == named.of_fp, "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
