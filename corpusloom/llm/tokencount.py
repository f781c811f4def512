"""Token counts without ids (operator 9).

A document is reduced to its pre-tokens: a run of blanks with the run of other characters after it. No piece of the
vocabulary holds a blank after another character, so merges never cross a pre-token's border and counts add up.

Documents are read in blocks of some megabytes. A block numbers its distinct pre-tokens as they come and keeps, for each
document, numbers and frequencies. Its pre-tokens are dealt out by their hash: each part has one row, with all of the
block's pre-tokens of that part packed together. A part meets the same part of all blocks in one task, which has the library
count each distinct pre-token once and answers every block with their piece counts. Block and answers are
joined by block, frequencies multiply piece counts, and the products are summed. No ids are kept, no text is shuffled, and a
pre-token of very many documents is one entry a block.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_docs, materialise, rows_of, spread

LIMIT = 4096
#: Bytes of documents in a block: the larger, the fewer blocks share a pre-token.
BLOCK = 24 << 20

#: Of a block: a part of its pre-tokens, or of their piece counts, packed; the documents are part -1.
BLOCKS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])
DDL = "block long, part int, data binary"
COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_RUNS = re.compile(rb" +[^ ]*")


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any(" " in p or "▁" in p.lstrip("▁") for p in map(self.model.id_to_piece, range(self.model.get_piece_size()))):
            raise ValueError(f"{path} has pieces that cross a blank")
        if self.model.encode("a") != self.model.encode(" a")[1:] and self.model.encode("a b") != self.model.encode("a") + self.model.encode("b"):
            raise ValueError(f"{path} does not put a blank before a text")

    def pieces(self, pretokens: list[bytes]) -> list[int]:
        """How many pieces each has, without the one blank that the library puts before a text; of a lone blank, which is empty here, the library gives nothing."""
        texts = [t.decode("utf-8", "replace") for t in pretokens]
        return [n if t else 1 for t, n in zip(texts, map(len, self.model.encode(texts, num_threads=1)))]


def pretokens(text: bytes) -> list[bytes]:
    """A text's pre-tokens in order, each without its first blank."""
    if not text:
        return []
    if b"\xe2\x96\x81" in text:  # the library's mark for a blank
        text = text.replace(b"\xe2\x96\x81", b" ")
    if b"  " in text or text[0] == 32:
        return [w[1:] for w in _RUNS.findall(b" " + text)]
    return text.split(b" ")


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays of 32-bit or 64-bit integers, and bytes, compressed; numbers are stored a byte's place at a time."""
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    kinds = [0 if isinstance(a, bytes) else a.itemsize for a in arrays]
    raw = np.array([len(parts), *kinds, *map(len, parts)], "<i8").tobytes() + b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray | bytes]:
    raw = pa.Codec("zstd").decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8).tolist(), 8 * (2 * n + 1), []
    for kind, size in zip(head[:n], head[n:]):
        part = raw[at : at + size]
        out.append(np.frombuffer(part, np.uint8).reshape(kind, -1).T.copy().view(f"<i{kind}").ravel() if kind else part)
        at += size
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _blocks(batches, parts: int) -> Iterator[pa.RecordBatch]:
    """Each slice of documents is a block under a random number; no two share one but by a chance of 1 in 2^63 for a pair."""
    for ids, texts in rows_of(batches, "doc_id", "text", most=BLOCK):
        number: dict[bytes, int] = {}
        numbers, freqs, counts = [], [], []
        for t in texts:
            times = Counter(pretokens(t))
            own = np.array([number.setdefault(w, len(number)) for w in times], np.int32)
            by = np.argsort(own)  # rising numbers lie close together
            numbers.append(own[by])
            freqs.append(np.fromiter(times.values(), np.int32, len(times))[by])
            counts.append(len(times))
        words, size = list(number), np.fromiter(map(len, number), np.int32, len(number))
        of = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(parts)
        order = np.argsort(of, kind="stable").astype(np.int32)  # rising numbers within a part
        ends = np.searchsorted(of[order], np.arange(parts + 1, dtype=np.uint64))
        block, rows = uuid.uuid4().int >> 65, []
        for p in range(parts):
            own = order[ends[p] : ends[p + 1]]
            if len(own):
                rows.append((block, p, pack(size[own], b"".join([words[k] for k in own.tolist()]))))
        known = np.array([i is not None for i in ids], np.int32)
        docs = (np.array([i or 0 for i in ids], np.int64), known, np.fromiter(map(len, texts), np.int64, len(texts)), np.array(counts, np.int32))
        rows.append((block, -1, pack(of.astype(np.int32), *docs, _steps(np.concatenate(numbers)), np.concatenate(freqs))))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOCKS)], schema=BLOCKS)


def _count_parts(batches, model: str):
    """The blocks' parts of pre-tokens to the same parts of piece counts. The pre-tokens of a part are held here, so that each is counted once."""
    c, pieces, held = counter(model), {}, None
    for rows in rows_of(batches, "block", "part", "data"):
        out = []
        for block, part, data in zip(*rows):
            if part != held:  # rows are sorted by part
                pieces, held = {}, part
            size, blob = unpack(data)
            ends = np.cumsum(size).tolist()
            words = [blob[a:b] for a, b in zip([0, *ends], ends)]
            new = [w for w in words if w not in pieces]
            pieces.update(zip(new, c.pieces(new)))
            out.append((block, part, pack(np.array([pieces[w] for w in words], np.int32))))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), BLOCKS)], schema=BLOCKS)


def _sum(batches):
    """Rows sorted by block and falling part: a block's documents come after its piece counts."""
    held: dict[int, np.ndarray] = {}
    for _, part, data in (row for rows in rows_of(batches, "block", "part", "data") for row in zip(*rows)):
        got = unpack(data)
        if part >= 0:
            held[part] = got[0]
            continue
        of, ids, known, n_bytes, counts, steps, freqs = got  # ``of``: the part of each pre-token
        pieces = np.zeros(len(of), np.int64)
        pieces[np.argsort(of, kind="stable")] = np.concatenate([np.zeros(0, np.int32), *(held[p] for p in sorted(held))])
        held = {}
        sums = np.concatenate(([0], np.cumsum(pieces[np.cumsum(steps)] * freqs)))
        ends = np.cumsum(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids, mask=known == 0), pa.array(n_bytes), pa.array(sums[ends] - sums[ends - counts])], schema=COUNTS)


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    ``model`` is the path of a sentencepiece model whose pieces do not cross blanks (checked). Null and empty texts have
    0 bytes and 0 tokens. Repeated rows are counted each on its own; other columns are not read; an empty table gives an
    empty result. Texts are counted whole, whatever their length.
    """

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = materialise(as_docs(docs, id_col, text_col).mapInArrow(lambda b: _blocks(b, parts), DDL), "blocks")
    counted = spread(blocks.filter("part >= 0"), "part").sortWithinPartitions("part").mapInArrow(lambda b: _count_parts(b, model), DDL)
    met = spread(counted.unionByName(blocks.filter("part < 0")), "block").sortWithinPartitions("block", F.desc("part"))
    return met.mapInArrow(_sum, "doc_id long, n_bytes long, n_tokens long").selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {limit} AS over_limit")
