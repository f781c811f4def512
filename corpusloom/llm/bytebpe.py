"""Byte-level BPE encoding and decoding from a rank file (operator 3).

Bytes are mapped to the Latin-1 characters of the same number, so that pyahocorasick can find every vocabulary entry
in a pre-token in one pass. Encoding takes the longest entry at a position and keeps it if it is compatible with the
token before it: two adjacent tokens are compatible when merging by rank would never join bytes across their border.
That test depends on the two tokens alone and is memoised. When no entry at a position is compatible, the last token
is taken back and replaced by its next shorter prefix. Positions that failed are marked, so each is tried once and the
work is linear in the bytes. The result is that of applying the merges in order of rank.

A text is split by the vocabulary's pattern; the ids of each distinct pre-token are remembered up to a bound.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import as_docs, out_batch, rows_of

#: Pre-tokens, bytes of pre-tokens, and pairs remembered by each Python worker before it starts afresh; longer pre-tokens than LONG are not.
MEMO, MEMO_BYTES, PAIRS, LONG = 300_000, 16 << 20, 400_000, 256

DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class ByteBPE:
    """Encoder and decoder of a vocabulary given as ranks; every single byte must be an entry."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        size = max(ranks.values()) + 1
        self.bytes: list[bytes | None] = [None] * size
        for t, r in ranks.items():
            self.bytes[r] = t
        self.left, self.right = list(range(size)), list(range(size))  # the two tokens whose merge makes a token; itself for a byte
        self.shorter = [-1] * size  # the longest entry that is a proper prefix
        self.merged: dict[tuple[int, int], int] = {}
        self.finder = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.finder.add_word(t.decode("latin-1"), (len(t), r))
            if len(t) > 1:
                for n in range(len(t) - 1, 0, -1):
                    if (p := ranks.get(t[:n])) is not None:
                        self.shorter[r] = p
                        break
                parts = self._merge(t, r)
                if len(parts) == 2:
                    a, b = ranks[parts[0]], ranks[parts[1]]
                    self.left[r], self.right[r] = a, b
                    self.merged[a, b] = r
        self.finder.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, tuple[bytes, int, bytes]] = {}
        self.memo_bytes = 0

    def _merge(self, text: bytes, below: int) -> list[bytes]:
        """Merge by rank, with ranks lower than ``below`` only."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best[0] >= below:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the border between adjacent tokens a and b standing."""
        key = (a << 32) | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._border_stands(a, b)
        return known

    def _border_stands(self, a: int, b: int) -> bool:
        """Undo the merges next to the border, latest first: a merge across it that is earlier than the merge undone before it would have come first."""
        before = len(self.left)
        while True:
            if self.merged.get((a, b), before) < before:
                return False
            if a > b:
                before, a, whole = a, self.right[a], self.left[a] == a
                if whole:
                    before, b, whole = b + 1, self.left[b], self.left[b] == b
                    if whole:
                        return True
            else:
                before, old = b + 1, b
                b = self.left[b]
                if b == old:
                    before, whole = a, self.left[a] == a
                    a = self.right[a]
                    if whole:
                        return True

    def _encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        for end, (size, r) in self.finder.iter(piece.decode("latin-1")):
            longest[end - size + 1] = r  # ends ascend, so the last is the longest
        open_, tokens, at, token = bytearray(b"\1") * (n + 1), [], 0, longest[0]
        while at < n:
            end = at + len(self.bytes[token])
            if open_[end] and (not tokens or self.compatible(tokens[-1], token)):
                tokens.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                open_[at] = 0
                token = tokens.pop()
                at -= len(self.bytes[token])
        return tokens

    def pieces(self, text: str) -> list[tuple[bytes, int, bytes]]:
        """For each pre-token: its ids in decimal joined by commas, their number, and the bytes that they decode to."""
        memo = self.memo
        found = self.pattern.findall(text)
        try:
            return [memo[p] for p in found]
        except KeyError:
            if len(memo) > MEMO or self.memo_bytes > MEMO_BYTES:
                memo.clear()
                self.memo_bytes = 0
            own = {}
            for p in found:
                if p not in memo and p not in own:
                    ids = self._encode_piece(p.encode())
                    got = (b",".join([b"%d" % i for i in ids]), len(ids), self.decode(ids))
                    if len(p) > LONG:
                        own[p] = got
                    else:
                        memo[p] = got
                        self.memo_bytes += len(p)
            return [own[p] if p in own else memo[p] for p in found]

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pattern.findall(text) for i in self._encode_piece(p.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])


_CODECS: dict[tuple[str, str], ByteBPE] = {}


def codec(path: str, pattern: str) -> ByteBPE:
    """The worker's codec of a rank file."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBPE(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def round_trips(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded again.

    ``ranks`` is the path of a rank file. Null counts as empty: no ids, digests of nothing. Special strings are ordinary
    text. Repeated rows are encoded each on its own; an empty table gives an empty result; other columns are not read.
    """

    def digest_all(batches):
        c = codec(ranks, pattern)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            ns, encoded, decoded = [], [], []
            for t in texts:
                got = c.pieces(t.decode("utf-8", "replace"))
                ns.append(sum([p[1] for p in got]))
                encoded.append(hashlib.sha256(b",".join([p[0] for p in got])).hexdigest())
                decoded.append(hashlib.sha256(b"".join([p[2] for p in got])).hexdigest())
            yield out_batch(DIGESTS, doc_id=ids, n_tokens=ns, ids_sha256=encoded, decoded_sha256=decoded)

    return as_docs(docs, id_col, text_col).mapInArrow(digest_all, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every whole text; a null or empty text has no ids."""

    def encode_all(batches):
        c = codec(ranks, pattern)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([c.encode(t.decode("utf-8", "replace")) for t in texts], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return as_docs(docs, id_col, text_col).mapInArrow(encode_all, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text (bytes) from arrays of ids; a null array decodes to nothing."""

    def decode_all(batches):
        c = codec(ranks, pattern)
        for keys, ids in rows_of(batches, "doc_id", "ids"):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([c.decode(i or []) for i in ids], pa.binary())], names=["doc_id", "text"])

    return encoded.selectExpr(f"cast(`{id_col}` as bigint) AS doc_id", f"`{ids_col}` AS ids").mapInArrow(decode_all, "doc_id long, text binary")
