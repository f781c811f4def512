"""Token-id files with keyed access (operator 6).

Documents are dealt out by ranges of doc_id and encoded in order; every range becomes a shard of two files in a folder
that all executors reach:

* ``<shard>.ids``: nothing but ids, little-endian unsigned integers of 16 bits (vocabularies up to 65,536) or 32.
* ``<shard>.mph``: eight unsigned 64-bit numbers (magic, version, bytes an id, documents, buckets, ids, 0, 0), then the
  arrays of a minimal perfect hash (displacements int32, fingerprints uint32) and, by slot, where the document starts
  in the shard and how many ids it has (uint64, uint32).

A document is found by hashing its key to a slot and reading that slot's offset: constant time, and no list of keys.
The key is (doc_id, n) for the nth row of that doc_id, so repeated ids keep all their rows. The manifest, a row for
each shard, says which range of doc_id it holds and how many ids come before it. A shard is written under a name of
its attempt's own, and only the manifest makes it count, so lost or repeated tasks leave at most unused files.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_docs, materialise, new_folder, numbered, out_batch, place_of, rows_of
from .mph import PerfectHash, keys_of
from .wordbpe import encoder

MAGIC, VERSION, HEADER = 0x4D504849, 1, 8
#: Ids in a shard before the next begins, whatever the partition holds.
SHARD_IDS = 1 << 24
NULL_ID = -(1 << 63)
READ_AHEAD = 1 << 22

MANIFEST = pa.schema([("shard", pa.string()), ("first_id", pa.int64()), ("first_nth", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("width", pa.int32())])
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def open_store(folder: str):
    """The file system of a folder's URI, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _write_shard(store, root: str, ids: list[int], nth: list[int], payload: list[bytes], width: int) -> dict:
    name = uuid.uuid4().hex
    sizes = np.array([len(p) // 4 for p in payload], np.int64)
    table, slots = PerfectHash.build(keys_of(np.array(ids, np.int64), np.array(nth, np.int64)))
    offsets, lengths = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint32)
    offsets[slots], lengths[slots] = (np.cumsum(sizes) - sizes).astype(np.uint64), sizes.astype(np.uint32)
    with store.open_output_stream(f"{root}/{name}.ids") as f:
        for p in payload:
            f.write(np.frombuffer(p, "<u4").astype("<u2").tobytes() if width == 2 else p)
    head = np.array([MAGIC, VERSION, width, len(ids), len(table.displacements), int(sizes.sum()), 0, 0], "<u8")
    with store.open_output_stream(f"{root}/{name}.mph") as f:
        for part in (head, table.displacements.astype("<i4"), table.prints.astype("<u4"), offsets.astype("<u8"), lengths.astype("<u4")):
            f.write(part.tobytes())
    return {"shard": name, "first_id": ids[0], "first_nth": nth[0], "docs": len(ids), "ids": int(sizes.sum()), "width": width}


class Shard:
    """Reads one shard."""

    def __init__(self, folder: str, name: str):
        store, root = open_store(folder)
        with store.open_input_stream(f"{root}/{name}.mph") as f:
            raw = f.read()
        head = np.frombuffer(raw, "<u8", HEADER)
        if head[0] != MAGIC or head[1] != VERSION:
            raise ValueError(f"{name}: not an index of version {VERSION}")
        self.width, n, buckets = int(head[2]), int(head[3]), int(head[4])
        parts, at = [], 8 * HEADER
        for kind, count in (("<i4", buckets), ("<u4", n), ("<u8", n), ("<u4", n)):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        self.index, self.offsets, self.lengths = PerfectHash(parts[0], parts[1]), parts[2], parts[3]
        self.file = store.open_input_file(f"{root}/{name}.ids")
        self.at, self.held = 0, b""

    def find(self, doc_ids: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and number of ids of each document; -1 where it is not in the shard."""
        slots = self.index.find(keys_of(doc_ids, nth))
        return np.where(slots < 0, -1, self.offsets[slots].astype(np.int64)), np.where(slots < 0, -1, self.lengths[slots].astype(np.int64))

    def read(self, offset: int, n: int) -> np.ndarray:
        """n ids from an offset; READ_AHEAD bytes are fetched at a time, for readers that go through a shard in order."""
        at, size = offset * self.width, n * self.width
        if not self.at <= at <= at + size <= self.at + len(self.held):
            self.file.seek(at)
            self.at, self.held = at, self.file.read(max(size, READ_AHEAD))
        return np.frombuffer(self.held, f"<u{self.width}", n, at - self.at).astype("<u4")


def _numbered(ids: list[int | None], last: tuple[int | None, int]) -> tuple[list[int], list[int], tuple[int | None, int]]:
    """doc_ids with a number for null, and how many earlier rows of the sorted input had the same."""
    out, nth = [], []
    for i in ids:
        i = NULL_ID if i is None else i
        last = (i, last[1] + 1 if last[0] == i else 0)
        out.append(i)
        nth.append(last[1])
    return out, nth, last


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode the whole texts and write the shards; the manifest with ``before`` (ids in earlier shards).

    Null and empty texts have the end id only. Rows that repeat a doc_id are kept, in the order of their texts; a null
    doc_id comes first. An empty table gives an empty manifest. Other columns are not read. The manifest has a row for
    each shard, and stays a table: the driver sees none of it.
    """

    def write_all(batches):
        e, (store, root) = encoder(tokenizer), open_store(folder)
        store.create_dir(root, recursive=True)
        width = 2 if max(e.vocab_size, end_id + 1) <= 65536 else 4
        end, last, held, size = int(end_id).to_bytes(4, "little"), (None, 0), ([], [], []), 0
        for ids, texts in rows_of(batches, "doc_id", "text"):
            numbers, nth, last = _numbered(ids, last)
            for i, k, raw in zip(numbers, nth, e.encode_many(texts)):
                held[0].append(i), held[1].append(k), held[2].append(raw + end)
                size += len(held[2][-1]) // 4
                if size >= SHARD_IDS:
                    yield pa.RecordBatch.from_pylist([_write_shard(store, root, *held, width)], schema=MANIFEST)
                    held, size = ([], [], []), 0
        if held[0]:
            yield pa.RecordBatch.from_pylist([_write_shard(store, root, *held, width)], schema=MANIFEST)

    rows = as_docs(docs, id_col, text_col)
    sorted_ = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id", "text")
    written = materialise(sorted_.mapInArrow(write_all, "shard string, first_id long, first_nth long, docs long, ids long, width int"), "shards")
    earlier = Window.orderBy("first_id", "first_nth").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return materialise(written.withColumn("before", F.coalesce(F.sum("ids").over(earlier), F.lit(0))), "manifest")


class Manifest:
    """Which shard holds a document, and how many ids come before that shard; read by each task from the manifest's folder."""

    def __init__(self, folder: str):
        from pyarrow import dataset

        store, root = open_store(folder)
        rows = dataset.dataset(root, filesystem=store, format="parquet").to_table(["first_id", "first_nth", "before", "shard"]).sort_by([("first_id", "ascending"), ("first_nth", "ascending")])
        self.first_id, self.first_nth, self.before = (rows.column(k).to_numpy() for k in range(3))
        self.shards = rows.column(3)

    def find(self, ids: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The last shard that does not begin after each document, -1 if all do."""
        at = np.searchsorted(self.first_id, ids, "right") - 1
        for k in np.flatnonzero((at >= 0) & (self.first_id[at] == ids)).tolist():  # shards may begin within the rows of one doc_id
            while at[k] >= 0 and self.first_id[at[k]] == ids[k] and self.first_nth[at[k]] > nth[k]:
                at[k] -= 1
        return at


def read_ids(keys: DataFrame, manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, looked up by key and read from the files.

    ``keys`` must list a doc_id as often as it was written for all its rows to be found; a doc_id that was never
    written gives a row of nulls. A null doc_id is a key like any other.
    """
    table = new_folder(keys.sparkSession, "manifest")
    manifest.write.parquet(table)

    def read_all(batches):
        known, last, opened, of = None, (None, 0), None, None
        for (ids,) in rows_of(batches, "doc_id"):
            known = known or Manifest(table)
            numbers, nth, last = _numbered(ids, last)
            numbers, nth = np.array(numbers, np.int64), np.array(nth, np.int64)
            where = known.find(numbers, nth)
            cuts = [0, *(np.flatnonzero(where[1:] != where[:-1]) + 1).tolist(), len(where)]
            start, size, crc = [], [], []
            for a, b in zip(cuts, cuts[1:]):
                if where[a] < 0:
                    start, size, crc = (x + [None] * (b - a) for x in (start, size, crc))
                    continue
                if of != where[a]:
                    opened, of = Shard(folder, known.shards[where[a]].as_py()), where[a]
                offsets, lengths = opened.find(numbers[a:b], nth[a:b])
                for o, n in zip(offsets.tolist(), lengths.tolist()):
                    start.append(None if n < 0 else int(known.before[of]) + o)
                    size.append(None if n < 0 else n)
                    crc.append(None if n < 0 else zlib.crc32(opened.read(o, n).tobytes()))
            yield out_batch(READ, doc_id=ids, start=start, n_tokens=size, ids_crc32=crc)

    rows = numbered(keys).select(F.col(place_of(keys, id_col)).cast("long").alias("doc_id"))
    dealt = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    return dealt.sortWithinPartitions("doc_id").mapInArrow(read_all, "doc_id long, start long, n_tokens long, ids_crc32 long")


def id_files(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files of ``docs`` and read every document back from them; see write_ids and read_ids."""
    spark: SparkSession = docs.sparkSession
    folder = folder or new_folder(spark, "ids")
    manifest = write_ids(docs, tokenizer, end_id, folder, id_col, text_col)
    return read_ids(docs, manifest, folder, id_col)
