"""Exact deduplication by distributed MSD radix partitioning (operator 7).

Texts are split by their successive bytes, most significant first. A digit is a run of bytes: 64 in the first round,
eight times as many in each later one, so that a text of n bytes is done after about log8(n / 64) rounds. A round
counts the documents of every (group, digit); a document alone in its group is done, and so is a group whose texts
end with the digit: they are equal, byte for byte, without a digest. Only the rest goes on, with what is left of its
text. The first round's counts read 64 bytes a text.

Counting combines on the map side, so a group of copies of any size reaches a reducer as one row for each task. The
join that hands the counts back is one that adaptive execution can split where a group is hot.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_docs, materialise, out_batch, rows_of

FIRST, GROWTH = 64, 8

HEADS = pa.schema([("doc_id", pa.int64()), ("digit", pa.binary()), ("ended", pa.bool_())])
TEXTS = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("digit", pa.binary()), ("ended", pa.bool_()), ("rest", pa.binary())])


def _heads(batches):
    for ids, heads, sizes in rows_of(batches, "doc_id", "head", "size"):
        yield out_batch(HEADS, doc_id=ids, digit=[h.lower() for h in heads], ended=[n <= FIRST for n in sizes])


def _texts(batches):
    for ids, texts in rows_of(batches, "doc_id", "text"):
        texts = [t.lower() for t in texts]
        yield out_batch(TEXTS, doc_id=ids, sha=[hashlib.sha256(t).digest() for t in texts], digit=[t[:FIRST] for t in texts], ended=[len(t) <= FIRST for t in texts], rest=[t[FIRST:] for t in texts])


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """Groups of two or more: their keys, size, largest doc_id and a number of their own."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.max("doc_id").alias("keep")).filter("n > 1")
    return materialise(found.withColumn("gid", F.monotonically_increasing_id()).withColumnsRenamed({k: f"g_{k}" for k in keys}), "groups")


def _judged(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Rows with their new group; ``rest`` stays only where the group goes on."""
    on = [rows[k] == groups[f"g_{k}"] for k in keys]
    joined = rows.join(groups.hint("merge"), on, "left")  # as many groups as copies in the data: never broadcast
    go_on = F.col("n").isNotNull() & ~F.col("ended")
    return materialise(joined.select("doc_id", "sha", groups.gid.alias("gid"), "n", "keep", F.when(go_on, F.col("rest")).alias("rest")), "round")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as empty. Of equal texts the largest doc_id
    stays. A group whose doc_ids are all null has no keep_id and keeps its rows; other null ids are dropped. Rows that
    repeat both doc_id and text share a verdict. An empty table gives an empty result; other columns are not read.
    """
    base = as_docs(docs, id_col, text_col)
    heads = base.selectExpr("doc_id", f"substring(text, 1, {FIRST}) AS head", "octet_length(text) AS size")
    groups = _shared(heads.mapInArrow(_heads, "doc_id long, digit binary, ended boolean"), "digit", "ended")
    rows = base.mapInArrow(_texts, "doc_id long, sha binary, digit binary, ended boolean, rest binary")
    judged, width = _judged(rows, groups, "digit", "ended"), FIRST
    done = [judged.filter("rest IS NULL")]
    while True:
        going = judged.filter("rest IS NOT NULL")
        if going.isEmpty():
            break
        width *= GROWTH
        rows = going.selectExpr("doc_id", "sha", "gid AS of", f"substring(rest, 1, {width}) AS digit", f"octet_length(rest) <= {width} AS ended", f"substring(rest, {width + 1}) AS rest")
        judged = _judged(rows, _shared(rows, "of", "digit", "ended"), "of", "digit", "ended")
        done.append(judged.filter("rest IS NULL"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.coalesce(F.col("doc_id") == keep, keep.isNull()).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
