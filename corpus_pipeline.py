"""A corpus pipeline over ``documents``: five stages, each on what the one before it kept.

1. toxicity: documents scored toxic go.
2. line dedup: common blocks of lines leave the later document.
3. SimHash near-dedup: one document of each group stays, the one that the group is named after.
4. substring dedup: repeated 50-word windows leave the later document.
5. best-fit packing: the texts' ids in sequences of 4096.

Stages 1 to 4 return the columns of ``documents``, with ``n_chars`` as the new text has it; other columns are dropped,
whatever their names. A null text counts as empty: it is scored as one, comes out of stage 2 empty, and in stage 3 all
empty texts are one group, of which one row stays. Rows that repeat a doc_id share its fate in stage 3 and are packed
each on its own. Rows with a null doc_id lose no lines or passages; in a group they go unless all of it has null ids.
Empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import lines, packing, simhash, substrings, toxicity
from corpusloom.llm.common import load, materialise, new_folder, numbered, place_of
from corpusloom.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _only(docs: DataFrame) -> DataFrame:
    """The columns of documents, found by their exact names."""
    return numbered(docs).select(*[F.col(place_of(docs, c)).alias(c) for c in COLUMNS])


def _as_documents(df: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew."""
    return df.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _only(docs)
    machine = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, machine, "score").filter(F.col("score") < toxicity.CUT).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(lines.drop_common_lines(_only(docs)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose doc_id names their group; a group without any doc_id keeps its rows."""
    docs = _only(docs)
    groups = materialise(simhash.near_groups(docs), "near")
    gone = groups.filter("component_id IS NOT NULL AND NOT doc_id <=> component_id").select("doc_id").distinct()
    return docs.join(gone.hint("merge"), docs.doc_id.eqNullSafe(gone.doc_id), "left_anti").select(*COLUMNS)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(substrings.drop_repeats(_only(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("simhash near-dedup", drop_near_copies), ("substring dedup", drop_passages), ("best-fit packing", pack)]

#: SQL cannot say what the classifier and the tokenizer do; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    path = new_folder(spark, STAGES[-1][0].replace(" ", "-"))
    STAGES[-1][1](spark, docs, sf_dir).write.parquet(path)
    return spark.read.parquet(path)
