"""One training corpus from several sources (ALN-12, SET-02, FLT-06, FLT-07, JOIN-03, JOIN-04)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .relational import first_by, length_window, non_blank


def published_pairs(published: DataFrame) -> DataFrame:
    """Source A."""
    return non_blank(published.select(F.col("transliteration").alias("source"), F.col("AICC_translation").alias("target")), "source", "target")


def marker_pairs(markers: DataFrame, published: DataFrame) -> DataFrame:
    """Source B: a marker's translation with its record's whole transliteration."""
    texts = published.select(F.col("oare_id").alias("text_uuid"), F.col("transliteration").alias("source"))
    return non_blank(markers.select("text_uuid", F.col("translation").alias("target")).join(texts, "text_uuid").select("source", "target"), "source", "target")


def sample_pairs(test: DataFrame, sample: DataFrame) -> DataFrame:
    """Source C, off by default: the sample's answers leak the test."""
    return test.select("id", F.col("transliteration").alias("source")).join(sample.select("id", F.col("translation").alias("target")), "id").select("source", "target").dropna()


def first_word_pairs(markers: DataFrame) -> DataFrame:
    """Source D: first words of more than two characters."""
    return markers.select(F.col("first_word_transcription").alias("source"), F.col("translation").alias("target")).dropna().filter(F.length("source") > 2)


def merge_sources(low: int = 2, high: int = 300, **sources: DataFrame) -> DataFrame:
    """The union, cleaned, within a window of lengths, one row for each source text: of the earliest source named, then
    the first target. ``provenance`` says which."""
    tagged = [df.select("source", "target").withColumn("provenance", F.lit(n)).withColumn("__rank", F.lit(k)) for k, (n, df) in enumerate(sources.items())]
    rows = reduce(DataFrame.unionByName, tagged).withColumn("source", X.collapse_space("source")).withColumn("target", X.collapse_space("target"))
    return first_by(length_window(rows, ["source", "target"], low, high), ["source"], F.asc("__rank"), F.asc("target")).drop("__rank")


def split_frames(pairs: DataFrame, column: str = "split", names: tuple[str, ...] = ("train", "valid")) -> dict[str, DataFrame]:
    """ALN-13, FLT-01: a frame for each split, without the column. Rows of other splits, or of none, are in no frame."""
    return {n: pairs.filter(F.col(column) == n).drop(column) for n in names}
