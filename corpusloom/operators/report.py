"""Run reports (AGG-03, AGG-04, AGG-05, SNK-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def percent(flag: str):
    """AGG-04: the mean of a 0/1 column in percent, half-even to two places, 0 for no rows."""
    return F.coalesce(F.bround(F.avg(flag) * 100, 2), F.lit(0.0))


def run_summary(pairs: DataFrame) -> DataFrame:
    """One row of counts by split, method and repair."""
    of = lambda c, v: F.count_if(F.col(c) == v)
    return pairs.agg(
        F.count("*").alias("sentence_pairs"), of("split", "train").alias("sentence_pairs_train"), of("split", "valid").alias("sentence_pairs_valid"),
        of("boundary_method", "marker_search").alias("boundary_marker_search"), of("boundary_method", "first_word_obj_fallback").alias("boundary_first_word_obj_fallback"), of("boundary_method", "proportional_fallback").alias("boundary_proportional_fallback"),
        of("source_start_idx_repaired", 1).alias("repaired_starts"), percent("first_word_match").alias("first_word_match_percent"),
    )


def split_counts(df: DataFrame, column: str = "split") -> DataFrame:
    """AGG-10: rows by value, nulls too."""
    return df.groupBy(column).agg(F.count("*").alias("n"))
