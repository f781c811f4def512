"""Linking OCR pages to catalogue records through identifiers (ALN-09, ALN-10, JOIN-05, JOIN-06)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .relational import first_by

# The tiers, with where the key was found and what kind it is.
TIERS = (("page_text_cdli", 0.95), ("pdf_name_cdli", 0.70), ("page_text_ref", 0.82), ("pdf_name_ref", 0.76))
TASK = "Extract from page_text the passage that translates this tablet, in English, with a confidence."
RECORD = ("oare_id", "label", "aliases", "publication_catalog", "transliteration")


def only_akkadian(pages: DataFrame, column: str = "has_akkadian") -> DataFrame:
    """FLT-02."""
    return pages.filter(F.lower(X.collapse_space(column)) == "true")


def cdli_lookup(published: DataFrame) -> DataFrame:
    """JOIN-05, build side: a row for each CDLI id of a record."""
    keys = F.transform(X.split_multi_value("cdli_id"), F.upper)
    return published.select(F.explode(F.array_distinct(keys)).alias("key"), *RECORD)


def ref_lookup(published: DataFrame, least: int = 4) -> DataFrame:
    """JOIN-06, FLT-09, build side: a row for each label, alias or catalogue number of ``least`` or more letters and digits."""
    values = F.concat(X.split_multi_value("label"), X.split_multi_value("aliases"), X.split_multi_value("publication_catalog"))
    keys = F.filter(F.transform(values, X.normalize_ref), lambda k: F.length(k) >= least)
    return published.select(F.explode(F.array_distinct(keys)).alias("key"), *RECORD)


def page_matches(pages: DataFrame, published: DataFrame, akkadian_only: bool = True, ascii_words: bool = False) -> DataFrame:
    """ALN-09: a row for each page, record and tier (and id, for the CDLI tiers).

    Keys are extracted once for each page and exploded without its text; one equi-join finds CDLI ids and another
    references; the text joins again for the pages that matched. What is broadcast is left to the planner, by size. ``ascii_words``: see
    ``text.cdli_ids``.
    """
    pages = (only_akkadian(pages) if akkadian_only else pages).withColumn("digest", F.xxhash64("page_text"))
    keyed = pages.select("pdf_name", "page", "has_akkadian", "digest", X.cdli_ids("page_text", ascii_words).alias("page_text_cdli"), X.cdli_ids("pdf_name", ascii_words).alias("pdf_name_cdli"), X.publication_refs("page_text", ascii_words).alias("page_text_ref"), X.publication_refs("pdf_name", ascii_words).alias("pdf_name_ref"))

    def tier(kind: str) -> DataFrame:
        tagged = lambda c: F.transform(c, lambda k: F.struct(k.alias("key"), F.lit(c).alias("match_source")))
        named = [tagged(c) for c, _ in TIERS if c.endswith(kind)]
        return keyed.select("pdf_name", "page", "has_akkadian", "digest", F.explode(F.concat(*named)).alias("k")).select("pdf_name", "page", "has_akkadian", "digest", "k.*")

    found = tier("_cdli").join(cdli_lookup(published), "key").withColumn("matched_cdli", F.col("key")).unionByName(tier("_ref").join(ref_lookup(published), "key").withColumn("matched_cdli", F.lit("")))
    confidence = reduce(lambda c, t: c.when(F.col("match_source") == t[0], t[1]), TIERS[1:], F.when(F.col("match_source") == TIERS[0][0], TIERS[0][1]))
    one = first_by(found.withColumn("match_confidence", confidence), ["pdf_name", "page", "oare_id", "matched_cdli", "match_source"], F.col("key"), F.col("label"), F.col("digest"))
    texts = pages.select(*[F.col(c).alias(f"of_{c}") for c in ("pdf_name", "page", "digest")], "page_text").dropDuplicates(["of_pdf_name", "of_page", "of_digest"])
    on = [one[c].eqNullSafe(texts[f"of_{c}"]) for c in ("pdf_name", "page", "digest")]
    return one.join(texts, on).select("pdf_name", "page", "has_akkadian", "matched_cdli", "match_source", "match_confidence", *RECORD, X.snippet("page_text", "key").alias("page_text_snippet"), X.collapse_space("page_text").alias("page_text"))


def shortlist(matches: DataFrame, least: float = 0.80, task: str | Column = TASK) -> DataFrame:
    """ALN-10, FLT-04, PRJ-03: the best candidate for each page and record, if it is good enough."""
    best = first_by(matches, ["pdf_name", "page", "oare_id"], F.desc("match_confidence"), F.asc("match_source"), F.asc("matched_cdli"))
    return best.filter(F.col("match_confidence") >= least).withColumn("llm_task", F.lit(task)).withColumn("llm_ready", F.lit(1))


def extraction_summary(matches: DataFrame, short: DataFrame) -> DataFrame:
    """SNK-05, AGG-05, AGG-06: one row of counts."""
    a = matches.agg(F.count("*").alias("n_matches"), F.count_if(F.col("match_confidence") >= 0.9).alias("n_high_confidence"))
    b = short.agg(F.count("*").alias("n_shortlist"), F.count_distinct("oare_id").alias("n_tablets"), F.count_distinct("pdf_name").alias("n_pdfs"))
    return a.select("*", b.select(F.struct("*")).scalar().alias("b")).select("n_matches", "n_high_confidence", "b.*")
