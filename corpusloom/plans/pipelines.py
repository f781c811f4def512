"""The three programs as plans, with their options (CLI-01 to CLI-04)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsons as J
from ..functions import text as X
from ..operators import align, link, report, responses
from ..operators.relational import input_key, without_done
from ..sources import tables


@dataclass(frozen=True)
class PairOptions:
    valid_ratio: float = 0.1
    salt: str = "deep_past_split_v1"  # fixed value: other salts split other documents off
    strict_empty: bool = False


@dataclass(frozen=True)
class LinkOptions:
    akkadian_only: bool = True
    min_confidence: float = 0.80
    ascii_words: bool = False


@dataclass(frozen=True)
class AlignOptions:
    max_docs: int = 0
    max_doc_chars: int = 12_000
    second_pass: bool = True
    resume: bool = True
    shuffle_seed: int | None = None
    overlap: float = 0.95
    retries: int = 3
    retry_seconds: float = 2.0
    requests_per_minute: int = 0
    tokens_per_minute: int = 0
    callers: int = 1


@dataclass(frozen=True)
class ReplyOptions:
    requests_per_minute: int = 40
    tokens_per_minute: int = 200_000
    max_rows: int = 0
    retries: int = 3
    min_confidence: float = 0.80
    min_target_chars: int = 0
    resume: bool = True
    callers: int = 1


def build_pairs(train: DataFrame, markers: DataFrame, options: PairOptions = PairOptions()) -> dict[str, DataFrame]:
    """From documents and markers to pairs, coverage, what is missing, what can be trained on, and a summary."""
    canonical = align.canonical_pairs(train, options.valid_ratio, options.salt)
    pairs = align.sentence_pairs(canonical, markers, options.strict_empty)
    return {"canonical": canonical, "pairs": pairs, "coverage": align.coverage(canonical, markers, pairs), "unmatched": align.unmatched(canonical, markers, pairs), "ready": align.training_ready(pairs), "summary": report.run_summary(pairs)}


def link_pages(pages: DataFrame, published: DataFrame, options: LinkOptions = LinkOptions()) -> dict[str, DataFrame]:
    matches = link.page_matches(pages, published, options.akkadian_only, options.ascii_words)
    short = link.shortlist(matches, options.min_confidence)
    return {"matches": matches, "shortlist": short, "summary": link.extraction_summary(matches, short)}


def next_documents(docs: DataFrame, done: DataFrame, options: AlignOptions = AlignOptions(), key: str = "oare_id") -> DataFrame:
    """LIM-01, SRT-04, JOIN-07: what to send next: completed documents go first, then the limit counts. The order is by id,
    or by a seeded hash of it."""
    todo = without_done(docs, done, key) if options.resume else docs
    order = F.col(key) if options.shuffle_seed is None else F.xxhash64(F.lit(options.shuffle_seed), F.col(key))
    return todo.orderBy(order, key).limit(options.max_docs) if options.max_docs > 0 else todo


ALIGN_TASK = "Pair the sentences of the transliteration with those of the translation, in order."
AGAIN_TASK = "Pair what the first round left over. Do not repeat pairs that it found."
ALIGN_RULES = ["Copy both sides exactly as they stand.", "Use every part of the text at most once.", "Reply with one JSON object and nothing else."]

Client = Callable[[str], str]


def _asked(prompts: DataFrame, client: Client, options: AlignOptions | ReplyOptions, wait: Callable[[int], float], path: str) -> DataFrame:
    """The log of this run's calls, appended to an audit log; written once, so that no prompt is sent again when rows are read."""
    log = responses.call_model(responses.check_budget(prompts, options.tokens_per_minute // options.callers), client, options.retries, wait, requests_per_minute=options.requests_per_minute, tokens_per_minute=options.tokens_per_minute, callers=options.callers)
    own = tables.scratch(prompts.sparkSession, "calls")
    log.write.parquet(own)
    log = prompts.sparkSession.read.parquet(own)
    tables.append_jsonl(log, path)
    return log


def align_documents(train: DataFrame, markers: DataFrame, client: Client, out: str, options: AlignOptions = AlignOptions(), done: DataFrame | None = None) -> dict[str, DataFrame]:
    """CLI-03: documents that have markers, as many as the options say, to a model that pairs their sentences; its replies
    to verdicts, pairs, issues, leftovers and a status for each document. ``done``: oare_id of documents that an earlier run
    completed. Texts are cut to ``max_doc_chars`` (0 keeps them whole). Every call goes to the audit log below ``out``."""
    cut = lambda c: X.truncate(X.collapse_space(c), options.max_doc_chars)
    known = train.join(markers.select(F.col("text_uuid").alias("oare_id")).distinct(), "oare_id", "left_semi").select("oare_id", cut("transliteration").alias("transliteration"), cut("translation").alias("translation"))
    docs = next_documents(known, done if done is not None else known.limit(0), options)
    columns = [c for c in ("line_number", "first_word_transcription", "translation") if c in markers.columns]
    clues = align.clues(markers, ["sentence_obj_in_text", "line_number"], columns).withColumnRenamed("text_uuid", "oare_id")
    asked = docs.join(clues, "oare_id")
    prompts = asked.select(F.col("oare_id").alias("input_key"), J.alignment_payload("oare_id", "transliteration", "translation", "clues", ALIGN_TASK, ALIGN_RULES).alias("prompt"))
    wait = lambda _: options.retry_seconds
    first = _asked(prompts, client, options, wait, f"{out}/calls").select(F.col("input_key").alias("oare_id"), F.col("raw_text").alias("reply"))
    second = first.limit(0)
    if options.second_pass:
        left = first.withColumn("r", J.parse_reply("reply", J.ALIGNMENT_REPLY)).select("oare_id", *[X.collapse_space(f"r.leftover_{c}_text").alias(c) for c in ("source", "target")]).filter("source <> '' AND target <> ''")
        again = left.join(clues, "oare_id").select(F.col("oare_id").alias("input_key"), J.alignment_payload("oare_id", "source", "target", "clues", AGAIN_TASK, ALIGN_RULES).alias("prompt"))
        second = _asked(again, client, options, wait, f"{out}/calls").select(F.col("input_key").alias("oare_id"), F.col("raw_text").alias("reply"))
    verdicts = align.two_passes(docs, first, second, options.overlap)
    status = align.alignment_status(docs, first, verdicts, markers)
    return {"verdicts": verdicts, "pairs": align.aligned_pairs(verdicts), "issues": align.validation_issues(verdicts), "status": status, "leftovers": align.leftovers(status)}


def read_pages(short: DataFrame, client: Client, out: str, options: ReplyOptions = ReplyOptions(), done: DataFrame | None = None) -> DataFrame:
    """CLI-04: pages of a shortlist to a model, within the options' limits, and the silver pairs of all replies so far.
    ``done``: input_key of pages that need not be sent again. The audit log is below ``out``."""
    todo = tables.read_capped(short, options.max_rows, "pdf_name", "page", "oare_id").withColumn("input_key", input_key())
    if options.resume and done is not None:
        todo = without_done(todo, done, "input_key")
    prompts = todo.dropDuplicates(["input_key"]).select("input_key", J.page_prompt(J.PAGE_TEMPLATE, **{c: c for c in ("oare_id", "page", "pdf_name", "match_source", "match_confidence", "transliteration", "page_text")}).alias("prompt"))
    _asked(prompts, client, options, responses.backoff, f"{out}/calls")
    log = tables.read_jsonl(short.sparkSession, f"{out}/calls", responses.LOG)
    return silver(short, log.filter("error IS NULL OR error = ''").select("input_key", "raw_text"), options)


def silver(short: DataFrame, log: DataFrame, options: ReplyOptions = ReplyOptions()) -> DataFrame:
    return responses.silver_pairs(short, log, options.min_confidence, options.min_target_chars)
