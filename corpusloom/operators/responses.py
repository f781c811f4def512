"""Model calls as a source, their audit log, and silver pairs from their replies (SRC-10, ALN-11, STM-04)."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsons as J
from ..functions import text as X
from .relational import first_by, input_key

LOG = "input_key string, raw_text string, error string, attempts int, elapsed_ms bigint"


def backoff(attempt: int, most: float = 8.0) -> float:
    """STM-04: seconds to wait after the nth failure: 2, 4, 8, 8, ..."""
    return min(2.0**attempt, most)


class Limiter:
    """STM-03 as control: lets a call through when the minute before it has room for it and its tokens; 0 is no limit."""

    def __init__(self, requests: int = 0, tokens: int = 0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.requests, self.tokens, self.clock, self.sleep = requests, tokens, clock, sleep
        self.calls: deque[tuple[float, int]] = deque()

    def admit(self, tokens: int) -> None:
        if self.tokens and tokens > self.tokens:
            raise ValueError(f"{tokens} tokens are more than a minute's {self.tokens}")
        while True:
            now = self.clock()
            while self.calls and self.calls[0][0] <= now - 60:
                self.calls.popleft()
            if (not self.requests or len(self.calls) < self.requests) and (not self.tokens or sum(n for _, n in self.calls) + tokens <= self.tokens):
                self.calls.append((now, tokens))
                return
            self.sleep(max(0.01, self.calls[0][0] + 60 - now))


def call_model(
    prompts: DataFrame, client: Callable[[str], str], retries: int = 3, wait: Callable[[int], float] = backoff, key: str = "input_key", prompt: str = "prompt", requests_per_minute: int = 0, tokens_per_minute: int = 0, callers: int = 1
) -> DataFrame:
    """SRC-10: a log row for each prompt. ``client`` is any picklable function from prompt to reply; an exception is a
    failed attempt. A row's error is that of its last attempt, and empty when that succeeded. Write the result before
    using it twice: it is computed again whenever it is read.

    With limits the prompts are dealt out to ``callers`` tasks, each of which keeps within its share of a minute's requests
    and estimated tokens, retries included. Too many callers for the limits are an error."""
    limited = requests_per_minute > 0 or tokens_per_minute > 0
    shares = (requests_per_minute // callers, tokens_per_minute // callers)
    if limited and (requests_per_minute > 0 and not shares[0] or tokens_per_minute > 0 and not shares[1]):
        raise ValueError(f"{callers} callers are too many for {requests_per_minute} requests and {tokens_per_minute} tokens a minute")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(*shares)
        for frame in frames:
            rows = []
            for k, p in zip(frame[key], frame[prompt]):
                began, raw, error = time.monotonic(), "", ""
                for attempt in range(1, retries + 1):
                    try:
                        limiter.admit(max(1, len(p) // 4))
                        raw, error = client(p), ""
                        break
                    except Exception as e:  # noqa: BLE001  any failure of the service
                        error = str(e)
                        if attempt < retries:
                            time.sleep(wait(attempt))
                rows.append((k, raw, error, attempt, int((time.monotonic() - began) * 1000)))
            yield pd.DataFrame(rows, columns=["input_key", "raw_text", "error", "attempts", "elapsed_ms"])

    asked = prompts.select(key, prompt)
    return (asked.repartition(callers) if limited else asked).mapInPandas(run, LOG)


def check_budget(prompts: DataFrame, tokens_per_minute: int, prompt: str = "prompt") -> DataFrame:
    """Prompts whose own estimate exceeds a minute's budget are refused up front, rather than waited for without end."""
    return prompts.filter(X.estimated_tokens(prompt) <= tokens_per_minute) if tokens_per_minute > 0 else prompts


def joined(items: Column | str, most: int = 10) -> Column:
    """AGG-15: the first items of an array as one text."""
    return F.concat_ws(" | ", F.slice(F.coalesce(X._col(items), F.array().cast("array<string>")), 1, most))


def silver_pairs(short: DataFrame, log: DataFrame, min_confidence: float = 0.80, min_target_chars: int = 0) -> DataFrame:
    """ALN-11, FLT-05, JOIN-11: a row for each pair of a reply that found a translation; a reply without pairs gives its
    whole translation. ``log``: input_key, raw_text. Of rows with one key in ``short`` the last by match source counts."""
    keyed = first_by(short.withColumn("input_key", input_key()), ["input_key"], F.desc("match_source"), F.desc("match_confidence"), F.desc("transliteration"))
    parsed = log.select("input_key", J.parse_reply("raw_text", fenced=False).alias("r")).filter("r IS NOT NULL")
    rows = keyed.join(parsed, "input_key").withColumn("conf", J.number_or_zero("r.confidence")).filter(J.true_flag("r.found") & (F.col("conf") >= min_confidence))
    no_pairs = F.array().cast("array<struct<source: string, target: string>>")
    several = F.transform("r.pairs", lambda p: F.struct(X.collapse_space_ends(X._text(p["source_sentence"])).alias("source"), X.collapse_space_ends(X._text(p["target_sentence_english"])).alias("target")))
    whole = F.array(F.struct(F.lit("").alias("source"), X.collapse_space_ends(X._text("r.translation_english")).alias("target")))
    pairs = F.when(F.coalesce(F.size("r.pairs"), F.lit(0)) > 0, several).otherwise(whole)
    flat = rows.select("*", F.posexplode(F.coalesce(pairs, no_pairs)).alias("pair_index", "pair")).filter(F.length("pair.target") >= max(1, min_target_chars))
    out = flat.select(
        "oare_id", F.when(F.col("pair.source") != "", F.col("pair.source")).otherwise(X._text("transliteration")).alias("source_transliteration"), F.col("pair.target").alias("target_translation_english"),
        F.col("pdf_name").alias("source_pdf"), F.col("page").alias("source_page"), F.col("match_source").alias("stage1_match_source"), F.col("match_confidence").alias("stage1_match_confidence"), F.col("conf").alias("stage2_confidence"),
        F.coalesce("r.language_detected", F.lit("other")).alias("language_detected"), X._text("r.llm_opinion").alias("llm_opinion"), joined("r.akkadian_from_page_text").alias("akkadian_from_page_text"),
        X._text("r.evidence").alias("evidence"), X._text("r.notes").alias("notes"), "pair_index", "input_key",
    )
    return first_by(out, ["oare_id", "source_pdf", "source_page", "source_transliteration", "target_translation_english"], F.asc("input_key"), F.asc("pair_index"))
