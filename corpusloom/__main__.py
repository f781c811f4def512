"""The programs on files: ``python -m corpusloom pairs|link|align|read|silver --help`` (CLI-01 to CLI-04)."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession

from .operators import responses
from .plans import pipelines
from .sources import tables


def _save(frames: dict[str, DataFrame], out: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")


def pairs(spark: SparkSession, a: argparse.Namespace) -> None:
    train, markers = f"{a.input}/train.csv", f"{a.input}/{a.markers}"
    tables.require_files(spark, train, markers)
    options = pipelines.PairOptions(valid_ratio=a.valid_ratio, salt=a.salt, strict_empty=a.strict_empty)
    out = pipelines.build_pairs(tables.read_csv(spark, train, tables.SCHEMAS["train"]), tables.read_csv(spark, markers, tables.SCHEMAS["sentence_markers"]), options)
    summary = out.pop("summary")
    _save(out, a.output)
    tables.append_history(spark, f"{a.output}/history", summary)


def link(spark: SparkSession, a: argparse.Namespace) -> None:
    pages, published = f"{a.input}/publications.csv", f"{a.input}/published_texts.csv"
    tables.require_files(spark, pages, published)
    rows = tables.read_capped(tables.read_csv(spark, pages, tables.SCHEMAS["publications"]), a.max_rows, "pdf_name", "page")
    _save(pipelines.link_pages(rows, tables.read_csv(spark, published, tables.SCHEMAS["published_texts"]), pipelines.LinkOptions(a.akkadian_only, a.min_confidence)), a.output)


def _client(name: str) -> pipelines.Client:
    """A function from prompt to reply, given as module:function."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def align(spark: SparkSession, a: argparse.Namespace) -> None:
    train, markers = f"{a.input}/train.csv", f"{a.input}/{a.markers}"
    tables.require_files(spark, train, markers)
    options = pipelines.AlignOptions(a.max_docs, a.max_doc_chars, a.second_pass, a.resume, a.shuffle_seed, a.overlap, a.retries, a.retry_seconds, a.rpm, a.tpm, a.callers)
    history = f"{a.output}/history"
    done = spark.read.option("mergeSchema", True).parquet(history).filter("status = 'completed'").select("oare_id") if tables.exists(spark, history) else None
    out = pipelines.align_documents(tables.read_csv(spark, train, tables.SCHEMAS["train"]), tables.read_csv(spark, markers, tables.SCHEMAS["sentence_markers"]), _client(a.client), a.output, options, done)
    status = out.pop("status")
    for name, df in out.items():
        df.write.mode("append").parquet(f"{a.output}/{name}")
    tables.append_history(spark, history, status)  # last: what it names as completed has been written


def read(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.require_files(spark, a.shortlist)
    options = pipelines.ReplyOptions(a.rpm, a.tpm, a.max_rows, a.retries, a.min_confidence, a.min_target_chars, a.resume, a.callers)
    log = f"{a.output}/calls"
    done = tables.read_jsonl(spark, log, responses.LOG).filter("raw_text <> '' AND (error IS NULL OR error = '')").select("input_key").distinct() if tables.exists(spark, log) else None
    _save({"silver": pipelines.read_pages(spark.read.parquet(a.shortlist), _client(a.client), a.output, options, done)}, a.output)


def silver(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.require_files(spark, a.shortlist, a.log)
    log = tables.read_jsonl(spark, a.log, "input_key string, raw_text string")
    options = pipelines.ReplyOptions(min_confidence=a.min_confidence, min_target_chars=a.min_target_chars)
    _save({"silver": pipelines.silver(spark.read.parquet(a.shortlist), log, options)}, a.output)


def _calls(p: argparse.ArgumentParser, rpm: int, tpm: int) -> None:
    """What programs that call a model share; the model, its address and its key are the client's own affair."""
    p.add_argument("--client", required=True, metavar="MODULE:FUNCTION")
    p.add_argument("--rpm", type=int, default=rpm, help="requests a minute, 0: no limit")
    p.add_argument("--tpm", type=int, default=tpm, help="tokens a minute, 0: no limit")
    p.add_argument("--callers", type=int, default=1)
    p.add_argument("--retries", type=int, default=3)
    p.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    sub = p.add_subparsers(required=True)
    one = sub.add_parser("pairs", help="documents and markers to sentence pairs")
    one.add_argument("--input", required=True)
    one.add_argument("--output", required=True)
    one.add_argument("--markers", default="sentence_markers.csv")
    one.add_argument("--valid-ratio", type=float, default=0.1)
    one.add_argument("--salt", default="deep_past_split_v1")
    one.add_argument("--strict-empty", action=argparse.BooleanOptionalAction, default=False)
    one.set_defaults(run=pairs)
    two = sub.add_parser("link", help="pages to catalogue records")
    two.add_argument("--input", required=True)
    two.add_argument("--output", required=True)
    two.add_argument("--max-rows", type=int, default=0)
    two.add_argument("--akkadian-only", action=argparse.BooleanOptionalAction, default=True)
    two.add_argument("--min-confidence", type=float, default=0.80)
    two.set_defaults(run=link)
    four = sub.add_parser("align", help="documents to a model that pairs their sentences")
    four.add_argument("--input", required=True)
    four.add_argument("--output", required=True)
    four.add_argument("--markers", default="sentence_markers.csv")
    four.add_argument("--max-docs", type=int, default=0)
    four.add_argument("--max-doc-chars", type=int, default=12_000)
    four.add_argument("--second-pass", action=argparse.BooleanOptionalAction, default=True)
    four.add_argument("--shuffle-seed", type=int)
    four.add_argument("--overlap", type=float, default=0.95)
    four.add_argument("--retry-seconds", type=float, default=2.0)
    _calls(four, 0, 0)
    four.set_defaults(run=align)
    five = sub.add_parser("read", help="pages of a shortlist to a model, its replies to sentence pairs")
    five.add_argument("--shortlist", required=True)
    five.add_argument("--output", required=True)
    five.add_argument("--max-rows", type=int, default=0)
    five.add_argument("--min-confidence", type=float, default=0.80)
    five.add_argument("--min-target-chars", type=int, default=0)
    _calls(five, 40, 200_000)
    five.set_defaults(run=read)
    three = sub.add_parser("silver", help="replies to sentence pairs")
    three.add_argument("--shortlist", required=True)
    three.add_argument("--log", required=True)
    three.add_argument("--output", required=True)
    three.add_argument("--min-confidence", type=float, default=0.80)
    three.add_argument("--min-target-chars", type=int, default=0)
    three.set_defaults(run=silver)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(spark or SparkSession.builder.appName("corpusloom").getOrCreate(), a)


if __name__ == "__main__":
    main()
