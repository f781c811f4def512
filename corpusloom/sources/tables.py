"""Schemas of the domain's files, and readers and writers for them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the domain's files, all text unless the arithmetic needs numbers.
SCHEMAS = {
    "train": "oare_id string, transliteration string, translation string",
    "test": "id string, text_id string, line_start string, line_end string, transliteration string",
    "sample_submission": "id string, translation string",
    "sentence_markers": "text_uuid string, sentence_uuid string, sentence_obj_in_text double, first_word_obj_in_text double, first_word_transcription string, line_number string, translation string",
    "published_texts": "oare_id string, online_transcript string, cdli_id string, aliases string, label string, publication_catalog string, description string, genre_label string, inventory_position string, online_catalog string, note string, interlinear_commentary string, online_information string, excavation_no string, oatp_key string, eBL_id string, AICC_translation string, transliteration_orig string, transliteration string",
    "publications": "pdf_name string, page string, page_text string, has_akkadian string",
    "bibliography": "pdf_name string, title string, author string, author_place string, journal string, volume string, year string, pages string",
    "oa_lexicon": "type string, form string, norm string, lexeme string, eBL string, I_IV string, A_D string, female string, alt_lex string",
}
#: Cells that a CSV file means as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, kind: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names, which all executors share (in local mode a folder of
    its own where it is unset, for tests); removed when the JVM ends."""
    base, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not base:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    at, fs = _fs(spark, path)
    fs.deleteOnExit(at)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return bool(fs.exists(at))


def require_files(spark: SparkSession, *paths: str) -> None:
    """SRC-07: an error before any planning if a file is missing."""
    if missing := [p for p in paths if not exists(spark, p)]:
        raise FileNotFoundError(f"missing inputs: {missing}")


def read_csv(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """SRC-01, SRC-02: quoted cells may hold line feeds; the schema is given, never inferred; only the columns asked for
    are read; cells that mean a missing value become null, in text columns too."""
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if columns is not None:
        df = df.select(*columns)
    return df.select(*[F.when(~F.coalesce(F.col(c), F.lit("")).isin(*missing), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_capped(df: DataFrame, most: int, *order: str) -> DataFrame:
    """SRC-03, LIM-01: the first rows of an explicit order; 0 or less reads all."""
    return df.orderBy(*order).limit(most) if most > 0 else df


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-04: an empty frame if there is no file."""
    return read_csv(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def find_file(spark: SparkSession, name: str, roots: list[str]) -> str | None:
    """SRC-05: the shortest path (then the first by name) of a file anywhere below the roots."""
    found: list[str] = []
    for root in roots:
        at, fs = _fs(spark, root)
        if not fs.exists(at):
            continue
        files = fs.listFiles(at, True)
        while files.hasNext():
            p = files.next().getPath()
            if p.getName() == name:
                found.append(p.toString())
    return min(found, key=lambda p: (len(p), p), default=None)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-06: a JSON object a line; lines that are none are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    at, fs = _fs(spark, path)
    fs.create(at).close()


def parse_env(lines: list[str], environ: dict[str, str] | None = None) -> dict[str, str]:
    """SRC-09: NAME=value lines, overruled by the environment; quotes around values, comments and blank lines go."""
    found: dict[str, str] = {}
    for line in map(str.strip, lines):
        name, eq, value = line.partition("=")
        if eq and not line.startswith("#"):
            found[name.strip()] = value.strip().strip("\"'")
    return found | dict(os.environ if environ is None else environ)


def read_env(path: str | None = None, environ: dict[str, str] | None = None) -> dict[str, str]:
    """SRC-09 from a file on the driver's machine, if it is there."""
    lines: list[str] = []
    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            lines = f.readlines()
    return parse_env(lines, environ)


def done_keys(spark: SparkSession, path: str, key: str = "input_key", only_parsed: bool = True) -> DataFrame:
    """SRC-11: the keys of an audit log that count as done; with ``only_parsed`` a failed call is not done."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{key} string")
    log = read_jsonl(spark, path, f"{key} string, error string, parsed string")
    good = log.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    if only_parsed:
        good = good.filter((F.coalesce("error", F.lit("")) == "") & F.col("parsed").isNotNull() & (F.col("parsed") != "{}"))
    return good.select(key).distinct()


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-01."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_splits(df: DataFrame, path: str, column: str = "split") -> None:
    """SNK-02: a folder for each split, which readers can prune."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def append_history(spark: SparkSession, path: str, row: DataFrame) -> DataFrame:
    """SNK-03: append a run's row; the history's columns are those of all runs, null where a run had none."""
    row.write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """SNK-04."""
    df.write.mode("append").json(path)
