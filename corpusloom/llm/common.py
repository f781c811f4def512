"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; all other characters belong to words. ``bytes.split()`` splits at exactly these.
WHITE = b" \t\n\v\f\r"
#: Bytes of a batch that a Python worker turns into its own objects at a time.
SLICE = 12 << 20
#: Bytes of a batch on its way to a Python worker and back: texts differ in length, so rows are no bound on memory.
BATCH_BYTES = 16 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; in local mode a folder of its own where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def materialise(df: DataFrame, kind: str = "table") -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back, so that lost executors cost only their tasks."""
    spark = df.sparkSession
    path = new_folder(spark, kind)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """The same columns as c0, c1, ...: whatever names they had, they clash with nothing."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> str:
    """The name of a column after ``numbered``: the one that is called exactly so, or but for case."""
    exact = [i for i, c in enumerate(df.columns) if c == name] or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not exact:
        raise ValueError(f"no column {name} among {df.columns}")
    return f"c{exact[0]}"


def bound_batches(spark: SparkSession) -> None:
    """The session's Arrow batches hold ``BATCH_BYTES`` at most, or less if it says so already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def as_docs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` as long, ``text`` as UTF-8 bytes (null: empty), and the columns to keep; all other columns go, whatever their names. Sets ``bound_batches``."""
    bound_batches(df.sparkSession)
    text = F.coalesce(F.col(place_of(df, text_col)).cast("binary"), F.lit(b""))
    return numbered(df).select(F.col(place_of(df, id_col)).cast("long").alias("doc_id"), text.alias("text"), *[F.col(place_of(df, c)).alias(c) for c in keep])


def give_back() -> None:
    """Return free memory to the system: Python workers stay on between tasks, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches without empty ones, halved until a part has ``most`` bytes (``SLICE``) or is a single row."""
    most = most or SLICE
    todo: list[pa.RecordBatch] = []
    for b in batches:
        todo.append(b)
        while todo:
            b = todo.pop()
            if b.num_rows > 1 and b.nbytes > most:
                half = b.num_rows // 2
                todo += [b.slice(half), b.slice(0, half)]
            elif b.num_rows:
                yield b
    b = None
    give_back()


def rows_of(batches: Iterator[pa.RecordBatch], *names: str, most: int | None = None) -> Iterator[tuple[list, ...]]:
    """The named columns as Python lists, some megabytes of them at a time."""
    for b in slices(batches, most):
        yield tuple(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)


def out_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def spread(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Deal rows out by key over as many partitions as the session's shuffles have."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
