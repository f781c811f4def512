"""Exactly-once processing of what arrives, rolling rates, and the append log (STM-01 to STM-03, STM-05, STM-06, SNK-06)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import exists


def process_new(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 100, pattern: str = "*.parquet") -> DataFrame:
    """STM-01, STM-02, STM-05: run ``work`` over the files of a folder that no earlier run has seen, and append its rows.

    The checkpoint remembers the files; a batch writes to a folder of its own number, so one that is repeated after a
    failure replaces itself. Memory is bounded by ``files_per_batch``. Returns all rows written so far.
    """

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out) if exists(spark, out) else work(spark.createDataFrame([], schema))


def rolling_load(events: DataFrame, key: str, ts: str, tokens: str, seconds: int = 60) -> DataFrame:
    """STM-03, AGG-16 as data: for every event the requests and tokens of its key in the window that ends with it."""
    # A window ends in the bucket of its event and reaches into the bucket before at most, so each event is put into its own
    # bucket and, as context, into the next one: keys with very many events are many tasks' work.
    span = seconds * 1_000_000
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    own = F.floor(F.col("__at") / span)
    rows = events.withColumn("__at", at).withColumn("__own", own).withColumn("__bucket", F.explode(F.array("__own", F.col("__own") + 1)))
    w = Window.partitionBy(key, "__bucket").orderBy("__at").rangeBetween(-span, 0)
    rows = rows.withColumn("window_requests", F.count("*").over(w)).withColumn("window_tokens", F.sum(tokens).over(w))
    return rows.filter("__own <=> __bucket").drop("__at", "__own", "__bucket")


def admitted(events: DataFrame, rpm: int, tpm: int) -> DataFrame:
    """Events of rolling_load that a limit of requests and tokens in the window would let through at once; 0 is no limit."""
    ok = F.lit(True)
    if rpm > 0:
        ok = ok & (F.col("window_requests") <= rpm)
    if tpm > 0:
        ok = ok & (F.col("window_tokens") <= tpm)
    return events.withColumn("admitted", ok)


def windowed_load(stream: DataFrame, key: str, ts: str, tokens: str, seconds: int = 60, late: str = "5 minutes") -> DataFrame:
    """STM-03 as a stream: requests and tokens of each key in tumbling windows; batches and streams give the same rows."""
    at = F.col(ts).cast("timestamp")
    rows = stream.withColumn("__at", at)
    if stream.isStreaming:
        rows = rows.withWatermark("__at", late)
    out = rows.groupBy(F.window("__at", f"{seconds} seconds"), key).agg(F.count("*").alias("requests"), F.sum(tokens).alias("tokens"))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), key, "requests", "tokens")
