"""Incremental jobs with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quorate.operators.lookup import upsert
from quorate.sources.writers import exists, recover, rewrite


def read_deltas(spark: SparkSession, folder: str, schema: str, per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder; the checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def upsert_stream(deltas: DataFrame, table: str, key: str, order: Sequence[Column], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Merges each batch into a Parquet table: the newest row of each key wins.

    The merge gives the same table when a batch comes again, so a batch that
    was lost half-way is simply repeated, after a swap that it left half-way
    has been ended; the checkpoint moves on afterwards.
    every: runs on at that interval ("24 hours"); else what is there is merged once.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        recover(spark, table)
        old = spark.read.parquet(table) if exists(spark, table) else spark.createDataFrame([], batch.schema)
        new = old.unionByName(batch.withColumn("_new", F.lit(1)), allowMissingColumns=True)
        stored, fresh = new.where("_new IS NULL").drop("_new"), new.where("_new = 1").drop("_new")
        both = fresh.unionByName(stored.join(fresh.select(key), key, "left_semi"))
        rewrite(upsert(stored, both, key, order), table)

    return deltas.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def _timed(events: DataFrame, time: str) -> DataFrame:
    """Watermarks need a time with a zone; one without is read in the session's."""
    return events.withColumn(time, F.col(time).cast("timestamp")) if dict(events.dtypes)[time] == "timestamp_ntz" else events


def windowed_counts(events: DataFrame, time: str, keys: Sequence[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts in tumbling windows; rows later than `late` are left out of a stream."""
    return _timed(events, time).withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, time: str, keys: Sequence[str], gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each key that end after a gap."""
    return _timed(events, time).withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")


def distinct_events(events: DataFrame, key: str, time: str, late: str = "2 hours") -> DataFrame:
    """Each key once, within the watermark."""
    return _timed(events, time).withWatermark(time, late).dropDuplicatesWithinWatermark([key])
