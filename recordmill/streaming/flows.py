"""Streams of files to envelopes, deduplication and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.functions.states import REASONS
from recordmill.operators.envelope import envelopes
from recordmill.operators.framing import frame


def enveloped_stream(documents: DataFrame) -> DataFrame:
    """A stream of documents to one of enveloped lines; the same projection as in batch."""
    key = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    objects = documents.select("doc_id", F.lit("corpus").alias("bucket"), key.alias("key"), F.lit("").alias("version_id"), F.md5(F.col("text").cast("binary")).alias("etag"), F.octet_length("text").cast("long").alias("size"), F.col("text").alias("content"))
    records = frame(objects, F.col("content"), ["doc_id", "bucket", "key", "version_id", "etag", "size"]).withColumn("chunk_id", F.lit("00000001"))
    return envelopes(records, F.col("doc_id").cast("string")).select("doc_id", "event_id", "source_record_id", "byte_offset", "envelope")


def dedupe_stream(events: DataFrame, key: str, at: str, within: str = "365 days") -> DataFrame:
    """Each key once; the watermark bounds how long keys are remembered."""
    return events.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def with_quarantine(stream: DataFrame, good: str, bad: str, mark: str):
    """A stream with a ``reason`` column: accepted rows go to one table, rejected ones to another.
    Both writes are of one micro-batch, computed once and named by its id, so that a batch that is tried
    again replaces what it wrote. Messages that may yet succeed belong to ``streaming.redelivery``."""
    if "reason" not in stream.columns:
        raise ValueError("a reason column is needed")

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        batch.where("reason is null").drop("reason").write.mode("overwrite").parquet(f"{good}/batch={number}")
        known = F.when(F.col("reason").isin(REASONS), F.col("reason")).otherwise("INVALID_CONFIGURATION")
        batch.where("reason is not null").withColumn("reason", known).write.mode("overwrite").parquet(f"{bad}/batch={number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", mark).trigger(availableNow=True).start()
