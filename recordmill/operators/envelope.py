"""Envelopes around records: identities, attributes, sizes, and the split by size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions import identity, sizes


def envelopes(records: DataFrame, job: Column, *, data_type: str = "text", schema_id: str = "record", schema_version: str = "1", created_at: Column | None = None, context: dict[str, Column] | None = None) -> DataFrame:
    """records: bucket, key, version_id, etag, size, chunk_id, ordinal, byte_offset, raw -> the same
    with file_id, source_record_id, event_id and the nested ``envelope``.

    A projection. The record number is set in the first chunk only, the byte length left out for an
    empty record. ``created_at`` is given by the caller so that results can be repeated.
    """
    context = context or {}
    none = F.lit(None).cast("string")
    rows = records.withColumn("file_id", identity.file_id("bucket", "key", "version_id", "etag", "size"))
    rows = rows.withColumn("source_record_id", identity.source_record_id("file_id", "byte_offset"))
    rows = rows.withColumn("job_id", job).withColumn("event_id", identity.event_id("job_id", "source_record_id"))
    empty_to_null = lambda c: F.nullif(F.col(c), F.lit(""))
    envelope = F.struct(
        F.struct(
            F.col("event_id").alias("eventId"), F.col("source_record_id").alias("sourceRecordId"), F.struct(F.lit(schema_id).alias("id"), F.lit(schema_version).alias("version")).alias("schema"),
            F.lit(data_type).alias("format"), (created_at if created_at is not None else none).alias("createdAt"), *[context.get(k, none).alias(k) for k in ("transactionId", "correlationId", "traceId")],
        ).alias("metadata"),
        F.struct(F.lit("object").alias("type"), context.get("sourceSystem", none).alias("system"), F.col("bucket"), F.col("key"), empty_to_null("version_id").alias("versionId"), empty_to_null("etag").alias("etag"), sizes.base_name(F.col("key")).alias("fileName"), F.lit(data_type).alias("fileFormat"), F.col("size").alias("fileSize")).alias("source"),
        F.struct(F.col("job_id").alias("jobId"), F.col("chunk_id").alias("chunkId"), F.when(F.col("chunk_id") == "00000001", F.col("ordinal")).alias("recordNumber"), F.col("byte_offset").alias("byteOffset"), sizes.byte_length(F.col("raw")).alias("byteLength")).alias("processing"),
        F.struct(F.col("raw").alias("raw")).alias("data"),
    )
    return rows.withColumn("envelope", envelope)


def messages(enveloped: DataFrame, attrs: Column) -> DataFrame:
    """Adds body (JSON without null fields), attributes and message_bytes."""
    return enveloped.withColumn("body", F.to_json("envelope")).withColumn("attributes", attrs).withColumn("message_bytes", sizes.message_size(F.col("body"), F.col("attributes")))


def split_by_size(df: DataFrame, size: str = "message_bytes", limit: int = sizes.MAX_MESSAGE_BYTES, fail: bool = False) -> tuple[DataFrame, DataFrame]:
    """What fits, and what does not with its reason; or, if ``fail``, an error at the first that does not."""
    if fail:
        return df.withColumn(size, F.when(F.col(size) > limit, F.raise_error(F.lit("MESSAGE_TOO_LARGE")).cast("long")).otherwise(F.col(size))), df.limit(0).withColumn("reason", F.lit(""))
    return df.where(F.col(size) <= limit), df.where(F.col(size) > limit).withColumn("reason", F.lit("MESSAGE_TOO_LARGE"))


def redacted(df: DataFrame, *columns: str) -> DataFrame:
    """Credentials blanked before a row is stored."""
    return df.withColumns({c: F.lit("") for c in columns})


def localised(df: DataFrame, zone: str, *columns: str) -> DataFrame:
    """UTC timestamps in a zone's local time; by default all whose names end in At or timestamp."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp" and (f.name.endswith(("At", "_at")) or f.name.lower().endswith("timestamp"))]
    return df.withColumns({c: F.from_utc_timestamp(c, zone) for c in names})
