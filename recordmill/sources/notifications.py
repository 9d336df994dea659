"""Object notifications and explicit requests as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOTIFICATION = "Records array<struct<eventName: string, s3: struct<bucket: struct<name: string>, object: struct<key: string, versionId: string>>>>"
REQUEST = "schemaVersion string, executionId string, files array<struct<bucket: string, key: string, versionId: string, etag: string, dataType: string, maxRecordLengthBytes: bigint>>"


def notifications(messages: DataFrame, body: str, keep: list[str] | None = None) -> DataFrame:
    """bucket, key and version_id of every created object; keys are URL-decoded."""
    record = F.explode(F.from_json(body, NOTIFICATION)["Records"]).alias("r")
    rows = messages.select(*(keep or []), record).where(F.col("r.eventName").startswith("ObjectCreated:"))
    key = F.url_decode(F.replace(F.col("r.s3.object.key"), F.lit("+"), F.lit("%20")))
    return rows.select(*(keep or []), F.col("r.s3.bucket.name").alias("bucket"), key.alias("key"), F.nullif(F.col("r.s3.object.versionId"), F.lit("")).alias("version_id"))


def is_request(body: str):
    """A message with a schemaVersion is an explicit request, any other a notification."""
    return F.get_json_object(body, "$.schemaVersion").isNotNull()


def requests(messages: DataFrame, body: str) -> DataFrame:
    """One row for each file of each explicit request."""
    parsed = messages.where(is_request(body)).select(F.from_json(body, REQUEST).alias("q"))
    return parsed.select(F.col("q.schemaVersion").alias("schema_version"), F.col("q.executionId").alias("execution_id"), F.explode("q.files").alias("f")).select("schema_version", "execution_id", F.col("f.bucket").alias("bucket"), F.col("f.key").alias("key"), F.col("f.versionId").alias("version_id"), F.col("f.etag").alias("etag"), F.col("f.dataType").alias("data_type"), F.col("f.maxRecordLengthBytes").alias("max_record_bytes"))
