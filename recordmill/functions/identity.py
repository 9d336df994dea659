"""Identities as column expressions: lower-case hex SHA-256 over fields joined by slashes.

Nulls are hashed as empty fields, so that an absent version or etag keeps its place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(*parts: Column | str) -> Column:
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("/", *cols), 256)


def file_id(bucket, key, version, etag, size) -> Column:
    return _joined(bucket, key, version, etag, size)


def source_record_id(file, offset) -> Column:
    """Depends on the file and the byte offset alone: not on chunks, packing, schema or replay."""
    return _joined(file, offset)


def source_record_id_v1(file, chunk, number, schema_id, schema_version) -> Column:
    """The older form, for audits."""
    return _joined(file, chunk, number, schema_id, schema_version)


def event_id(job, record) -> Column:
    """Stable when a job is retried, different when it is replayed."""
    return _joined(job, record)


def bundle_id(event_ids: Column) -> Column:
    """Of the sorted event ids, so independent of the order they came in."""
    return F.sha2(F.array_join(F.sort_array(event_ids), ""), 256)


def completion_id(job, version) -> Column:
    return _joined(job, F.lit("completion"), version)


def config_hash(config: Column) -> Column:
    return F.sha2(F.to_json(config), 256)


def completion_token(job, chunk, attempt, retry) -> Column:
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in (job, chunk, attempt, retry)]
    return F.substring(F.sha2(F.concat_ws("\0", *cols), 256), 1, 36)


def chunk_id(ordinal: Column) -> Column:
    """1-based, eight digits."""
    return F.lpad(ordinal.cast("string"), 8, "0")
