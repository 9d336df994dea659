"""Requests to plans: validate, look the object up, check it, and cut it into chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.validate import MIN_CHUNK, absent, bad_fields, type_supported
from recordmill.plans.planner import balanced_tiles, chunk_count, chunk_limit, nominal_error, nominal_tiles, pinned_version

#: An object may be so large unless the configuration says otherwise.
MAX_FILE = 10 * 1024**3


def _limited() -> Column:
    """Text with a record limit, which can be cut."""
    return (F.col("data_type") == "text") & (F.coalesce(F.col("max_record_bytes"), F.lit(0)) > 0)


def _element() -> Column:
    """The largest element of JSON and multi-line objects."""
    return F.when(F.col("data_type") == "json", F.col("json_max_element_bytes")).otherwise(F.col("lines_max_record_bytes")).cast("long")


def plan_error(max_chunk_bytes: int, records_per_chunk: int) -> Column:
    """Why an object of known size has no plan, in the order in which its type is checked; null if it
    has one. Every row without an error gets at least one chunk from ``planned``.

    LAYOUT: no first field, no largest element, no or wrong break fields; EMPTY: no byte; OVERFLOW and
    CHUNK_BYTES: tiles of so many records cannot be or are larger than a chunk may be; CHUNK_MINIMUM:
    text of 5 MiB or more, and a largest chunk below that; NOT_SPLITTABLE: text without a record limit
    that is larger than one chunk."""
    c, limit = F.col, chunk_limit(F.lit(max_chunk_bytes))
    small = F.coalesce(_element(), F.lit(0)) < 1
    lines = (F.coalesce(F.size("break_fields"), F.lit(0)) < 1) | bad_fields(c("break_fields")) | bad_fields(c("include_fields")) | bad_fields(c("ignore_fields"))
    tiled = nominal_error(F.lit(records_per_chunk), _element(), limit)
    return (
        F.when((c("data_type") == "json") & (small | absent("json_first_field")), "LAYOUT")
        .when((c("data_type") == "multi-line") & (small | F.coalesce(lines, F.lit(False))), "LAYOUT")
        .when(c("size") <= 0, "EMPTY")
        .when(c("data_type") != "text", tiled)
        .when(_limited(), F.when((c("size") >= MIN_CHUNK) & (limit < MIN_CHUNK), "CHUNK_MINIMUM"))
        .when(c("size") > limit, "NOT_SPLITTABLE")
    )


def checked(requests: DataFrame, heads: DataFrame, *, max_file_bytes: int = MAX_FILE, max_chunk_bytes: int, records_per_chunk: int, version: str = "1") -> DataFrame:
    """requests: execution_id, schema_version, bucket, key, version_id, etag, data_type, max_record_bytes,
    json_first_field, json_max_element_bytes, lines_max_record_bytes, break_fields, include_fields,
    ignore_fields; heads: bucket, key, version_id, etag, size (one row per version; the current one has
    ``current`` true). The requests with size, the head's etag and version, and ``error``: the first
    check that fails, null if none does. An object that is not there has none of these."""
    pinned = requests.withColumn("__version", pinned_version(F.col("version_id"))).withColumn("__asked", F.col("etag")).drop("version_id", "etag")
    same = (F.col("r.bucket") == F.col("h.bucket")) & (F.col("r.key") == F.col("h.key")) & F.when(F.col("r.__version").isNull(), F.col("h.current")).otherwise(F.col("r.__version") == F.col("h.version_id"))
    rows = pinned.alias("r").join(heads.alias("h"), same, "left").select("r.*", "h.version_id", "h.etag", "h.size")
    c = F.col
    error = (
        F.when(F.coalesce(c("schema_version") != version, F.lit(True)), "REQUEST")
        .when(absent("bucket") | absent("key"), "FILE")
        .when(~type_supported(c("data_type")), "TYPE")
        .when(c("size").isNull(), "NOT_FOUND")
        .when((F.coalesce(c("__asked"), F.lit("")) != "") & (c("__asked") != c("etag")), "CHANGED")
        .when(c("size") > (max_file_bytes or MAX_FILE), "FILE_BYTES")
        .otherwise(plan_error(max_chunk_bytes, records_per_chunk))
    )
    return rows.withColumn("error", error).drop("__version", "__asked")


def planned(ok: DataFrame, *, max_chunk_bytes: int, target_chunk_bytes: int = 0, records_per_chunk: int) -> DataFrame:
    """Chunks of requests without an error: text without a record limit as one chunk, with one in
    balanced tiles, the other types in tiles of so many of their largest elements."""
    text = F.col("data_type") == "text"
    single = ok.where(text & ~_limited()).withColumns({"chunk_id": F.lit("00000001"), "start_byte": F.lit(0).cast("long"), "end_byte": F.col("size") - 1})
    cut = ok.where(_limited()).withColumn("chunk_count", chunk_count(F.col("size"), F.lit(max_chunk_bytes), F.lit(target_chunk_bytes)))
    other = nominal_tiles(ok.where(~text), F.lit(records_per_chunk), _element())
    return single.unionByName(balanced_tiles(cut).drop("chunk_count")).unionByName(other)


def manifest(requests: DataFrame, chunks: DataFrame) -> DataFrame:
    """One sealed row for each execution whose requests are all without an error, with the chunks that
    are to come. An execution that asks for nothing (a row without a key) has a manifest too, whose job
    has only to be completed; one that asks for something and has no chunk is never sealed."""
    good = requests.groupBy("execution_id").agg(F.count("error").alias("errors"), F.count("key").alias("asked")).where("errors = 0")
    n = chunks.groupBy("execution_id").agg(F.count("*").alias("expected_chunks"))
    rows = good.join(n, "execution_id", "left").na.fill(0, ["expected_chunks"]).where("expected_chunks > 0 or asked = 0")
    return rows.select("execution_id", "expected_chunks", F.lit(True).alias("sealed"), (F.col("expected_chunks") == 0).alias("complete_only"))


def with_controls(chunks: DataFrame, manifests: DataFrame, control: Column | None = None) -> DataFrame:
    """The messages of a plan: its chunks, then a control message for each manifest without any."""
    note = F.lit("COMPLETE") if control is None else control
    controls = manifests.where("complete_only").select("execution_id", note.alias("control"))
    return chunks.unionByName(controls, allowMissingColumns=True)
