"""Chunks of objects from their sizes alone: the same rules as columns and as a function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.identity import chunk_id
from recordmill.functions.validate import DEFAULT_CHUNK_LIMIT, MIN_CHUNK

#: Without a target an object is cut into so many chunks.
CHUNKS = 100


def chunk_limit(max_chunk: Column) -> Column:
    """The largest chunk allowed; 64 MiB where none is given."""
    return F.when(F.coalesce(max_chunk, F.lit(0)) > 0, max_chunk).otherwise(F.lit(DEFAULT_CHUNK_LIMIT)).cast("long")


def chunk_count(size: Column, max_chunk: Column, target: Column) -> Column:
    """One below 5 MiB, whatever the maximum. Else 100 or as many as the target asks for; raised until
    no chunk is larger than the maximum, then lowered until none is smaller than 5 MiB, which so holds
    where both cannot. Null for a size of zero, and for 5 MiB or more with a maximum below that."""
    up = lambda a, b: F.floor((a + b - 1) / b).cast("long")
    limit = chunk_limit(max_chunk)
    wanted = F.when(F.coalesce(target, F.lit(0)) > 0, up(size, F.greatest(target, F.lit(1)))).otherwise(F.lit(CHUNKS))
    count = F.least(F.greatest(wanted, up(size, limit)), F.floor(size / MIN_CHUNK).cast("long"))
    return F.when(size <= 0, F.lit(None)).when(size < MIN_CHUNK, F.lit(1)).when(limit < MIN_CHUNK, F.lit(None)).otherwise(count).cast("long")


def balanced_tiles(objects: DataFrame, size: str = "size", count: str = "chunk_count") -> DataFrame:
    """Tile k of n is [size*k/n, size*(k+1)/n - 1] in whole numbers."""
    rows = objects.where(F.col(count) > 0).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1)))
    return rows.withColumns({"chunk_id": chunk_id(F.col("k") + 1), "start_byte": F.expr(f"({size} * k) div {count}"), "end_byte": F.expr(f"({size} * (k + 1)) div {count} - 1")}).drop("k")


def nominal_bytes(records: Column, max_element: Column) -> Column:
    """Null if the product overflows."""
    return F.try_multiply(records.cast("long"), max_element.cast("long"))


def nominal_error(records: Column, max_element: Column, max_chunk: Column) -> Column:
    """Why there are no such tiles: OVERFLOW, also of a product below one element; CHUNK_BYTES beyond
    the largest chunk; null if there are."""
    nominal = nominal_bytes(records, max_element)
    return F.when(nominal.isNull() | (nominal < max_element), "OVERFLOW").when(nominal > chunk_limit(max_chunk), "CHUNK_BYTES")


def nominal_tiles(objects: DataFrame, records: Column, max_element: Column, size: str = "size") -> DataFrame:
    """Tiles of records x largest element bytes. No row where ``nominal_error`` finds something."""
    rows = objects.withColumn("nominal", nominal_bytes(records, max_element)).where((F.col("nominal") > 0) & (F.col(size) > 0))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({size} - 1) div nominal"))))
    return rows.withColumns({"chunk_id": chunk_id(F.col("k") + 1), "start_byte": F.col("k") * F.col("nominal"), "end_byte": F.least((F.col("k") + 1) * F.col("nominal"), F.col(size)) - 1}).drop("k", "nominal")


def plan_summary(chunks: DataFrame, keys: list[str], size: str = "size") -> DataFrame:
    return chunks.groupBy(*keys).agg(F.count("*").alias("chunks"), F.max(size).cast("long").alias("size"))


def effective(override: Column, default: Column) -> Column:
    """The job's value unless it is null, zero or empty."""
    return F.coalesce(F.nullif(override, F.lit(0).cast("long")), default)


def pinned_version(version: Column) -> Column:
    """Null, meaning the current object, for no version, an empty one or the word null."""
    return F.nullif(F.nullif(version, F.lit("null")), F.lit(""))


def tiles(size: int, target: int) -> list[tuple[int, int]]:
    """Balanced ranges of about ``target`` bytes, for readers."""
    n = max(1, -(-size // max(1, target)))
    return [(size * k // n, size * (k + 1) // n - 1) for k in range(n)] if size else []
