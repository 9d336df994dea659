"""Sizes, formats and small scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a physical message and each of its attributes cost besides their bytes.
MESSAGE_OVERHEAD, ATTRIBUTE_OVERHEAD = 64, 32
MAX_MESSAGE_BYTES = 1_048_576
MAX_ATTRIBUTES = 10


def base_name(key: Column) -> Column:
    """The last element of a path, trailing slashes aside; "." for an empty one, "/" for slashes only."""
    bare = F.regexp_replace(key, "/+$", "")
    return F.when(key == "", ".").when(bare == "", "/").otherwise(F.element_at(F.split(bare, "/"), -1))


def byte_length(raw: Column) -> Column:
    """Null for an empty record."""
    return F.nullif(F.octet_length(raw).cast("long"), F.lit(0).cast("long"))


def attributes(**named: Column | str) -> Column:
    """A map of the attributes that are neither null nor empty."""
    keys, values = zip(*named.items(), strict=True)
    cols = [F.col(v) if isinstance(v, str) else v for v in values]
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*[F.coalesce(c, F.lit("")) for c in cols])), lambda _, v: v != "")


def message_size(body: Column, attrs: Column, kind: str = "String") -> Column:
    """Bytes of the body, its overhead, and name, type, value and overhead of each attribute."""
    each = F.aggregate(F.map_entries(attrs), F.lit(0), lambda a, e: a + F.octet_length(e["key"]) + len(kind) + F.octet_length(e["value"]) + ATTRIBUTE_OVERHEAD)
    return (F.octet_length(body) + MESSAGE_OVERHEAD + each).cast("long")


def throughput(count: Column, ms: Column) -> Column:
    return F.when(ms <= 0, 0.0).otherwise(count / (ms / 1000.0))


def utilisation(user: Column, system: Column, wall: Column) -> Column:
    """CPU in percent of the time on the clock."""
    return F.when(wall <= 0, 0.0).otherwise((user + system) / wall * 100)


def speedup(sequential: Column, parallel: Column) -> Column:
    return F.when(parallel == 0, 0.0).otherwise(sequential / parallel)


def duration(ms: Column) -> Column:
    """ "250ms" below a second, else "1.250s"."""
    return F.when(ms < 1000, F.format_string("%dms", ms.cast("long"))).otherwise(F.format_string("%.3fs", ms.cast("double") / 1000))


def valid_zone(offset: Column) -> Column:
    """±HH:MM with hours up to 14 and minutes up to 59."""
    return F.coalesce(offset.rlike(r"^[+-](0\d|1[0-4]):[0-5]\d$"), F.lit(False))


def contains_all_terms(text: Column, query: Column) -> Column:
    return F.forall(F.filter(F.split(F.lower(query), r"\s+"), lambda t: t != ""), lambda t: F.contains(F.lower(text), t))
