"""Greedy packing of ordered items under a count and a size cap, and batches of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.functions.identity import bundle_id


def greedy(sizes: list[int], max_items: int, max_bytes: int, empty_bytes: int, separator_bytes: int) -> list[int]:
    """The number of the bundle that each item goes to: a new one when the next item would pass a cap."""
    out, bundle, n, used = [], 0, 0, empty_bytes
    for size in sizes:
        more = size + (separator_bytes if n else 0)
        if n and (n >= max_items or used + more > max_bytes):
            bundle, n, used, more = bundle + 1, 0, empty_bytes, size
        n, used = n + 1, used + more
        out.append(bundle)
    return out


def packed(items: DataFrame, group: list[str], order: list[str], size: str, *, max_items: int, max_bytes: int, empty_bytes: int = 0, separator_bytes: int = 0) -> DataFrame:
    """The columns of ``items`` and bundle_no (from 0 in each group). Items larger than a bundle can
    be are the caller's to split off first (``fits``).

    Groups are streamed in order within partitions: a task holds one number per open group, not the
    group, so a chunk of any length will do. The order must be total within a group.
    """
    rows = items.repartition(*group).sortWithinPartitions(*group, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bundle, n, used = None, 0, 0, empty_bytes
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in group], strict=True))
            out = []
            for key, s in zip(keys, batch.column(size).to_pylist(), strict=True):
                if key != now:
                    now, bundle, n, used = key, 0, 0, empty_bytes
                more = s + (separator_bytes if n else 0)
                if n and (n >= max_items or used + more > max_bytes):
                    bundle, n, used, more = bundle + 1, 0, empty_bytes, s
                n, used = n + 1, used + more
                out.append(bundle)
            yield batch.append_column("bundle_no", pa.array(np.array(out, np.int64)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return rows.mapInArrow(run, f"{fields}, bundle_no long")


def fits(size: Column, max_bytes: int, empty_bytes: int = 0) -> Column:
    return size + empty_bytes <= max_bytes


def bundled(items: DataFrame, group: list[str], event_id: str, order: list[str]) -> DataFrame:
    """One row per bundle: its id, number of items, and the items' ids in order."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(event_id).alias("__id"))))
    return items.groupBy(*group, "bundle_no").agg(bundle_id(F.collect_list(event_id)).alias("bundle_id"), F.count("*").alias("items"), F.transform(listed, lambda x: x["__id"]).alias("event_ids"))


def bodies(items: DataFrame, group: list[str], event_id: str, body: str, order: list[str], version: str = "1") -> DataFrame:
    """One row per bundle: its id and its message, the items' own JSON put into one document in
    order. Bundles are bounded by their caps, so their items are listed without harm."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(event_id).alias("__id"), F.col(body).alias("__body"))))
    out = items.groupBy(*group, "bundle_no").agg(listed.alias("__l"))
    number = bundle_id(F.transform("__l", lambda x: x["__id"]))
    text = F.concat(F.lit(f'{{"schemaVersion":"{version}","bundleId":"'), F.col("bundle_id"), F.lit('","items":['), F.array_join(F.transform("__l", lambda x: x["__body"]), ","), F.lit("]}"))
    return out.withColumn("bundle_id", number).select(*group, "bundle_no", "bundle_id", F.size("__l").cast("long").alias("items"), text.alias("body"))


def bundle_stats(messages: DataFrame, items: str = "items", body: str = "body") -> DataFrame:
    """Fewest, most and mean items and bytes of messages."""
    size = F.octet_length(body)
    return messages.agg(F.count("*").alias("bundles"), F.min(items).alias("min_items"), F.max(items).alias("max_items"), F.round(F.avg(items), 6).alias("avg_items"), F.min(size).alias("min_bytes"), F.max(size).alias("max_bytes"), F.round(F.avg(size), 4).alias("avg_bytes"))


def by_count(items: DataFrame, order: list[str], n: int, group: list[str] | None = None) -> DataFrame:
    """batch_no of groups of ``n`` in order."""
    w = Window.partitionBy(*(group or [])).orderBy(*order)
    return items.withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / n).cast("long"))
