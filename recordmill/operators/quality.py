"""Checks on what a run has produced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicates(events: DataFrame, key: str = "event_id") -> DataFrame:
    return events.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def gaps(seen: DataFrame, group: str, ordinal: str, first: int, limit: int = 10) -> DataFrame:
    """The first ``limit`` ordinals that each group lacks between ``first`` and its largest.

    From neighbours in order: no more than ``limit`` ordinals of a gap are ever made, and none of the
    ranges between. Gaps of a group are counted up in order, so those beyond the limit make none."""
    have = seen.select(group, F.col(ordinal).cast("long").alias("o")).where(F.col("o") >= first).distinct()
    in_order = Window.partitionBy(group).orderBy("o")
    rows = have.withColumn("from", F.coalesce(F.lag("o").over(in_order) + 1, F.lit(first).cast("long"))).where("o > from")
    rows = rows.withColumn("before", F.coalesce(F.sum(F.col("o") - F.col("from")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    some = rows.where(F.col("before") < limit).withColumn("most", F.least(F.col("o") - F.col("from"), limit - F.col("before")))
    return some.select(group, F.explode(F.sequence(F.col("from"), F.col("from") + F.col("most") - 1)).alias("missing"))


def violations(counts: DataFrame) -> DataFrame:
    """Rows in which the records read are not those published, rejected and ignored together."""
    return counts.where(F.col("records_read") != F.col("records_published") + F.col("records_rejected") + F.col("records_ignored"))


def unreconciled(jobs: DataFrame) -> DataFrame:
    return jobs.where("completed < chunks")


def all_unique(df: DataFrame, *ids: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), *[(F.count(F.col(i)) - F.countDistinct(i)).alias(f"repeated_{i}") for i in ids])


def reasons(rejected: DataFrame, reason: str = "reason") -> DataFrame:
    return rejected.groupBy(reason).agg(F.count("*").alias("n"))


def reason_map(counts: DataFrame, reason: str = "reason", n: str = "n") -> DataFrame:
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(reason, n)))).alias("reasons"))


def expanded(bodies: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """Consumed messages as single envelopes: a bundle's items, or the message itself."""
    parsed = bodies.withColumn("__b", F.from_json(body, f"struct<items: array<{schema}>>")).withColumn("__s", F.from_json(body, schema))
    return parsed.withColumn("envelope", F.explode(F.coalesce("__b.items", F.array("__s")))).drop("__b", "__s")


def snapshot(messages: DataFrame, since: Column, key: str = "message_id", sent: str = "sent_at") -> DataFrame:
    """Messages once each, sent from a second before ``since``."""
    return messages.where(F.col(sent) >= since - F.expr("INTERVAL 1 SECOND")).dropDuplicates([key])
