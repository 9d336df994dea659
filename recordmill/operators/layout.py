"""The ledger as a table that is read by key prefix, and by status and time, without reading it all.

Rows are dealt by ranges of the key and sorted within their files, so the statistics of files and row
groups tell which can hold a key or a prefix of the second one; bloom filters tell for keys that lie in
the range of a file and are not there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 16 * 1024 * 1024


def write_clustered(df: DataFrame, path: str, *keys: str, files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES, distinct: int = 1_000_000) -> None:
    """A table clustered by ``keys``, the first of which has bloom filters for ``distinct`` values a
    row group. Equal keys may go to several files, so a hot one is no single task's. Fails if it is there."""
    dealt = df.repartitionByRange(*([files] if files else []), *keys, F.xxhash64(*df.columns)) if len(df.columns) > len(keys) else df.repartitionByRange(*([files] if files else []), *keys)
    conf, kind = df.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(kind)
    w = dealt.sortWithinPartitions(*keys).write.option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", 10_000)
    try:
        conf.set(kind, "TIMESTAMP_MICROS")  # the default has no statistics
        w.option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").option(f"parquet.bloom.filter.expected.ndv#{keys[0]}", distinct).parquet(path)
    finally:
        conf.set(kind, before)


def partition_of(spark: SparkSession, path: str, pk: str, prefix: str = "") -> DataFrame:
    """The rows of one partition key, or those whose sort key begins so, in order."""
    rows = spark.read.parquet(path).where(F.col("pk") == pk)
    return (rows.where(F.col("sk").startswith(prefix)) if prefix else rows).orderBy("sk")


def status_range(spark: SparkSession, path: str, status: str, after: Column | None = None, before: Column | None = None) -> DataFrame:
    """Rows of a status in a range of update times, of a table clustered by status and updated_at. With
    both bounds the range is inclusive; ``before`` alone is exclusive."""
    rows, at = spark.read.parquet(path).where(F.col("status") == status), F.col("updated_at")
    if after is not None:
        rows = rows.where(at >= after)
    if before is not None:
        rows = rows.where(at <= before if after is not None else at < before)
    return rows


def scanned_rows(df: DataFrame) -> tuple[int, int]:
    """Runs the query; files and rows that its scans of tables read."""
    df.collect()
    files = rows = 0
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    todo = [leaves.apply(i) for i in range(leaves.size())]
    while todo:
        leaf = todo.pop()
        if hasattr(leaf, "plan") and "QueryStage" in leaf.getClass().getSimpleName():
            inner = leaf.plan().collectLeaves()
            todo += [inner.apply(i) for i in range(inner.size())]
            continue
        metrics = leaf.metrics()
        if metrics.contains("numFiles"):
            files += metrics.apply("numFiles").value()
            rows += metrics.apply("numOutputRows").value()
    return files, rows
