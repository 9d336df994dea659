"""Running streams: shared folders, draining what is there, feeding a table in slices with restarts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The store that timers and several state variables need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def folder(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="recordmill-")
    return f"{base.rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def stateful(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


#: A stream's state is kept in so many partitions at most where there are few cores.
STATE_PARTITIONS = 24


def state_partitions(spark: SparkSession) -> int:
    """Of a new stream's state: two for each core, if ``spark.sql.shuffle.partitions`` names more. Each
    partition opens a state store and a Python worker in each trigger and commits it, which takes about a
    second whatever it holds; what a task has in memory is a bucket, not a partition."""
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(asked, max(STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism))


def started(stream: DataFrame, out: str, mark: str, mode: str = "append", clocked: bool = False):
    """The stream into a Parquet table, over what is there now. A stream with timers on the clock
    (``clocked``) would go on with triggers without data for ever; here it ends with its data, and timers
    that are due fire with the next. A stream that goes on from its checkpoint has the partitions it began with."""
    spark = stream.sparkSession
    names = {"spark.sql.streaming.noDataMicroBatches.enabled": "false" if clocked else None, "spark.sql.shuffle.partitions": str(state_partitions(spark))}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value or before[name])
    try:
        return stream.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that is there now, through a file sink and its checkpoint, as a table."""
    spark = stream.sparkSession
    out, mark = folder(spark, name), folder(spark, f"{name}-checkpoint")
    started(stream, out, mark, mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def fed(rows: DataFrame, slice_of: Column, slices: int, make: Callable[[DataFrame], DataFrame], name: str, repeat: Column | None = None, clocked: bool = False) -> DataFrame:
    """``rows`` written slice by slice (``slice_of``: 0 to slices - 1) and, after each, the stream that
    ``make`` builds on them, started anew from its checkpoint: one slice a trigger, and a restart
    between any two. Rows for which ``repeat`` holds are delivered again with the next slice."""
    spark = rows.sparkSession
    cut, source, out, mark = (folder(spark, f"{name}{x}") for x in ("-cut", "-in", "", "-checkpoint"))
    rows.withColumn("__slice", slice_of.cast("int")).write.partitionBy("__slice").parquet(cut)  # computed once, not for each slice
    schema = rows.schema
    numbered = spark.read.schema(f"{schema.toDDL()}, __slice int").parquet(cut)
    for k in range(slices):
        here = F.col("__slice") == k
        if repeat is not None and k:
            here = here | ((F.col("__slice") == k - 1) & repeat)
        numbered.where(here).drop("__slice").write.parquet(f"{source}/slice-{k}")
        stream = make(spark.readStream.schema(schema).parquet(f"{source}/*"))
        started(stream, out, mark, clocked=clocked).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
