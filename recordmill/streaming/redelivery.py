"""Messages that are tried again until they succeed or have been received too often.

A queue is a folder of Parquet messages; each carries the number of times it was received. A trigger
receives what is new, a handler says which messages failed and why, and those go back to the queue, or,
received for the last time, to the dead letters. What a trigger decides is published once: a batch
that runs again after a crash finds its results there and writes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RECEIVES = 3
MESSAGE = "message_id string, body string, receive_count int"


def publish_once(df: DataFrame, path: str) -> bool:
    """The rows as a Parquet folder that appears whole or not at all; false if it is there already."""
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        return False
    staged = jvm.Path(target.getParent(), f"_staged-{uuid.uuid4().hex}")
    df.write.parquet(staged.toString())
    if not fs.rename(staged, target):
        raise OSError(f"{path} could not be published")
    return True


def enqueue(messages: DataFrame, queue: str, name: str = "first") -> bool:
    """message_id, body -> new messages in the queue, once by name."""
    return publish_once(messages.select(F.col("message_id").cast("string").alias("message_id"), "body", F.lit(0).alias("receive_count")), f"{queue}/{name}")


def received(spark: SparkSession, queue: str) -> DataFrame:
    """The queue as a stream of deliveries; receive_count includes this one."""
    return spark.readStream.schema(MESSAGE).parquet(f"{queue}/*").withColumn("receive_count", F.col("receive_count") + 1)


def redelivered(spark: SparkSession, queue: str, done: str, dead: str, mark: str, handler: Callable[[DataFrame], DataFrame], max_receives: int = MAX_RECEIVES):
    """Starts the loop's stream over what is in the queue now. ``handler`` takes message_id, body,
    receive_count and returns message_id, error for the messages that failed, which may be some of a
    batch; the others are done. done: message_id, body, receive_count; dead: the same and error.

    A message that the handler names twice has failed once, with the least of its errors."""

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        failed = handler(batch).groupBy("message_id").agg(F.min("error").alias("error"))
        judged = batch.join(failed, "message_id", "left").persist()
        wrong = F.col("error").isNotNull()
        again = wrong & (F.col("receive_count") < max_receives)
        publish_once(judged.where(~wrong).drop("error"), f"{done}/batch={number}")
        publish_once(judged.where(wrong & ~again), f"{dead}/batch={number}")
        back = judged.where(again).drop("error")
        if not back.isEmpty():
            publish_once(back, f"{queue}/retry-{number}")
        judged.unpersist()
        batch.unpersist()

    return received(spark, queue).writeStream.foreachBatch(each).option("checkpointLocation", mark).trigger(availableNow=True).start()


def settled(spark: SparkSession, queue: str, done: str, dead: str, mark: str, handler: Callable[[DataFrame], DataFrame], max_receives: int = MAX_RECEIVES) -> tuple[DataFrame, DataFrame]:
    """Runs the loop until nothing comes back: a message is received ``max_receives`` times at most, so
    as many runs are enough for what is in the queue. The done and the dead letters."""
    for _ in range(max_receives):
        redelivered(spark, queue, done, dead, mark, handler, max_receives).awaitTermination()
    read = lambda path, more="": spark.read.schema(MESSAGE + more).parquet(path).drop("batch")
    return read(done), read(dead, ", error string")
