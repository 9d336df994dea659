"""Statistics of runs, streams and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.catalog.base import E, O, STATES, lines_sql, objects, query, state_log, table
from recordmill.catalog.ledgers import _STEPS, chunk_command_columns
from recordmill.functions import sizes
from recordmill.operators import metrics
from recordmill.sources.fixtures import write_fixed
from recordmill.sources.sinks import write_files
from recordmill.streaming.flows import dedupe_stream, enveloped_stream
from recordmill.streaming.ledgers import chunk_stream, state_stream
from recordmill.streaming.runs import drained, fed, folder


@query(f"SELECT state, ms AS p95 FROM (SELECT state, ms, row_number() OVER (PARTITION BY state ORDER BY ms) - 1 AS r, count(*) OVER (PARTITION BY state) AS n FROM {E} WHERE ms IS NOT NULL) WHERE r = CAST(floor((n - 1) * 0.95) AS BIGINT)")
def p95_lower(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.percentile_by_group(state_log(spark, sf), ["state"], "ms", 0.95, "p95")


@query(f"SELECT job_id % 4 AS memory, count(*) AS runs, count(*) FILTER (state = 'FAILED') AS failed, round(median(ms), 6) AS median_ms, max(ms) AS max_ms, round(sum(ms), 4) AS total_ms, round(avg(ms), 6) AS avg_ms FROM {E} GROUP BY 1")
def memory_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rows = state_log(spark, sf).withColumn("memory", F.col("job_id") % 4)
    return rows.groupBy("memory").agg(F.count("*").alias("runs"), F.count_if(F.col("state") == "FAILED").alias("failed"), F.round(F.median("ms"), 6).alias("median_ms"), F.max("ms").alias("max_ms"), F.round(F.sum("ms"), 4).alias("total_ms"), F.round(F.coalesce(F.avg("ms"), F.lit(0.0)), 6).alias("avg_ms"))


_SUMS = f"(SELECT job_id, count(*) AS n, round(max(ms), 6) AS worst FROM {E} GROUP BY job_id)"


@query(f"SELECT job_id, n, worst FROM {_SUMS} WHERE n >= 3 ORDER BY worst, n, job_id LIMIT 1")
def best_candidate(spark: SparkSession, sf: str) -> DataFrame:
    rows = state_log(spark, sf).groupBy("job_id").agg(F.count("*").alias("n"), F.round(F.max("ms"), 6).alias("worst"))
    return metrics.best(rows, F.col("n") >= 3, "worst", "n", "job_id")


@query(f"SELECT event_id, round(CASE WHEN ms - 50 <= 0 THEN 0.0 ELSE 1000 / ((ms - 50) / 1000.0) END, 2) AS per_second FROM {E}")
def throughput(spark: SparkSession, sf: str) -> DataFrame:
    return state_log(spark, sf).select("event_id", F.round(sizes.throughput(F.lit(1000), F.col("ms") - 50), 2).alias("per_second"))


@query(f"SELECT job_id, event_id, state FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY moment DESC, event_id DESC) AS r FROM {E}) WHERE r = 1")
def latest_job_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latest(state_log(spark, sf), ["job_id"], [F.desc("at"), F.desc("event_id")]).select("job_id", "event_id", "state")


_WINDOWS = f"(SELECT epoch_us(moment) // 3600000000 AS h, count(*) AS n FROM {E} WHERE state = 'FAILED' GROUP BY 1 HAVING count(*) > 2)"


@query(f"SELECT a.h AS hour, a.n FROM {_WINDOWS} a JOIN {_WINDOWS} b ON a.h = b.h + 1")
def alarm_windows(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.alarms(state_log(spark, sf), "at", F.col("state") == "FAILED", 2, "1 hour", 2)
    return out.select((F.unix_seconds("window_start") / 3600).cast("long").alias("hour"), "n")


@query("SELECT count(*) AS records, CAST(count(*) * 100 AS BIGINT) AS bytes, '00000001' AS first, lpad(CAST(count(*) AS VARCHAR), 8, '0') AS last FROM orders")
def fixed_file_generate(spark: SparkSession, sf: str) -> DataFrame:
    """As many lines as there are orders, written as files, by their manifest and their content."""
    out = folder(spark, "fixed")
    made = write_fixed(spark, out, table(spark, sf, "orders").count(), 100)
    lines = spark.read.text(out).agg(F.min(F.substring("value", 1, 8)).alias("first"), F.max(F.substring("value", 1, 8)).alias("last"))
    return made.agg(F.sum("records").cast("long").alias("records"), F.sum("size_bytes").cast("long").alias("bytes")).join(F.broadcast(lines))


@query(f"SELECT doc_id, event_id, byte_offset FROM (SELECT l.doc_id, byte_offset, sha256(l.doc_id || '/' || sha256(sha256(bucket || '/' || key || '/' || version_id || '/' || etag || '/' || size) || '/' || byte_offset)) AS event_id FROM {lines_sql(O)} l JOIN {O} o ON l.doc_id = o.doc_id)")
def stream_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a stream of files, drained once."""
    stream = spark.readStream.schema(table(spark, sf, "documents").schema).parquet(f"{sf}/documents.parquet*")
    return drained(enveloped_stream(stream), "envelopes").select("doc_id", "event_id", "byte_offset")


@query(f"SELECT event_id FROM {E}")
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Every event twice, once each after deduplication."""
    stream = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*")
    twice = stream.union(stream).select("event_id", F.col("ts").cast("timestamp").alias("at"))
    return drained(dedupe_stream(twice, "event_id", "at"), "deduped").select("event_id")


@query(f"SELECT job_id, arg_max(state, (moment, event_id)) AS state, count(*) AS events FROM {E} GROUP BY job_id")
def stream_state_machine(spark: SparkSession, sf: str) -> DataFrame:
    """Events in three slices, in no order of time, a third of them twice."""
    log = state_log(spark, sf).select("job_id", "event_id", "at", "state")
    out = fed(log, F.pmod(F.xxhash64("event_id"), F.lit(3)), 3, state_stream, "states", F.col("event_id") % 3 == 0, clocked=True)
    return out.groupBy("job_id").agg(F.max_by("state", "events").alias("state"), F.max("events").alias("events"))


@query(f"WITH RECURSIVE {_STEPS} SELECT event_id, outcome, state, revision FROM p WHERE rn > 0")
def stream_chunk_state(spark: SparkSession, sf: str) -> DataFrame:
    """Commands as a stream in three slices of time, a third of them twice, through the chunks' state
    machine; rows of leases that ran out aside."""
    rows = chunk_command_columns(table(spark, sf, "events"))
    low, high = rows.agg(F.unix_micros(F.min("at")), F.unix_micros(F.max("at"))).first()
    third = F.least(F.floor((F.unix_micros("at") - F.lit(low)) * 3 / F.lit(max(high - low, 1))), F.lit(2))
    out = fed(rows, third, 3, chunk_stream, "chunk-states", F.col("event_id") % 3 == 0)
    return out.where("event_id is not null").select("event_id", "outcome", "state", "revision")


@query(f"SELECT doc_id, ordinal, byte_offset FROM {lines_sql(O)}")
def framed_source_text(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as files, read in tiles of 1000 bytes by the framed source.

    Tasks write the files to a new folder below spark.checkpoint.dir, a thousand to each folder in
    it; the source reads mounted files, so that must be one."""
    from recordmill.sources.framed import FramedFiles

    out = folder(spark, "framed")
    name = F.concat(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    write_files(objects(spark, sf).select(name.alias("name"), "content"), out)
    spark.dataSource.register(FramedFiles)
    rows = spark.read.format("framed_file").option("path", f"{out}/*/*.txt").option("mode", "text").option("targetChunkBytes", "1000").option("partitionBytes", str(4 * 1024 * 1024)).load()
    doc = F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("long")
    number = F.row_number().over(metrics.Window.partitionBy("path").orderBy("byte_offset")) - 1
    return rows.select(doc.alias("doc_id"), number.cast("long").alias("ordinal"), "byte_offset")
