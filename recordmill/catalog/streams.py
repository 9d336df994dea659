"""Streams over the tables, each fed in slices with a restart between any two."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordmill.catalog.base import E, L, O, objects, query, results, state_log, table
from recordmill.operators import commands
from recordmill.sources.messages import MessageQueue, deliver
from recordmill.streaming.ledgers import admission_stream, alarm_stream, completion_stream, gap_stream
from recordmill.streaming.redelivery import enqueue, settled
from recordmill.streaming.runs import fed, folder

SLICES = 3
LEASE_US = 36 * 3600 * 1_000_000

# ---- admission

_ADMIT_KIND = "CASE event_type WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'VALIDATING' ELSE 'PLANNING' END WHEN 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'FAILED' ELSE 'PROCESSING' END WHEN 'purchase' THEN 'COMPLETED' ELSE 'deliver' END"
_ADMIT = f"(SELECT user_id * 1000 + event_id % 7 AS file_id, event_id, epoch_us(CAST(ts AS TIMESTAMP)) AS us, {_ADMIT_KIND} AS kind FROM events)"
_EARLY = "('RECEIVED', 'VALIDATING', 'PLANNING')"
_MAY = "((state = 'RECEIVED' AND kind IN ('VALIDATING', 'FAILED')) OR (state = 'VALIDATING' AND kind IN ('PLANNING', 'FAILED')) OR (state = 'PLANNING' AND kind IN ('PROCESSING', 'COMPLETED', 'FAILED')) OR (state = 'PROCESSING' AND kind IN ('COMPLETED', 'FAILED')))"
_ADMISSION = f"""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY us, event_id) AS rn FROM {_ADMIT}
), p AS (
  SELECT DISTINCT file_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS state, CAST(0 AS BIGINT) AS lease, 0 AS revision, CAST(NULL AS BIGINT) AS owner FROM e
  UNION ALL
  SELECT file_id, rn, event_id, outcome, CASE WHEN outcome = 'applied' THEN kind WHEN outcome = 'acquired' AND state IS NULL THEN 'RECEIVED' ELSE state END, CASE WHEN outcome = 'acquired' THEN us + {LEASE_US} ELSE lease END,
    CASE WHEN outcome = 'applied' OR (outcome = 'acquired' AND state IS NOT NULL) THEN revision + 1 ELSE revision END, CASE WHEN outcome = 'acquired' THEN event_id ELSE owner END
  FROM (SELECT e.*, p.state, p.lease, p.revision, p.owner, CASE WHEN e.kind = 'deliver' THEN CASE WHEN p.state IS NULL THEN 'acquired' WHEN p.state IN ('COMPLETED', 'FAILED') THEN 'alreadyCompleted' WHEN p.state IN {_EARLY} AND p.lease <= e.us THEN 'acquired' ELSE 'busy' END
      WHEN p.state IS NULL THEN 'unknown' WHEN {_MAY.replace('state', 'p.state').replace('kind', 'e.kind')} THEN 'applied' WHEN p.state = e.kind THEN 'unchanged' ELSE 'conflict' END AS outcome FROM p JOIN e ON p.file_id = e.file_id AND e.rn = p.rn + 1))
SELECT file_id, event_id, outcome, state, revision, coalesce(owner, -1) AS owner FROM p WHERE rn > 0"""


def _admissions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as deliveries of files, and as the steps of their jobs."""
    n, t = F.col("event_id"), F.col("event_type")
    kind = F.when(t == "click", F.when(n % 2 == 0, "VALIDATING").otherwise("PLANNING")).when(t == "error", F.when(n % 3 == 0, "FAILED").otherwise("PROCESSING")).when(t == "purchase", "COMPLETED").otherwise("deliver")
    return table(spark, sf, "events").select((F.col("user_id") * 1000 + n % 7).alias("file_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"), n.cast("long").alias("event_id"), kind.alias("kind"))


def in_time(rows: DataFrame, at_us: str, slices: int = SLICES):
    """The slice of each row by its time: spans of equal length."""
    low, high = rows.agg(F.min(at_us), F.max(at_us)).first()
    return F.least(F.floor((F.col(at_us) - F.lit(low or 0)) * slices / F.lit(max((high or 0) - (low or 0), 1))), F.lit(slices - 1))


@query(_ADMISSION)
def admission_commands(spark: SparkSession, sf: str) -> DataFrame:
    return commands.admission_log(_admissions(spark, sf), LEASE_US).select("file_id", "event_id", "outcome", "state", "revision", F.coalesce("owner", F.lit(-1)).alias("owner"))


@query(_ADMISSION)
def stream_admission(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows as a stream; a third of the deliveries comes again a slice later."""
    rows = _admissions(spark, sf)
    out = fed(rows, in_time(rows, "at_us"), SLICES, lambda s: admission_stream(s, LEASE_US), "admission", F.col("event_id") % 3 == 0, clocked=True)
    return out.where("event_id is not null").withColumn("owner", F.coalesce("owner", F.lit(-1)))


# ---- completion

_ENDS = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id, number % 3 ORDER BY number) AS r FROM {L} WHERE status IN ('COMPLETED', 'FAILED')) WHERE r = 1)"
_PLANS = f"(SELECT job_id, count(DISTINCT number % 3) + CASE WHEN job_id % 7 = 0 THEN 1 ELSE 0 END AS expected_chunks, job_id % 5 <> 0 AS sealed FROM {L} GROUP BY job_id)"


@query(f"""SELECT job_id, CAST(expected_chunks AS BIGINT) AS expected_chunks, completed, failed, records_read, records_published, records_rejected, CASE WHEN failed > 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  CASE WHEN failed > 0 THEN NULL WHEN records_rejected > 0 THEN 'WITH_REJECTIONS' ELSE 'SUCCESS' END AS result, sha256(job_id || '/completion/1') AS completion_id
  FROM (SELECT p.job_id, any_value(expected_chunks) AS expected_chunks, count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'FAILED') AS failed, CAST(coalesce(sum(records_read) FILTER (status = 'COMPLETED'), 0) AS BIGINT) AS records_read,
    CAST(coalesce(sum(records_read - records_rejected) FILTER (status = 'COMPLETED'), 0) AS BIGINT) AS records_published, CAST(coalesce(sum(records_rejected) FILTER (status = 'COMPLETED'), 0) AS BIGINT) AS records_rejected
  FROM {_PLANS} p JOIN {_ENDS} e ON p.job_id = e.job_id WHERE sealed GROUP BY p.job_id) WHERE completed + failed >= expected_chunks""")
def stream_completion_intents(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as results of three chunks a job, which so end several times, and the jobs' manifests;
    all of it delivered twice."""
    lines = results(spark, sf).select("job_id", (F.col("number") % 3).cast("string").alias("chunk_id"), F.col("number").alias("ordinal"), "status", "records_read", (F.col("records_read") - F.col("records_rejected")).alias("records_published"), "records_rejected", F.lit(0).cast("long").alias("records_ignored"))
    chunks = F.size(F.collect_set("chunk_id").over(Window.partitionBy("job_id")))
    # a job's manifest comes out of the same pass, behind its first line
    both = lines.select("*", chunks.alias("chunks"), F.explode(F.when(F.col("ordinal") == 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("plan"))
    own = [F.when(~F.col("plan"), F.col(c)).alias(c) for c in lines.columns[1:]]
    expected = (F.col("chunks") + F.when(F.col("job_id") % 7 == 0, 1).otherwise(0)).cast("long")
    rows = both.select("job_id", *own, F.when(F.col("plan"), expected).alias("expected_chunks"), F.when(F.col("plan"), F.col("job_id") % 5 != 0).alias("sealed"))
    slices = F.when(F.col("chunk_id").isNull(), F.col("job_id") % SLICES).otherwise(F.least(F.floor((F.col("ordinal") - 1) / 2), F.lit(SLICES - 1)))
    make = lambda s: completion_stream(s.where("chunk_id is not null"), s.where("chunk_id is null"))
    return fed(rows, slices, SLICES, make, "intents", F.lit(True), clocked=True).drop("records_ignored")


# ---- publishing

MOST = 2000


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as messages, of which long ones are refused."""
    return objects(spark, sf).select(F.concat(F.lit("m"), F.col("doc_id").cast("string")).alias("message_id"), F.coalesce("content", F.lit("")).alias("body"))


_REFUSED = f"CASE WHEN strlen(body) + 64 > {MOST} THEN 'BatchRequestTooLong' WHEN regexp_matches(body, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]') THEN 'InvalidMessageContents' END"
_SENT = f"(SELECT message_id, body, {_REFUSED} AS code FROM (SELECT 'm' || doc_id AS message_id, coalesce(content, '') AS body FROM {O}))"


@query(f"SELECT message_id, code, CASE WHEN code IS NULL THEN md5(body) END AS body_md5 FROM {_SENT}")
def published_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages through the queue sink as a stream with a restart, and its failures as rows."""
    spark.dataSource.register(MessageQueue)
    source, out, mark = folder(spark, "messages-in"), folder(spark, "messages"), folder(spark, "messages-checkpoint")
    rows = _bodies(spark, sf)
    for k in range(2):
        rows.where(F.pmod(F.xxhash64("message_id"), F.lit(2)) == k).write.parquet(f"{source}/{k}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{source}/*")
        stream.writeStream.format("message_queue").option("path", out).option("maxMessageBytes", str(MOST)).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    read = spark.read.format("message_queue").option("path", out)
    taken = read.load().select("message_id", F.lit(None).cast("string").alias("code"), F.md5(F.col("body").cast("binary")).alias("body_md5"))
    failed = spark.read.format("message_queue").option("path", out).option("failures", "true").load()
    return taken.unionByName(failed.select("message_id", "code", F.lit(None).cast("string").alias("body_md5")))


@query(f"SELECT sha256(job_id || '/completion/1') AS message_id, CAST(1 AS BIGINT) AS copies FROM (SELECT job_id FROM {L} GROUP BY job_id HAVING count(*) FILTER (status = 'RETRY_PENDING') = 0)")
def delivered_completions(spark: SparkSession, sf: str) -> DataFrame:
    """The outbox of ended jobs, delivered three times: half of it, then all, then all again."""
    from recordmill.functions.identity import completion_id

    ended = results(spark, sf).groupBy("job_id").agg(F.count_if(F.col("status") == "RETRY_PENDING").alias("open")).where("open = 0")
    outbox = ended.select(completion_id("job_id", F.lit(1)).alias("message_id"), F.to_json(F.struct("job_id")).alias("body"))
    out = folder(spark, "completions")
    for part in (outbox.where("substring(message_id, 1, 1) < '8'"), outbox, outbox):
        deliver(part, out)
    return spark.read.format("message_queue").option("path", out).load().groupBy("message_id").agg(F.count("*").alias("copies"))


# ---- redelivery


@query(f"""SELECT message_id, CASE WHEN n % 7 = 0 THEN 'dead' ELSE 'done' END AS ended, CAST(CASE WHEN n % 7 = 0 THEN 3 WHEN n % 5 = 0 THEN 2 ELSE 1 END AS INTEGER) AS receive_count, CASE WHEN n % 7 = 0 THEN 'size ' || n END AS error, md5(body) AS body_md5
  FROM (SELECT 'm' || doc_id AS message_id, coalesce(content, '') AS body, strlen(coalesce(content, '')) AS n FROM {O})""")
def redelivered_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as messages: some sizes always fail, some the first time only."""
    queue, done, dead, mark = (folder(spark, f"queue{x}") for x in ("", "-done", "-dead", "-checkpoint"))
    enqueue(_bodies(spark, sf), queue)
    n = F.octet_length("body")

    def handler(batch: DataFrame) -> DataFrame:
        wrong = (n % 7 == 0) | ((n % 5 == 0) & (F.col("receive_count") < 2))
        return batch.where(wrong).select("message_id", F.concat(F.lit("size "), n.cast("string")).alias("error"))

    good, bad = settled(spark, queue, done, dead, mark, handler)
    both = good.withColumn("error", F.lit(None).cast("string")).withColumn("ended", F.lit("done")).unionByName(bad.withColumn("ended", F.lit("dead")))
    return both.select("message_id", "ended", "receive_count", "error", F.md5(F.col("body").cast("binary")).alias("body_md5"))


# ---- gaps and alarms

_SEEN = f"(SELECT job_id, number, CASE WHEN number <= 2 THEN 1 WHEN number <= 4 THEN 2 ELSE 3 END AS slice FROM {L} WHERE number % 3 <> 2)"


@query(f"""WITH s AS (SELECT job_id, t.slice, max(number) AS top FROM {_SEEN} a JOIN (SELECT unnest([1, 2, 3]) AS slice) t ON a.slice <= t.slice GROUP BY 1, 2 HAVING max(a.slice) = t.slice
), r AS (SELECT job_id, slice, unnest(range(1, top + 1)) AS o FROM s
), m AS (SELECT r.job_id, r.slice, string_agg(CAST(o AS VARCHAR), ',' ORDER BY o) AS missing, count(*) AS n FROM r LEFT JOIN {_SEEN} x ON x.job_id = r.job_id AND x.number = r.o AND x.slice <= r.slice WHERE x.number IS NULL GROUP BY 1, 2)
SELECT s.job_id, CAST(row_number() OVER (PARTITION BY s.job_id ORDER BY s.slice) AS INTEGER) AS trigger, coalesce(n, 0) AS n_missing, coalesce(missing, '') AS missing FROM s LEFT JOIN m ON s.job_id = m.job_id AND s.slice = m.slice""")
def stream_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Line numbers of an order, of which each third is lacking, in three slices."""
    rows = results(spark, sf).where("number % 3 <> 2").select("job_id", "number")
    slices = F.when(F.col("number") <= 2, 0).when(F.col("number") <= 4, 1).otherwise(2)
    out = fed(rows, slices, SLICES, lambda s: gap_stream(s, "job_id", "number", 1, 10), "gaps")
    return out.select(F.col("group").alias("job_id"), "trigger", "n_missing", F.array_join("missing", ",").alias("missing"))


_HOURS = f"(SELECT epoch_us(moment) // 3600000000 AS h, count(*) AS n FROM {E} WHERE state = 'FAILED' GROUP BY 1 HAVING count(*) > 2)"


@query(f"SELECT a.h AS hour, a.n FROM {_HOURS} a JOIN {_HOURS} b ON a.h = b.h + 1")
def stream_alarms(spark: SparkSession, sf: str) -> DataFrame:
    """The alarms of alarm_windows as a stream. A last event a month on closes its windows."""
    log = state_log(spark, sf).select("at", "state")
    last = log.agg((F.max("at") + F.expr("INTERVAL 31 DAYS")).alias("at")).select("at", F.lit("TICK").alias("state"))
    rows = log.union(last).withColumn("us", F.unix_micros("at"))
    slices = F.when(F.col("state") == "TICK", SLICES - 1).otherwise(in_time(rows.where("state <> 'TICK'"), "us"))
    out = fed(rows, slices, SLICES, lambda s: alarm_stream(s, "at", F.col("state") == "FAILED", 2, "1 hour", 2), "alarms")
    return out.select((F.unix_seconds("window_start") / 3600).cast("long").alias("hour"), "n")

