"""The job ledger as an append-only log, and its states as folds over it.

No row is changed: what a conditional write decides elsewhere is decided here by which event came
first, so a repeated delivery changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.functions.identity import completion_id
from recordmill.functions.states import JOB, job_result, terminal
from recordmill.operators.commands import ended


def current(log: DataFrame, key: str = "job_id", state: str = "state", at: str = "at", tie: str = "event_id") -> DataFrame:
    """The last state of each key, when it was reached and how many events led there."""
    return log.groupBy(key).agg(F.max_by(state, F.struct(at, tie)).alias("state"), F.max(at).alias("updated_at"), F.min(at).alias("created_at"), F.count("*").alias("revision"))


def history(log: DataFrame, key: str = "job_id", state: str = "state", at: str = "at", tie: str = "event_id") -> DataFrame:
    steps = F.array_sort(F.collect_list(F.struct(at, tie, state)))
    return log.groupBy(key).agg(F.transform(steps, lambda x: x[state]).alias("history"))


def transitions(log: DataFrame, valid, key: str = "job_id", state: str = "state", at: str = "at", tie: str = "event_id") -> DataFrame:
    """Each event with the state before it and whether it may follow (null for the first)."""
    w = Window.partitionBy(key).orderBy(at, tie)
    rows = log.withColumn("previous", F.lag(state).over(w))
    return rows.withColumn("valid", F.when(F.col("previous").isNotNull(), valid(F.col("previous"), F.col(state))))


def admission(now: DataFrame, at: Column, lease: str = "15 minutes", state: str = "state", since: str = "updated_at") -> DataFrame:
    """What a repeated delivery of a known key is told: alreadyCompleted if it has ended, acquired if
    it waits in an early state whose lease has run out, else busy."""
    early = F.col(state).isin("RECEIVED", "VALIDATING", "PLANNING")
    expired = F.col(since) + F.expr(f"INTERVAL {lease}") < at
    return now.withColumn("admission", F.when(terminal(JOB, F.col(state)), "alreadyCompleted").when(early & expired, "acquired").otherwise("busy")).withColumn("lease_expired", early & expired)


def new_keys(arrivals: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Arrivals that no job is known for yet, once each."""
    return arrivals.join(known.select(key), key, "left_anti").dropDuplicates([key])


def first_completion(results: DataFrame, order: list[str], status: str = "status") -> DataFrame:
    """The first completion of each chunk; later ones count for nothing."""
    w = Window.partitionBy("job_id", "chunk_id").orderBy(*order)
    return results.where(F.col(status) == "COMPLETED").withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def rollup(results: DataFrame, status: str = "status") -> DataFrame:
    """Chunks and counters of each job."""
    done, failed = F.col(status) == "COMPLETED", F.col(status) == "FAILED"
    count = lambda c: F.sum(F.when(done, F.col(c)).otherwise(0)).cast("long")
    return results.groupBy("job_id").agg(F.count("*").alias("chunks"), F.count_if(done).alias("completed"), F.count_if(failed).alias("failed"), count("records_read").alias("records_read"), count("records_rejected").alias("records_rejected"), (count("records_read") - count("records_rejected")).alias("records_published"))


def after_failure(attempt: Column, max_attempts: int = 3) -> Column:
    return F.when(attempt < max_attempts, "RETRY_PENDING").otherwise("FAILED")


def reconcile(manifest: DataFrame, jobs: DataFrame) -> DataFrame:
    """manifest: job_id, expected_chunks, sealed; jobs as from ``rollup``. Status and result of each job of
    the manifest, with its counters; those that have not ended are open, also if nothing came yet."""
    counters = [c for c in jobs.columns if c != "job_id"]
    rows = manifest.join(jobs, "job_id", "left").na.fill(0, counters)
    over = ended(*map(F.col, ("sealed", "completed", "failed", "expected_chunks")))
    status, result = job_result(F.col("failed"), F.col("records_rejected"))
    return rows.withColumn("status", F.when(over, status).otherwise("PROCESSING")).withColumn("result", F.when(over, result))


def completions(reconciled: DataFrame, version: int = 1) -> DataFrame:
    """The outbox: one event for each job that has ended."""
    return reconciled.where("status <> 'PROCESSING'").withColumn("completion_id", completion_id("job_id", F.lit(version)))


def pending(outbox: DataFrame, delivered: DataFrame, key: str = "completion_id") -> DataFrame:
    return outbox.join(delivered.select(key), key, "left_anti")


def unscheduled(manifest: DataFrame, scheduled: DataFrame) -> DataFrame:
    """Chunks of a manifest that a resumed run has still to send."""
    return manifest.join(scheduled.select("job_id", "chunk_id"), ["job_id", "chunk_id"], "left_anti")


def replay(manifest: DataFrame, wanted: DataFrame, new_job: Column) -> DataFrame:
    """The wanted chunks under a new job id, for jobs all of whose wanted chunks are there."""
    found = manifest.join(wanted, ["job_id", "chunk_id"], "left_semi")
    whole = incomplete_replays(manifest, wanted, True)
    return found.join(whole.select("job_id"), "job_id", "left_semi").withColumn("replayed_from", F.col("job_id")).withColumn("job_id", new_job)


def incomplete_replays(manifest: DataFrame, wanted: DataFrame, complete: bool = False) -> DataFrame:
    """Jobs of which wanted chunks are missing (or, if ``complete``, those of which none is)."""
    here = wanted.join(manifest.select("job_id", "chunk_id", F.lit(1).alias("__here")).distinct(), ["job_id", "chunk_id"], "left")
    counts = here.groupBy("job_id").agg(F.count("*").alias("wanted"), F.count("__here").alias("found"))
    return counts.where("wanted = found" if complete else "wanted <> found")


def replay_audit(manifest: DataFrame, wanted: DataFrame, new_job: Column, at: Column, days: int = 90) -> DataFrame:
    """One row for each job that is replayed: where to, which chunks, in order of their ids, and
    until when it is kept. Chunk ids are those that were asked for, so their number is bounded by
    the request."""
    rows = replay(manifest, wanted, new_job).groupBy("replayed_from", F.col("job_id").alias("new_job_id"))
    out = rows.agg(F.sort_array(F.collect_list("chunk_id")).alias("chunk_ids"), F.count("*").alias("chunks"))
    return out.select(F.col("replayed_from").alias("source_job_id"), "new_job_id", "chunk_ids", "chunks", at.alias("created_at"), (F.unix_seconds(at) + days * 86_400).alias("expires_at"))


def in_order(chunks: DataFrame) -> DataFrame:
    """Chunks with their position in their job, by chunk id: the order to send them in."""
    return chunks.withColumn("position", F.row_number().over(Window.partitionBy("job_id").orderBy("chunk_id")))


def confirmed(sent: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """What was sent and did not fail."""
    return sent.join(failed.select(*keys), keys, "left_anti")


def deliveries(messages: DataFrame, batch: list[str], logical: str = "logical_events") -> DataFrame:
    """Calls, messages and logical events; a message that does not say how many it holds is one."""
    return messages.groupBy(*batch).agg(F.count("*").alias("messages"), F.sum(F.coalesce(F.nullif(logical, F.lit(0)), F.lit(1))).cast("long").alias("logical_events"))


def unexpired(rows: DataFrame, now: Column, expires: str = "expires_at") -> DataFrame:
    return rows.where(F.col(expires) > F.unix_timestamp(now))


def sealed_once(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks once each, and those planned twice with different ranges."""
    ranges = manifest.groupBy("job_id", "chunk_id").agg(F.min(F.struct("start_byte", "end_byte")).alias("a"), F.max(F.struct("start_byte", "end_byte")).alias("b"))
    return manifest.dropDuplicates(["job_id", "chunk_id"]), ranges.where("a <> b").select("job_id", "chunk_id")
