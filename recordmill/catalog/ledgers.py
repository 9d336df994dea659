"""Counters, ledger folds and operational queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.catalog.base import CURRENT, E, L, query, results, state_log, table
from recordmill.functions.identity import completion_id
from recordmill.functions.states import JOB, can_transition
from recordmill.operators import commands, ledger, ops, quality

NOW = "2024-06-30 00:00:00"
_FIRST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id, number % 3 ORDER BY number) AS r FROM {L} WHERE status = 'COMPLETED') WHERE r = 1)"
_ROLLUP = f"(SELECT job_id, count(*) AS chunks, count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'FAILED') AS failed, CAST(coalesce(sum(records_read) FILTER (status = 'COMPLETED'), 0) AS BIGINT) AS records_read, CAST(coalesce(sum(records_rejected) FILTER (status = 'COMPLETED'), 0) AS BIGINT) AS records_rejected FROM {L} GROUP BY job_id)"
_SEALED = f"(SELECT job_id, count(*) + CASE WHEN job_id % 7 = 0 THEN 1 ELSE 0 END AS expected, job_id % 5 <> 0 AS sealed FROM {L} GROUP BY job_id)"
_OVER = "sealed AND completed + failed >= expected"
_DONE = f"(SELECT r.*, CASE WHEN {_OVER} THEN CASE WHEN failed > 0 THEN 'FAILED' ELSE 'COMPLETED' END ELSE 'PROCESSING' END AS status, CASE WHEN {_OVER} AND failed = 0 THEN CASE WHEN records_rejected > 0 THEN 'WITH_REJECTIONS' ELSE 'SUCCESS' END END AS result FROM {_ROLLUP} r JOIN {_SEALED} m ON r.job_id = m.job_id)"


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


@query(f"SELECT job_id, chunk_id, records_read, records_read - records_rejected AS records_published, CAST(records_rejected AS BIGINT) AS records_rejected FROM {L}")
def chunk_counters(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).select("job_id", "chunk_id", "records_read", (F.col("records_read") - F.col("records_rejected")).alias("records_published"), "records_rejected")


@query(f"SELECT CASE WHEN records_read > 40 THEN 'OVERSIZED_RECORD' ELSE 'INVALID_UTF8' END AS reason, count(*) AS n FROM {L} WHERE records_rejected > 0 GROUP BY 1")
def reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    rows = results(spark, sf).where("records_rejected > 0")
    return quality.reasons(rows.select(F.when(F.col("records_read") > 40, "OVERSIZED_RECORD").otherwise("INVALID_UTF8").alias("reason")))


@query(f"SELECT job_id, chunks, completed, failed, records_read, records_rejected, records_read - records_rejected AS records_published FROM {_ROLLUP}")
def job_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.rollup(results(spark, sf))


def _retried(spark: SparkSession, sf: str) -> DataFrame:
    """Results as deliveries of three chunks per job, so that completions repeat."""
    return results(spark, sf).withColumn("chunk_id", (F.col("number") % 3).cast("string"))


@query(f"SELECT job_id, count(*) AS completed, CAST(sum(records_read) AS BIGINT) AS records_read FROM {_FIRST} GROUP BY job_id")
def rollup_dedup_retry(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.first_completion(_retried(spark, sf), ["number"]).groupBy("job_id").agg(F.count("*").alias("completed"), F.sum("records_read").cast("long").alias("records_read"))


@query(f"SELECT job_id, chunk_id, attempt, CASE WHEN attempt < 3 THEN 'RETRY_PENDING' ELSE 'FAILED' END AS next_state FROM {L} WHERE status = 'FAILED'")
def retry_policy(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).where("status = 'FAILED'").select("job_id", "chunk_id", "attempt", ledger.after_failure(F.col("attempt"), 3).alias("next_state"))


def _ended(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs by their manifests: every seventh waits for a chunk more, every fifth is not sealed."""
    chunks = results(spark, sf)
    plans = chunks.groupBy("job_id").agg((F.count("*") + F.when(F.col("job_id") % 7 == 0, 1).otherwise(0)).alias("expected_chunks")).withColumn("sealed", F.col("job_id") % 5 != 0)
    return ledger.reconcile(plans, ledger.rollup(chunks))


@query(f"SELECT job_id, status, result FROM {_DONE}")
def job_terminal_status(spark: SparkSession, sf: str) -> DataFrame:
    return _ended(spark, sf).select("job_id", "status", "result")


@query(f"SELECT job_id, status, result, sha256(job_id || '/completion/1') AS completion_id FROM {_DONE} WHERE status <> 'PROCESSING'")
def completion_events(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.completions(_ended(spark, sf)).select("job_id", "status", "result", "completion_id")


@query(f"SELECT job_id, sha256(job_id || '/completion/1') AS completion_id FROM {_DONE} WHERE status <> 'PROCESSING' AND job_id % 3 <> 0")
def outbox_pending(spark: SparkSession, sf: str) -> DataFrame:
    outbox = ledger.completions(_ended(spark, sf))
    delivered = results(spark, sf).where("job_id % 3 = 0").select(completion_id("job_id", F.lit(1)).alias("completion_id"))
    return ledger.pending(outbox, delivered).select("job_id", "completion_id")


@query(f"SELECT job_id, chunk_id FROM {L} WHERE number % 2 = 1")
def resume_unscheduled(spark: SparkSession, sf: str) -> DataFrame:
    manifest = results(spark, sf)
    return ledger.unscheduled(manifest, manifest.where("number % 2 = 0")).select("job_id", "chunk_id")


def _wanted(spark: SparkSession, sf: str) -> DataFrame:
    """Second chunks of all jobs, and chunks that no job has of every fifth."""
    jobs = results(spark, sf).select("job_id").distinct()
    return jobs.select("job_id", F.lit("00000002").alias("chunk_id")).union(jobs.where("job_id % 5 = 0").select("job_id", F.lit("99999999")))


@query(f"SELECT 'replay-' || job_id AS job_id, chunk_id, job_id AS replayed_from FROM {L} WHERE number = 2 AND job_id % 5 <> 0")
def replay_selected(spark: SparkSession, sf: str) -> DataFrame:
    out = ledger.replay(results(spark, sf), _wanted(spark, sf), F.concat(F.lit("replay-"), F.col("job_id").cast("string")))
    return out.select("job_id", "chunk_id", "replayed_from")


@query(f"SELECT job_id, CAST(CASE WHEN job_id % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS wanted, CAST(CASE WHEN max(number) >= 2 THEN 1 ELSE 0 END AS BIGINT) AS found FROM {L} GROUP BY job_id HAVING job_id % 5 = 0 OR max(number) < 2")
def replay_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.incomplete_replays(results(spark, sf), _wanted(spark, sf))


_VALID = " OR ".join(f"(previous = '{a}' AND state IN ({', '.join(repr(x) for x in b)}))" for a, b in JOB.items() if b)


@query(f"SELECT job_id, event_id, previous, state, CASE WHEN previous IS NOT NULL THEN {_VALID} END AS valid FROM (SELECT *, lag(state) OVER (PARTITION BY job_id ORDER BY moment, event_id) AS previous FROM {E})")
def transition_validity(spark: SparkSession, sf: str) -> DataFrame:
    out = ledger.transitions(state_log(spark, sf), lambda a, b: can_transition(JOB, a, b))
    return out.select("job_id", "event_id", "previous", "state", "valid")


@query(f"SELECT job_id, state, epoch_us(updated_at) AS updated_us, revision FROM {CURRENT}")
def current_state(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.current(state_log(spark, sf)).select("job_id", "state", F.unix_micros("updated_at").alias("updated_us"), "revision")


@query(f"SELECT job_id, string_agg(state, '>' ORDER BY moment, event_id) AS history FROM {E} GROUP BY job_id")
def history_array(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.history(state_log(spark, sf)).select("job_id", F.array_join("history", ">").alias("history"))


@query(f"SELECT job_id, CASE WHEN state IN ('COMPLETED', 'FAILED') THEN 'alreadyCompleted' WHEN updated_at + INTERVAL 15 MINUTE < TIMESTAMP '{NOW}' THEN 'acquired' ELSE 'busy' END AS admission FROM {CURRENT}")
def admission(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.admission(ledger.current(state_log(spark, sf)), _now()).select("job_id", "admission")


@query(f"SELECT job_id, (state IN ('RECEIVED', 'VALIDATING', 'PLANNING') AND updated_at + INTERVAL 36 HOUR < TIMESTAMP '{NOW}') AS lease_expired FROM {CURRENT}")
def lease_expired(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.admission(ledger.current(state_log(spark, sf)), _now(), "36 hours").select("job_id", "lease_expired")


_AFTER, _BEFORE = "2024-01-02 00:00:00", "2024-12-01 00:00:00"


@query(f"SELECT job_id, epoch_us(updated_at) AS updated_us FROM {CURRENT} WHERE state = 'PLANNING' AND updated_at BETWEEN TIMESTAMP '{_AFTER}' AND TIMESTAMP '{_BEFORE}' ORDER BY updated_at, job_id LIMIT 20")
def jobs_by_status(spark: SparkSession, sf: str) -> DataFrame:
    jobs = ledger.current(state_log(spark, sf))
    return ops.by_status(jobs, "PLANNING", F.lit(_AFTER).cast("timestamp"), F.lit(_BEFORE).cast("timestamp"), 20).select("job_id", F.unix_micros("updated_at").alias("updated_us"))


@query(f"SELECT job_id, epoch_us(updated_at) AS updated_us FROM {CURRENT} WHERE state = 'VALIDATING' AND updated_at < TIMESTAMP '{_BEFORE}' ORDER BY updated_at, job_id LIMIT 20")
def jobs_by_status_before_only(spark: SparkSession, sf: str) -> DataFrame:
    jobs = ledger.current(state_log(spark, sf))
    return ops.by_status(jobs, "VALIDATING", None, F.lit(_BEFORE).cast("timestamp"), 20).select("job_id", F.unix_micros("updated_at").alias("updated_us"))


@query(f"SELECT job_id, state, CAST(floor(epoch(TIMESTAMP '{NOW}')) - floor(epoch(updated_at)) AS BIGINT) AS stuck_seconds FROM {CURRENT} WHERE state IN ('RECEIVED', 'VALIDATING', 'PLANNING', 'PROCESSING') AND updated_at < TIMESTAMP '{NOW}' - INTERVAL 1 HOUR ORDER BY updated_at, job_id LIMIT 25")
def stuck_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return ops.stuck(ledger.current(state_log(spark, sf)), _now(), "1 hour", 25).select("job_id", "state", "stuck_seconds")


@query(f"SELECT 'receipt-' || event_id AS receipt_id, c.job_id, c.state FROM {E} e JOIN {CURRENT} c ON e.job_id = c.job_id WHERE e.state = 'RECEIVED'")
def job_by_receipt(spark: SparkSession, sf: str) -> DataFrame:
    log = state_log(spark, sf)
    receipts = log.where("state = 'RECEIVED'").select(F.concat(F.lit("receipt-"), F.col("event_id").cast("string")).alias("receipt_id"), "job_id")
    return ops.by_receipt(ledger.current(log), receipts).select("receipt_id", "job_id", "state")


@query(f"SELECT event_id, CAST(2 AS BIGINT) AS n FROM {E} WHERE event_id % 10 = 0")
def duplicate_events(spark: SparkSession, sf: str) -> DataFrame:
    log = state_log(spark, sf)
    return quality.duplicates(log.union(log.where("event_id % 10 = 0")))


@query(f"WITH s AS (SELECT job_id, number FROM {L} WHERE number % 3 <> 2), r AS (SELECT job_id, unnest(range(1, max(number) + 1)) AS o FROM s GROUP BY job_id), m AS (SELECT r.job_id, o, row_number() OVER (PARTITION BY r.job_id ORDER BY o) AS k FROM r LEFT JOIN s ON r.job_id = s.job_id AND r.o = s.number WHERE s.number IS NULL) SELECT job_id, CAST(o AS BIGINT) AS missing FROM m WHERE k <= 10")
def ordinal_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gaps(results(spark, sf).where("number % 3 <> 2"), "job_id", "number", 1, 10)


@query(f"SELECT job_id, chunk_id FROM {L} WHERE number % 11 = 0")
def count_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """One chunk in eleven counts a record too many."""
    off = F.when(F.col("number") % 11 == 0, 1).otherwise(0)
    rows = results(spark, sf).withColumn("records_published", F.col("records_read") - F.col("records_rejected") + off).withColumn("records_ignored", F.lit(0))
    return quality.violations(rows).select("job_id", "chunk_id")


@query(f"SELECT job_id, chunks, completed FROM {_ROLLUP} WHERE completed < chunks")
def ledger_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unreconciled(ledger.rollup(results(spark, sf))).select("job_id", "chunks", "completed")


# ---- commands

_KIND = "CASE event_type WHEN 'signup' THEN 'acquire' WHEN 'view' THEN 'start' WHEN 'click' THEN 'fail' WHEN 'purchase' THEN 'complete' ELSE 'fail' END"
_CHUNK_EVENTS = f"(SELECT user_id AS job_id, CAST(event_id % 2 AS VARCHAR) AS chunk_id, CAST(ts AS TIMESTAMP) AS moment, event_id, {_KIND} AS kind, CAST(1 + event_id % 3 AS INTEGER) AS attempt, CAST(event_id % 100 AS BIGINT) AS offered FROM events)"


def chunk_commands(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_command_columns(table(spark, sf, "events"))


def chunk_command_columns(events: DataFrame) -> DataFrame:
    """Events as commands on two chunks of each job."""
    kind = F.when(F.col("event_type") == "signup", "acquire").when(F.col("event_type") == "view", "start").when(F.col("event_type") == "purchase", "complete").otherwise("fail")
    return events.select(F.col("user_id").alias("job_id"), (F.col("event_id") % 2).cast("string").alias("chunk_id"), F.col("ts").cast("timestamp").alias("at"), "event_id", kind.alias("kind"), (F.col("event_id") % 3 + 1).cast("int").alias("attempt"), (F.col("event_id") % 100).cast("long").alias("records"))


_SAME = "p.state = 'RUNNING' AND p.attempt = e.attempt"
_OUTCOME = f"""CASE e.kind WHEN 'acquire' THEN CASE WHEN p.state = 'PENDING' THEN 'applied' WHEN p.state IN ('COMPLETED', 'FAILED') THEN 'alreadyCompleted' ELSE 'busy' END
    WHEN 'start' THEN CASE WHEN p.state IN ('PENDING', 'RETRY_PENDING') THEN 'applied' WHEN p.state = 'COMPLETED' THEN 'alreadyCompleted' ELSE 'conflict' END
    WHEN 'complete' THEN CASE WHEN {_SAME} THEN 'applied' WHEN p.state = 'COMPLETED' THEN 'unchanged' ELSE 'conflict' END
    ELSE CASE WHEN {_SAME} THEN 'applied' WHEN p.state IN ('COMPLETED', 'FAILED') THEN 'unchanged' ELSE 'conflict' END END"""
_STEPS = f"""e AS (SELECT *, row_number() OVER (PARTITION BY job_id, chunk_id ORDER BY moment, event_id) AS rn FROM {_CHUNK_EVENTS}
), p AS (
  SELECT DISTINCT job_id, chunk_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS outcome, 'PENDING' AS state, 0 AS attempt, 0 AS revision, CAST(0 AS BIGINT) AS records FROM e
  UNION ALL
  SELECT job_id, chunk_id, rn, event_id, outcome, CASE WHEN outcome <> 'applied' THEN state WHEN kind IN ('acquire', 'start') THEN 'RUNNING' WHEN kind = 'complete' THEN 'COMPLETED' WHEN asked < 3 THEN 'RETRY_PENDING' ELSE 'FAILED' END,
    CASE WHEN outcome = 'applied' AND kind = 'acquire' THEN attempt + 1 WHEN outcome = 'applied' AND kind = 'start' THEN asked ELSE attempt END, CASE WHEN outcome = 'applied' THEN revision + 1 ELSE revision END, CASE WHEN outcome = 'applied' AND kind = 'complete' THEN offered ELSE records END
  FROM (SELECT e.job_id, e.chunk_id, e.rn, e.event_id, e.kind, e.attempt AS asked, e.offered, p.state, p.attempt, p.revision, p.records, {_OUTCOME} AS outcome FROM p JOIN e ON p.job_id = e.job_id AND p.chunk_id = e.chunk_id AND e.rn = p.rn + 1)
), s AS (
  SELECT job_id, chunk_id, arg_max(state, rn) AS state, arg_max(revision, rn) AS revision, arg_max(records, rn) AS records, count(*) FILTER (outcome = 'conflict') AS conflicts FROM p GROUP BY 1, 2
)"""


@query(f"WITH RECURSIVE {_STEPS} SELECT event_id, outcome, state, revision FROM p WHERE rn > 0")
def chunk_command_log(spark: SparkSession, sf: str) -> DataFrame:
    return commands.chunk_log(chunk_commands(spark, sf)).select("event_id", "outcome", "state", "revision")


@query(f"WITH RECURSIVE {_STEPS} SELECT * FROM s")
def chunk_state(spark: SparkSession, sf: str) -> DataFrame:
    return commands.chunk_states(commands.chunk_log(chunk_commands(spark, sf)))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Three chunks for every fourth job, two for the others; every fifth is not sealed."""
    jobs = table(spark, sf, "events").select(F.col("user_id").alias("job_id")).distinct()
    return jobs.select("job_id", F.when(F.col("job_id") % 4 == 0, 3).when(F.col("job_id") % 6 == 1, 1).otherwise(2).cast("long").alias("expected_chunks"), (F.col("job_id") % 5 != 0).alias("sealed"))


_RECONCILED = f"""m AS (SELECT DISTINCT user_id AS job_id, CAST(CASE WHEN user_id % 4 = 0 THEN 3 WHEN user_id % 6 = 1 THEN 1 ELSE 2 END AS BIGINT) AS expected_chunks, user_id % 5 <> 0 AS sealed FROM events
), r AS (
  SELECT m.job_id, any_value(expected_chunks) AS expected_chunks, any_value(sealed) AS sealed, count(*) FILTER (state = 'COMPLETED') AS completed, count(*) FILTER (state = 'FAILED') AS failed, count(*) FILTER (state = 'RUNNING') AS running, count(*) FILTER (state = 'RETRY_PENDING') AS retrying, CAST(coalesce(sum(records) FILTER (state = 'COMPLETED'), 0) AS BIGINT) AS records FROM m LEFT JOIN s ON m.job_id = s.job_id GROUP BY 1)"""


@query(f"WITH RECURSIVE {_STEPS}, {_RECONCILED} SELECT job_id, completed, failed, records, CASE WHEN sealed AND completed + failed >= expected_chunks THEN CASE WHEN failed > 0 THEN 'FAILED' ELSE 'COMPLETED' END END AS status FROM r")
def reconcile_sealed(spark: SparkSession, sf: str) -> DataFrame:
    return commands.reconciled(_manifest(spark, sf), commands.chunk_states(commands.chunk_log(chunk_commands(spark, sf)))).select("job_id", "completed", "failed", "records", "status")


@query(f"WITH RECURSIVE {_STEPS}, {_RECONCILED} SELECT job_id, expected_chunks FROM r WHERE sealed AND expected_chunks < completed + failed + running + retrying")
def expected_chunks(spark: SparkSession, sf: str) -> DataFrame:
    states = commands.chunk_states(commands.chunk_log(chunk_commands(spark, sf)))
    return commands.broken_counts(commands.reconciled(_manifest(spark, sf), states.where("state <> 'PENDING'"))).select("job_id", "expected_chunks")


_JOB_KIND = "CASE CAST(event_id % 6 AS INTEGER) WHEN 0 THEN 'validate' WHEN 1 THEN 'plan' WHEN 2 THEN 'seal' WHEN 3 THEN 'schedule' WHEN 4 THEN CASE WHEN event_id % 4 = 0 THEN 'reject' ELSE 'validate' END ELSE CASE WHEN event_id % 5 = 0 THEN 'scheduling_failed' ELSE 'plan' END END"
_JOB_STEPS = f"""e AS (SELECT user_id AS job_id, event_id, {_JOB_KIND} AS kind, CASE WHEN event_id % 3 = 0 THEN 'EMPTY_FILE' ELSE 'FILE_TOO_LARGE: ' || event_id END AS why, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS TIMESTAMP), event_id) AS rn FROM events
), p AS (
  SELECT DISTINCT job_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS outcome, 'RECEIVED' AS state, false AS sealed, CAST(NULL AS VARCHAR) AS reason FROM e
  UNION ALL
  SELECT job_id, rn, event_id, outcome, CASE WHEN outcome <> 'applied' OR kind = 'seal' THEN state ELSE CASE kind WHEN 'validate' THEN 'VALIDATING' WHEN 'plan' THEN 'PLANNING' WHEN 'reject' THEN 'REJECTED' WHEN 'schedule' THEN 'PROCESSING' ELSE 'FAILED' END END, sealed OR (outcome = 'applied' AND kind = 'seal'), CASE WHEN outcome = 'applied' AND kind = 'reject' THEN why ELSE reason END
  FROM (SELECT e.job_id, e.rn, e.event_id, e.kind, e.why, p.state, p.sealed, p.reason, CASE e.kind
      WHEN 'validate' THEN CASE p.state WHEN 'RECEIVED' THEN 'applied' WHEN 'VALIDATING' THEN 'unchanged' WHEN 'PLANNING' THEN 'unchanged' ELSE 'conflict' END
      WHEN 'plan' THEN CASE p.state WHEN 'VALIDATING' THEN 'applied' WHEN 'PLANNING' THEN 'unchanged' ELSE 'conflict' END
      WHEN 'reject' THEN CASE WHEN p.state IN ('RECEIVED', 'VALIDATING') THEN 'applied' WHEN p.state = 'REJECTED' THEN 'unchanged' ELSE 'conflict' END
      WHEN 'seal' THEN CASE WHEN p.sealed THEN 'unchanged' WHEN p.state = 'PLANNING' THEN 'applied' ELSE 'conflict' END
      WHEN 'schedule' THEN CASE WHEN p.sealed AND p.state = 'PLANNING' THEN 'applied' WHEN p.state = 'PROCESSING' THEN 'unchanged' ELSE 'conflict' END
      ELSE CASE WHEN p.sealed AND p.state = 'PLANNING' THEN 'applied' WHEN p.state = 'FAILED' THEN 'unchanged' ELSE 'conflict' END END AS outcome
    FROM p JOIN e ON p.job_id = e.job_id AND e.rn = p.rn + 1))"""


@query(f"WITH RECURSIVE {_JOB_STEPS} SELECT event_id, outcome, state, sealed, reason FROM p WHERE rn > 0")
def job_command_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as commands on jobs: validation, planning, sealing, scheduling, rejection."""
    n = F.col("event_id")
    kind = F.when(n % 6 == 0, "validate").when(n % 6 == 1, "plan").when(n % 6 == 2, "seal").when(n % 6 == 3, "schedule").when(n % 6 == 4, F.when(n % 4 == 0, "reject").otherwise("validate")).otherwise(F.when(n % 5 == 0, "scheduling_failed").otherwise("plan"))
    rows = table(spark, sf, "events").select(F.col("user_id").alias("job_id"), F.col("ts").cast("timestamp").alias("at"), "event_id", kind.alias("kind"), F.when(n % 3 == 0, "EMPTY_FILE").otherwise("FILE_TOO_LARGE").alias("code"), F.when(n % 3 != 0, n.cast("string")).alias("detail"))
    return commands.job_log(rows).select("event_id", "outcome", "state", "sealed", "reason")


@query(f"SELECT job_id, chunk_id, epoch_us(min(moment)) AS scheduled_us FROM {_CHUNK_EVENTS} GROUP BY 1, 2")
def scheduled_marks(spark: SparkSession, sf: str) -> DataFrame:
    return commands.scheduled_at(chunk_commands(spark, sf)).select("job_id", "chunk_id", F.unix_micros("scheduled_at").alias("scheduled_us"))


@query(f"SELECT job_id, arg_min(state, (moment, event_id)) AS state FROM {E} GROUP BY job_id")
def config_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return commands.first_snapshot(state_log(spark, sf), "state")


@query(f"SELECT job_id AS source_job_id, 'replay-' || job_id AS new_job_id, string_agg(chunk_id, ',' ORDER BY chunk_id) AS chunk_ids, count(*) AS chunks, CAST(epoch(TIMESTAMP '{NOW}') AS BIGINT) + 90 * 86400 AS expires_at FROM {L} WHERE number IN (1, 2) AND job_id % 5 <> 0 AND job_id IN (SELECT job_id FROM {L} WHERE number = 2) GROUP BY 1")
def replay_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Replays of the first two chunks of jobs, where both are there."""
    first = results(spark, sf).select("job_id").distinct().withColumn("chunk_id", F.lit("00000001"))
    out = ledger.replay_audit(results(spark, sf), _wanted(spark, sf).union(first), F.concat(F.lit("replay-"), F.col("job_id").cast("string")), _now())
    return out.select("source_job_id", "new_job_id", F.array_join("chunk_ids", ",").alias("chunk_ids"), "chunks", "expires_at")


@query(f"SELECT job_id, chunk_id, CAST(row_number() OVER (PARTITION BY job_id ORDER BY chunk_id) AS INTEGER) AS position FROM {L} WHERE number % 2 = 1")
def resume_order(spark: SparkSession, sf: str) -> DataFrame:
    manifest = results(spark, sf)
    return ledger.in_order(ledger.unscheduled(manifest, manifest.where("number % 2 = 0")).select("job_id", "chunk_id"))
