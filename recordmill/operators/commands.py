"""Commands on chunks and jobs, folded in order of time.

What a conditional write would decide on the stored row is decided here on the state that the
commands before have led to, so a delivery that comes again or late has its defined outcome:

* applied: the state changed; unchanged: it had already; busy, alreadyCompleted: what an acquirer is
  told; conflict: the command does not fit the state.

The same functions fold a sorted table and a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.identity import completion_token
from recordmill.functions.states import JOB

MAX_ATTEMPTS = 3
EARLY = ("RECEIVED", "VALIDATING", "PLANNING")
ENDED = ("COMPLETED", "FAILED")


@dataclass
class Chunk:
    state: str = "PENDING"
    attempt: int = 0
    revision: int = 0
    records: int = 0


@dataclass
class Job:
    state: str = "RECEIVED"
    sealed: bool = False
    revision: int = 0
    reason: str | None = None


def on_chunk(c: Chunk, kind: str, attempt: int, records: int, max_attempts: int = MAX_ATTEMPTS) -> str:
    """acquire counts an attempt, start names one; complete and fail are of the attempt that runs.
    A failure waits for another attempt until the last."""
    running = c.state == "RUNNING" and c.attempt == attempt
    if kind == "acquire":
        if c.state != "PENDING":
            return "alreadyCompleted" if c.state in ENDED else "busy"
        c.state, c.attempt = "RUNNING", c.attempt + 1
    elif kind == "start":
        if c.state not in ("PENDING", "RETRY_PENDING"):
            return "alreadyCompleted" if c.state == "COMPLETED" else "conflict"
        c.state, c.attempt = "RUNNING", attempt
    elif kind == "complete":
        if not running:
            return "unchanged" if c.state == "COMPLETED" else "conflict"
        c.state, c.records = "COMPLETED", records
    elif kind == "fail":
        if not running:
            return "unchanged" if c.state in ENDED else "conflict"
        c.state = "RETRY_PENDING" if attempt < max_attempts else "FAILED"
    else:
        return "conflict"
    c.revision += 1
    return "applied"


#: Where each command on a job may start, where it leads, and where it has been already.
JOB_STEPS = {
    "validate": (("RECEIVED",), "VALIDATING", ("VALIDATING", "PLANNING")),
    "plan": (("VALIDATING",), "PLANNING", ("PLANNING",)),
    "reject": (("RECEIVED", "VALIDATING"), "REJECTED", ("REJECTED",)),
    "schedule": (("PLANNING",), "PROCESSING", ("PROCESSING",)),
    "scheduling_failed": (("PLANNING",), "FAILED", ("FAILED",)),
}


def on_job(j: Job, kind: str, reason: str | None = None, detail: str | None = None) -> str:
    """seal closes the manifest of a job in planning; only a sealed one is scheduled or fails to be."""
    if kind == "seal":
        if j.sealed or j.state != "PLANNING":
            return "unchanged" if j.sealed else "conflict"
        j.sealed = True
        j.revision += 1
        return "applied"
    if kind not in JOB_STEPS:
        return "conflict"
    source, target, done = JOB_STEPS[kind]
    if j.state not in source or (kind in ("schedule", "scheduling_failed") and not j.sealed):
        return "unchanged" if j.state in done else "conflict"
    j.state = target
    j.revision += 1
    if kind == "reject":
        j.reason = f"{reason}: {detail}" if detail else reason
    return "applied"


def folded(commands: DataFrame, key: list[str], order: list[str], arguments: list[str], start: Callable, step: Callable, state: dict[str, str]) -> DataFrame:
    """The columns of ``commands``, the outcome of each, and the state after it.

    Keys are streamed in order within partitions: a task holds the state of one key, not its
    commands, so a key with any number of them will do."""
    rows = commands.repartition(*key).sortWithinPartitions(*key, *order)
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, start()
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in key], strict=True)
            out: dict[str, list] = {"outcome": [], **{c: [] for c in state}}
            for k, a in zip(keys, zip(*[batch.column(c).to_pylist() for c in arguments], strict=True), strict=True):
                if k != now:
                    now, held = k, start()
                out["outcome"].append(step(held, *a))
                for c in state:
                    out[c].append(getattr(held, c))
            for c, kind in {"outcome": "string", **state}.items():
                batch = batch.append_column(c, pa.array(out[c], kinds[kind]))
            yield batch

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in commands.schema.fields)
    return rows.mapInArrow(run, fields + ", ".join(f"{c} {kind}" for c, kind in {"outcome": "string", **state}.items()))


#: An admission is held so long before another delivery may take it over.
LEASE_US = 15 * 60 * 1_000_000


@dataclass
class Admitted:
    """A job by its file id: null state before the first delivery; ``owner`` is the event that holds it."""

    state: str | None = None
    lease_us: int = 0
    revision: int = 0
    owner: int | None = None


def on_admission(a: Admitted, kind: str, at_us: int, event_id: int, lease_us: int = LEASE_US) -> str:
    """deliver: acquired if the job is new, or waits in an early state whose lease has run out (which
    starts another); alreadyCompleted if it has ended; else busy. Any other kind is the state that the
    owner moves the job to."""
    if kind == "deliver":
        if a.state is None:
            a.state = "RECEIVED"
        elif not JOB.get(a.state):
            return "alreadyCompleted"
        elif a.state not in EARLY or a.lease_us > at_us:
            return "busy"
        else:
            a.revision += 1
        a.lease_us, a.owner = at_us + lease_us, event_id
        return "acquired"
    if a.state is None:
        return "unknown"
    if kind not in JOB.get(a.state, []):
        return "unchanged" if kind == a.state else "conflict"
    a.state = kind
    a.revision += 1
    return "applied"


def admission_log(commands: DataFrame, lease_us: int = LEASE_US) -> DataFrame:
    """commands: file_id, at_us, event_id, kind -> with outcome, state, revision and owner after each."""
    step = lambda a, kind, at, event: on_admission(a, kind, at, event, lease_us)
    return folded(commands, ["file_id"], ["at_us", "event_id"], ["kind", "at_us", "event_id"], Admitted, step, {"state": "string", "revision": "int", "owner": "long"})


CHUNK_STATE = {"state": "string", "attempt": "int", "revision": "int", "records": "long"}


def chunk_log(commands: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """commands: job_id, chunk_id, at, event_id, kind, attempt, records -> with outcome, and state, attempt,
    revision and records after each; what a command says itself is in ``asked`` and ``offered``. A
    running chunk has the ``token`` of who holds it, another one for each attempt."""
    rows = commands.withColumnsRenamed({"records": "offered", "attempt": "asked"})
    log = folded(rows, ["job_id", "chunk_id"], ["at", "event_id"], ["kind", "asked", "offered"], Chunk, lambda c, *a: on_chunk(c, *a, max_attempts), CHUNK_STATE)
    return log.withColumn("token", F.when(F.col("state") == "RUNNING", completion_token("job_id", "chunk_id", "attempt", F.lit(0))))


def chunk_states(log: DataFrame) -> DataFrame:
    """The last state of each chunk, and how many of its commands did not fit."""
    last = F.max_by(F.struct("state", "revision", "records"), F.struct("at", "event_id"))
    return log.groupBy("job_id", "chunk_id").agg(last.alias("s"), F.count_if(F.col("outcome") == "conflict").alias("conflicts")).select("job_id", "chunk_id", "s.*", "conflicts")


def job_log(commands: DataFrame) -> DataFrame:
    """commands: job_id, at, event_id, kind, code, detail -> with outcome, state, sealed, revision, reason."""
    return folded(commands, ["job_id"], ["at", "event_id"], ["kind", "code", "detail"], Job, on_job, {"state": "string", "sealed": "boolean", "revision": "int", "reason": "string"})


def scheduled_at(marks: DataFrame, at: str = "at") -> DataFrame:
    """When each chunk was first marked scheduled; later marks change nothing."""
    return marks.groupBy("job_id", "chunk_id").agg(F.min(at).alias("scheduled_at"))


def first_snapshot(snapshots: DataFrame, snapshot: str, at: str = "at", tie: str = "event_id") -> DataFrame:
    """The configuration that a job was planned with: the first one holds."""
    return snapshots.groupBy("job_id").agg(F.min_by(snapshot, F.struct(at, tie)).alias(snapshot))


def ended(sealed: Column, completed: Column, failed: Column, expected: Column) -> Column:
    """The one rule by which a job ends: its manifest is sealed, and as many chunks as it names have."""
    return F.coalesce(sealed & (completed + failed >= expected), F.lit(False))


def reconciled(manifest: DataFrame, chunks: DataFrame) -> DataFrame:
    """manifest: job_id, expected_chunks, sealed; chunks: job_id, chunk_id, state, records. One row
    per job: its counts, and its status once it is sealed and as many chunks as expected have ended
    (null before). Chunks that were never started have no row, so they count as pending."""
    of = lambda s: F.count_if(F.col("state") == s)
    counts = chunks.groupBy("job_id").agg(of("RUNNING").alias("running"), of("RETRY_PENDING").alias("retry_pending"), of("COMPLETED").alias("completed"), of("FAILED").alias("failed"), F.sum(F.when(F.col("state") == "COMPLETED", F.col("records")).otherwise(0)).cast("long").alias("records"))
    rows = manifest.join(counts, "job_id", "left").na.fill(0, ["running", "retry_pending", "completed", "failed", "records"])
    over = ended(*map(F.col, ("sealed", "completed", "failed", "expected_chunks")))
    pending = F.col("expected_chunks") - F.col("running") - F.col("retry_pending") - F.col("completed") - F.col("failed")
    return rows.withColumn("pending", pending).withColumn("status", F.when(over, F.when(F.col("failed") > 0, "FAILED").otherwise("COMPLETED")))


def broken_counts(reconciled_jobs: DataFrame) -> DataFrame:
    """Jobs with more chunks than their sealed manifest has: expected is no longer the sum over states."""
    return reconciled_jobs.where(F.col("sealed") & (F.col("pending") < 0))
