"""The ledger as streams: admission with leases, chunks, completion of jobs, gaps, alarms.

Each operator keeps the states of keys, in buckets (``streaming.buckets``), and folds commands with the
functions that fold a table (``operators.commands``), in order of time within a trigger. A delivery that
comes again is known by its event id, which is kept for a bounded time.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.identity import completion_id
from recordmill.functions.states import job_result
from recordmill.operators.commands import EARLY, LEASE_US, Admitted, Chunk, on_admission, on_chunk
from recordmill.streaming.buckets import BUCKETS, COLUMN_BUCKETS, Bucketed, Columnar, Folded, in_buckets, in_columns, numbers
from recordmill.streaming.runs import stateful

DAY_MS = 86_400_000


def millis(duration: str) -> int:
    return int(pd.Timedelta(duration).total_seconds() * 1000)


def expired(late: pa.Table, out: pa.Schema) -> pa.Table:
    """A row without an event for each key whose lease ran out."""
    told = {"event_id": pa.nulls(late.num_rows, pa.int64()), "outcome": pa.array(["leaseExpired"] * late.num_rows, pa.string())}
    return pa.table([told[c] if c in told else late[c] for c in out.names], schema=out)


class AdmissionProcessor(Folded):
    """Jobs by their file ids. A time on the clock tells of a lease that ran out with no delivery."""

    held = "state string, lease_us long, revision int, owner long, due_ms long"

    def __init__(self, *args, lease_us: int, retention_ms: int) -> None:
        super().__init__(*args, retention_ms)
        self.lease_us = lease_us

    def fold(self, held: tuple | None, rows: Iterator[tuple], clock: int, out: list[tuple]) -> tuple | None:
        *state, due = held or (*vars(Admitted()).values(), None)
        job = Admitted(*state)
        before = job.lease_us
        for event_id, at_us, kind in rows:
            outcome = on_admission(job, kind, at_us, event_id, self.lease_us)
            out.append((outcome, job.state, job.revision, job.owner))
        if job.state is None:
            return None
        if job.lease_us != before:
            due = clock + self.lease_us // 1000
        return job.state, job.lease_us, job.revision, job.owner, due

    def due(self, held: pa.Table, limit: int, clock: int) -> tuple[pa.Table, pa.Table, pa.Table]:
        over = pc.fill_null(pc.less_equal(held["due_ms"], limit), False)
        late = held.filter(pc.and_(over, pc.is_in(held["state"], pa.array(EARLY))))
        due = pc.if_else(over, pa.scalar(None, pa.int64()), held["due_ms"])
        return held.set_column(held.num_columns - 1, "due_ms", due), expired(late, self.out), held.slice(0, 0)


def admission_stream(commands: DataFrame, lease_us: int = LEASE_US, retention: str = "90 days", buckets: int = COLUMN_BUCKETS) -> DataFrame:
    """commands as in ``admission_log`` -> file_id, event_id, outcome, state, revision, owner after each.

    Whether a lease has run out is decided by the time of the delivery that asks, so the rows are those
    of the batch fold. Besides, a job whose lease passes on the clock, in an early state, gives a row
    with outcome leaseExpired and no event. A job is forgotten ``retention`` after its last change."""
    stateful(commands.sparkSession)
    rows = commands.select("file_id", F.col("event_id").cast("long").alias("event_id"), "at_us", "kind")
    make = lambda *schemas: AdmissionProcessor(*schemas, lease_us=lease_us, retention_ms=millis(retention))
    return in_columns(rows, ["file_id"], make, "event_id long, outcome string, state string, revision int, owner long", buckets)


class ChunkProcessor(Folded):
    """The state of a chunk and the time of its last command, from which its lease runs. The time it
    waits for, by the watermark, is first that of the lease of a running chunk, then to forget the event ids."""

    held = "state string, attempt int, revision int, records long, last_ms long, due_ms long"

    def __init__(self, *args, lease_ms: int, remember_ms: int) -> None:
        super().__init__(*args)
        self.lease_ms, self.remember_ms = lease_ms, remember_ms

    def clock(self, timers) -> int:
        return timers.getCurrentWatermarkInMs()

    def fold(self, held: tuple | None, rows: Iterator[tuple], clock: int, out: list[tuple]) -> tuple | None:
        *c, last, _ = held or (*vars(Chunk()).values(), 0, None)
        chunk = Chunk(*c)
        for _, at_us, kind, attempt, records in rows:
            last = max(last, at_us // 1000)
            out.append((on_chunk(chunk, kind, attempt, records), chunk.state, chunk.revision))
        due = max(last + (self.lease_ms if chunk.state == "RUNNING" else self.remember_ms), clock + 1)
        return chunk.state, chunk.attempt, chunk.revision, chunk.records, last, due

    def due(self, held: pa.Table, limit: int, clock: int) -> tuple[pa.Table, pa.Table, pa.Table]:
        now = pc.fill_null(pc.less_equal(held["due_ms"], limit), False)
        forget = pc.add(held["last_ms"], self.remember_ms)
        over = pc.and_(now, pc.fill_null(pc.greater_equal(held["due_ms"], forget), False))
        late = held.filter(pc.and_(pc.and_not(now, over), pc.equal(held["state"], "RUNNING")))
        later = pc.if_else(over, pa.scalar(None, pa.int64()), pc.max_element_wise(forget, clock + 1))
        due = pc.if_else(now, later, held["due_ms"])
        return held.set_column(held.num_columns - 1, "due_ms", due), expired(late, self.out), held.filter(over)


def chunk_stream(commands: DataFrame, lease: str = "15 minutes", late: str = "0 seconds", remember: str = "15 days", buckets: int = COLUMN_BUCKETS) -> DataFrame:
    """commands as in ``chunk_log`` -> job_id, chunk_id, event_id, outcome, state and revision after
    each, and a row with outcome leaseExpired (no event) for a chunk that ran past its lease by the
    watermark, ``late`` behind the newest command of any chunk. Late commands are folded when they
    come, none is dropped: the state does not see the watermark's column, only its timers do. Event
    ids are remembered for ``remember`` (more than the lease) after a chunk's last command; redelivered
    ones neither count nor move a lease."""
    stateful(commands.sparkSession)
    rows = commands.withWatermark("at", late).select("job_id", "chunk_id", F.col("event_id").cast("long").alias("event_id"), F.unix_micros("at").alias("at_us"), "kind", "attempt", "records")
    out = "event_id long, outcome string, state string, revision int"
    make = lambda *schemas: ChunkProcessor(*schemas, lease_ms=millis(lease), remember_ms=millis(remember))
    return in_columns(rows, ["job_id", "chunk_id"], make, out, buckets, "EventTime")


class JobState(Columnar):
    """The latest state of a job by (time, event id), and how many different events it had."""

    ids = True
    held = "event_id long, at_us long, state string, events long"

    def change(self, held: pa.Table, came: pa.Table, clock: int) -> tuple[pa.Table, pa.Table]:
        new = self.seen.new(came)
        keys = pa.concat_tables([t.select(self.key) for t in (held, new, came)])
        _, first, job = np.unique(numbers(keys, self.key), return_index=True, return_inverse=True)
        before, now, touched = np.split(job, np.cumsum([held.num_rows, new.num_rows]))
        n, at = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        n[before], at[before] = held["events"].to_numpy(), held["changed_ms"].to_numpy()
        np.add.at(n, now, 1)
        at[touched] = clock
        # of equals the last is taken: what is held, or else what came first
        names = ["event_id", "at_us", "state"]
        rows = pa.concat_tables([new.select(names).take(pa.array(np.arange(len(now))[::-1])), held.select(names)])
        rows = rows.append_column("job", pa.array(np.concatenate([now[::-1], before])))
        rows = rows.take(pc.sort_indices(rows, [("job", "ascending"), ("at_us", "ascending"), ("event_id", "ascending")], null_placement="at_start"))
        last = rows.filter(pa.array(np.diff(rows["job"].to_numpy(), append=-1) != 0))
        kept = pa.table([*keys.take(pa.array(first)).columns, pa.array(at), *last.select(names).columns, pa.array(n)], schema=self.kept)
        return kept, kept.take(pa.array(np.unique(touched))).select(self.out.names)


def state_stream(log: DataFrame, remember: str = "15 days", buckets: int = COLUMN_BUCKETS) -> DataFrame:
    """log: job_id, event_id, at, state -> job_id, state, events after each trigger that brings any: the
    latest event decides, so any order of arrival ends in the same state, and one that comes again
    within ``remember`` is not counted again."""
    stateful(log.sparkSession)
    rows = log.select("job_id", F.col("event_id").cast("long").alias("event_id"), F.unix_micros("at").alias("at_us"), "state")
    return in_columns(rows, ["job_id"], lambda *schemas: JobState(*schemas, ids_ms=millis(remember)), "state string, events long", buckets)


COUNTERS = ("records_read", "records_published", "records_rejected", "records_ignored")


class FirstEnd(Columnar):
    """The first end of a chunk, by ordinal within a trigger; later ones are redeliveries and count for nothing."""

    def change(self, held: pa.Table, came: pa.Table, clock: int) -> tuple[pa.Table, pa.Table]:
        came = came.take(pc.sort_indices(came, [("ordinal", "ascending")]))
        both = pa.concat_tables([held.select(self.key), came.select(self.key)])
        first = np.unique(numbers(both, self.key), return_index=True)[1]
        new = came.take(pa.array(np.sort(first[first >= held.num_rows]) - held.num_rows))
        done = pc.equal(new["status"], "COMPLETED")
        columns = {k: new[k] for k in self.key}
        kept = pa.table([*columns.values(), pa.array(np.full(new.num_rows, clock))], schema=self.kept)
        columns |= {"expected_chunks": pa.nulls(new.num_rows, pa.int64()), "sealed": pa.nulls(new.num_rows, pa.bool_()), "completed": done.cast(pa.int64()), "failed": pc.invert(done).cast(pa.int64())}
        columns |= {c: pc.if_else(done, pc.fill_null(new[c], 0), 0) for c in COUNTERS}
        return pa.concat_tables([held, kept]), pa.table(list(columns.values()), schema=self.out)


class JobCounters(Columnar):
    """Counters of a job, its manifest, and whether its intent has been written. The first sealed manifest
    holds, or before it comes, the last."""

    held = "expected_chunks long, sealed boolean, written boolean, completed long, failed long, " + ", ".join(f"{c} long" for c in COUNTERS)

    def change(self, held: pa.Table, came: pa.Table, clock: int) -> tuple[pa.Table, pa.Table]:
        both = pa.concat_tables([held.select(self.key), came.select(self.key)])
        _, first, job = np.unique(numbers(both, self.key), return_index=True, return_inverse=True)
        before, now = job[: held.num_rows], job[held.num_rows :]

        def state(c: str) -> np.ndarray:
            values = held[c].to_numpy()
            out = np.zeros(len(first), bool if values.dtype == object else values.dtype)
            out[before] = values
            return out

        at, expected, sealed, written = map(state, ("changed_ms", "expected_chunks", "sealed", "written"))
        sums = {c: state(c) for c in ("completed", "failed", *COUNTERS)}
        at[now] = clock
        plan = pc.is_valid(came["expected_chunks"]).to_numpy()
        for c, total in sums.items():
            np.add.at(total, now[~plan], pc.fill_null(came[c], 0).to_numpy()[~plan])
        wanted, closed = pc.fill_null(came["expected_chunks"], 0).to_numpy(), pc.fill_null(came["sealed"], False).to_numpy()
        row = np.full(len(first), -1)
        for rows in (np.flatnonzero(plan), np.flatnonzero(plan & closed)[::-1]):  # of several the last is written
            row[now[rows]] = rows
        new = ~sealed & (row >= 0)
        expected[new], sealed[new] = wanted[row[new]], closed[row[new]]
        ready = sealed & ~written & (sums["completed"] + sums["failed"] >= expected)
        keys = both.take(pa.array(first))
        kept = pa.table([*keys.columns, *map(pa.array, (at, expected, sealed, written | ready, *sums.values()))], schema=self.kept)
        out = pa.table([*keys.columns, *map(pa.array, (expected, *sums.values()))], schema=self.out)
        return kept, out.filter(pa.array(ready))


def completion_stream(results: DataFrame, manifests: DataFrame, retention: str = "90 days", buckets: int = COLUMN_BUCKETS) -> DataFrame:
    """results: job_id, chunk_id, ordinal, status and the counters; manifests: job_id, expected_chunks,
    sealed. One intent for each job as soon as its sealed manifest is met: job_id, expected_chunks,
    completed, failed, the counters of completed chunks, status, result and completion_id.

    Two stateful operators in a row: the first end of each chunk (by ``ordinal`` within a trigger), then
    the counters of each job. Results and manifests may come in any order, and again."""
    stateful(results.sparkSession)
    fields = "expected_chunks long, sealed boolean, completed long, failed long, " + ", ".join(f"{c} long" for c in COUNTERS)
    over = results.where(F.col("status").isin("COMPLETED", "FAILED")).select("job_id", "chunk_id", "ordinal", "status", *COUNTERS)
    ends = in_columns(over, ["job_id", "chunk_id"], lambda *schemas: FirstEnd(*schemas, millis(retention)), fields, buckets).drop("chunk_id")
    zero = [F.lit(0).cast("long").alias(c) for c in ("completed", "failed", *COUNTERS)]
    plans = manifests.select("job_id", F.col("expected_chunks").cast("long").alias("expected_chunks"), "sealed", *zero)
    out = "expected_chunks long, completed long, failed long, " + ", ".join(f"{c} long" for c in COUNTERS)
    done = in_columns(ends.unionByName(plans), ["job_id"], lambda *schemas: JobCounters(*schemas, millis(retention)), out, buckets)
    status, result = job_result(F.col("failed"), F.col("records_rejected"))
    return done.withColumns({"status": status, "result": result, "completion_id": completion_id("job_id", F.lit(1))})


def merged(starts: np.ndarray, ends: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint intervals (closed, none touching another) with new ordinals among them."""
    a, b = np.concatenate([starts, new]), np.concatenate([ends, new])
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    first = np.concatenate([[True], a[1:] > b[:-1] + 1]) if len(a) else np.zeros(0, bool)
    last = np.concatenate([first[1:], [True]]) if len(a) else first
    return a[first], b[last]


def merged_few(starts: list[int], ends: list[int], new: Iterable[int]) -> tuple[list[int], list[int]]:
    """The same for a handful."""
    a, b = [], []
    for start, end in sorted([*zip(starts, ends, strict=True), *((o, o) for o in new)]):
        if a and start <= b[-1] + 1:
            b[-1] = max(b[-1], end)
        else:
            a.append(start)
            b.append(end)
    return a, b


#: So many intervals and ordinals are merged without arrays: most keys have few.
FEW = 64


class Intervals(Bucketed):
    """The ordinals of a key as disjoint intervals: as large as the number of its gaps."""

    def __init__(self, width: int, first: int, limit: int) -> None:
        super().__init__(width)
        self.first, self.limit = first, limit

    def fresh(self) -> array:
        return array("q")

    def gather(self, came, row: tuple) -> None:
        if row[0] is not None and row[0] >= self.first:
            came.append(row[0])

    def change(self, key: tuple, held: tuple | None, came, out: list[tuple]) -> tuple:
        starts, ends, number = held or ([], [], 0)
        if len(starts) + len(came) <= FEW:
            starts, ends = merged_few(starts, ends, came)
        else:
            a, b = merged(np.array(starts, np.int64), np.array(ends, np.int64), np.unique(np.frombuffer(came, np.int64)))
            starts, ends = a.tolist(), b.tolist()
        missing, n, low = [], 0, self.first
        for start, end in zip(starts, ends, strict=True):
            n += start - low
            if len(missing) < self.limit:
                missing += range(low, min(start, low + self.limit - len(missing)))
            low = end + 1
        out.append((*key, number + 1, n, missing))
        return starts, ends, number + 1


def gap_stream(seen: DataFrame, group: str, ordinal: str, first: int, limit: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """group, trigger, n_missing, missing: after each trigger that brings ordinals of a group, how many it
    lacks between ``first`` and its largest, and the first ``limit`` of them. Repeated ordinals change
    nothing; the state is the disjoint intervals of what was seen, not the ordinals."""
    stateful(seen.sparkSession)
    rows = seen.select(F.col(group).alias("group"), F.col(ordinal).cast("long").alias("ordinal"))
    return in_buckets(rows, ["group"], lambda n: Intervals(n, first, limit), "trigger int, n_missing long, missing array<long>", "None", buckets)


def alarm_stream(events: DataFrame, at: str, breach: Column, threshold: int, width: str = "60 seconds", periods: int = 2, late: str = "0 seconds") -> DataFrame:
    """window_start and n of each window in which more than ``threshold`` events breach, as they do in
    the ``periods - 1`` before: the counts of windows, in a second, sliding window over their times. A
    window is reported once the watermark has passed it and the sliding one that ends with it."""
    # a filter would go below the watermark, which then saw breaches only
    counts = events.withWatermark(at, late).groupBy(F.window(at, width).alias("w")).agg(F.count_if(breach).alias("n")).where(F.col("n") > threshold)
    timed = counts.select(F.window_time("w").alias("t"), "n")
    total = f"{pd.Timedelta(width).total_seconds() * periods:.0f} seconds"
    row = timed.groupBy(F.window("t", total, width).alias("run")).agg(F.count("*").alias("hits"), F.max_by("n", "t").alias("n"))
    return row.where(F.col("hits") == periods).select((F.col("run.end") - F.expr(f"INTERVAL {width}")).alias("window_start"), "n")
