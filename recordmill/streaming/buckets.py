"""Stateful operators on buckets of keys.

A Python operator of ``transformWithState`` asks the JVM for each of its key's variables over a socket,
several calls a key, and hands its rows over in one Arrow batch a key. Where there is a key for each
job, a trigger's time goes there. So keys are dealt by their hash to a fixed number of buckets: a bucket
is the operator's key, and what is held of its keys is one value, read in one call and written in one.
Rows go in and out packed, some of a bucket's in one value, since the operator takes them cell by cell.
A task has one bucket in memory, the keys by ``BUCKETS``; a trigger that brings a key of a bucket reads
and writes all its keys, so large triggers suit it, and a stream with very many keys and small triggers
is given more ``buckets``.

``Bucketed`` folds the rows of each key in turn. In a ``Columnar`` operator rows come, are held and go as
columns, and a bucket's keys are looked up, sorted and written together; of these a ``Folded`` one goes
through the rows of each key in order.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

BUCKETS = 4096
#: So many rows or bytes are packed at a time, and so many rows unpacked.
ROWS, BYTES, ROWS_OUT = 65_536, 32 * 1024 * 1024, 10_000
#: Of columns, whose fold costs less for more keys.
COLUMN_BUCKETS = 1024


def told(out: list[tuple]) -> Iterator[Row]:
    for i in range(0, len(out), ROWS_OUT):
        yield Row(rows=pickle.dumps(out[i : i + ROWS_OUT]))


class Bucketed(StatefulProcessor):
    """What a subclass says of one key: how its rows of a trigger are gathered, and how they change the
    tuple that is held of it."""

    def __init__(self, width: int) -> None:
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "keys binary")

    def close(self) -> None:
        pass

    def fresh(self):
        """What a key's rows of a trigger are gathered in."""
        return []

    def gather(self, came, row: tuple) -> None:
        """``row``: the columns behind the key's."""
        came.append(row)

    def change(self, key: tuple, held: tuple | None, came, out: list[tuple]) -> tuple:
        """What is held from now on. Rows go to ``out``, the key first."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        n = self.width
        came: dict[tuple, object] = {}
        for packed in rows:
            for r in pickle.loads(packed.rows):
                k = r[:n]
                if k not in came:
                    came[k] = self.fresh()
                self.gather(came[k], r[n:])
        value, out = self.held.get(), []
        all_held = {} if value is None else pickle.loads(value[0])
        for k, c in came.items():
            all_held[k] = self.change(k, all_held.get(k), c, out)
        self.held.update((pickle.dumps(all_held),))
        yield from told(out)


def packed(rows: DataFrame) -> DataFrame:
    """bucket and others -> bucket and rows: lists of what a task has of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        n = size = 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(map(pickle.dumps, held.values()), pa.binary())], names=["bucket", "rows"])

        for batch in batches:
            numbers, *columns = (c.to_pylist() for c in batch.columns)
            for b, row in zip(numbers, zip(*columns, strict=True), strict=True):
                held.setdefault(b, []).append(row)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= ROWS or size >= BYTES:
                yield flushed()
                held, n, size = {}, 0, 0
        if held:
            yield flushed()

    return rows.mapInArrow(run, "bucket int, rows binary")


def unpacked(rows: DataFrame, ddl: str) -> DataFrame:
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                columns = zip(*pickle.loads(value.as_py()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return rows.mapInArrow(run, ddl)


def in_buckets(rows: DataFrame, key: list[str], make, out: str, time_mode: str, buckets: int = BUCKETS) -> DataFrame:
    """The operator that ``make`` builds for a key of so many columns, over the rows: the key and ``out``."""
    kinds = dict(rows.dtypes)
    names = ", ".join(f"`{k}` {kinds[k]}" for k in key)
    dealt = rows.select(F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket"), *key, *[c for c in rows.columns if c not in key])
    return unpacked(packed(dealt).groupBy("bucket").transformWithState(make(len(key)), "rows binary", "append", time_mode), f"{names}, {out}")


def numbers(rows: pa.Table, key: list[str]) -> np.ndarray:
    """The same number for rows with the same key; null is a value."""
    out, most = np.zeros(rows.num_rows, np.int64), 1
    for c in key:
        coded = rows[c].combine_chunks().dictionary_encode(null_encoding="encode")
        n = max(len(coded.dictionary), 1)
        if most * n > 2**62:
            values, out = np.unique(out, return_inverse=True)
            most = len(values)
        out, most = out * n + coded.indices.to_numpy(), most * n
    return out


def plain(column: pa.ChunkedArray) -> list:
    """The column's values in Python, strings of few kinds at the price of numbers."""
    if pa.types.is_string(column.type):
        coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
        kinds = coded.dictionary.to_pylist()
        return [kinds[i] for i in coded.indices.to_numpy().tolist()]
    return column.to_pylist() if column.null_count else column.to_numpy().tolist()


def one_batch(rows: pa.Table) -> pa.RecordBatch:
    found = rows.combine_chunks().to_batches()
    return found[0] if found else pa.RecordBatch.from_pylist([], schema=rows.schema)


def read(value: bytes, schema: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(value), schema)


def written(rows: pa.Table) -> bytes:
    return one_batch(rows).serialize().to_pybytes()


class Seen:
    """Event ids of the keys of a bucket: a value for each trigger that brings any, with a row a key; with
    a lifetime a value is forgotten on the clock. One value at a time is in memory."""

    def __init__(self, handle: StatefulProcessorHandle, key: list[str], came: pa.Schema, ttl_ms: int | None) -> None:
        self.rows = handle.getListState("seen", "ids binary", ttlDurationMs=ttl_ms)
        self.key = key
        self.schema = pa.schema([*[came.field(k) for k in key], pa.field("ids", pa.list_(pa.int64()))])

    def new(self, came: pa.Table) -> pa.Table:
        """Rows whose event id is new to their key, the first of each in the order they have."""
        names = [*self.key, "event_id"]
        first = np.sort(np.unique(numbers(came, names), return_index=True)[1])
        asked = came.select(names).take(pa.array(first))
        fresh = np.ones(len(first), bool)
        for (value,) in self.rows.get():
            row = read(value, self.schema)
            parents = pc.list_parent_indices(row["ids"])
            known = pa.table([*[row[k].take(parents) for k in self.key], pc.list_flatten(row["ids"])], schema=asked.schema)
            number = numbers(pa.concat_tables([asked, known]), names)
            fresh &= ~np.isin(number[: len(first)], number[len(first) :])
        if fresh.any():
            added = asked.filter(pa.array(fresh))
            number = numbers(added, self.key)
            order = np.argsort(number, kind="stable")
            starts = np.flatnonzero(np.diff(number[order], prepend=-1))
            ids = pa.ListArray.from_arrays(pa.array([*starts.tolist(), len(order)], pa.int32()), added["event_id"].take(pa.array(order)).combine_chunks())
            keys = added.select(self.key).take(pa.array(order[starts]))
            self.rows.appendValue((written(pa.table([*keys.columns, ids], schema=self.schema)),))
        return came.take(pa.array(first[fresh]))

    def forget(self, keys: pa.Table) -> None:
        left = []
        for (value,) in self.rows.get():
            row = pa.Table.from_batches([read(value, self.schema)])
            number = numbers(pa.concat_tables([keys.select(self.key), row.select(self.key)]), self.key)
            row = row.filter(pa.array(~np.isin(number[keys.num_rows :], number[: keys.num_rows])))
            if row.num_rows:
                left.append((written(row),))
        if left:
            self.rows.put(left)
        else:
            self.rows.clear()


class Columnar(StatefulProcessor):
    """What a subclass says of all keys of a bucket: how rows change what is held. ``held``: the columns
    behind the key's, as DDL; each key also has the time of its last change, and is forgotten
    ``retention_ms`` after it. ``timed``: the last column held is the time that ``due`` waits for, null if
    none; the bucket's one timer is for the first of them. ``ids``: event ids that came are in ``seen``
    for ``ids_ms``, or else as long as what is held."""

    held = ""
    timed = ids = False

    def __init__(self, key: list[str], came: pa.Schema, out: pa.Schema, retention_ms: int | None = None, ids_ms: int | None = None) -> None:
        self.key, self.came, self.out, self.retention_ms, self.ids_ms = key, came, out, retention_ms, ids_ms or retention_ms
        behind = to_arrow_schema(StructType.fromDDL(self.held)) if self.held else []
        self.kept = pa.schema([*[came.field(k) for k in key], pa.field("changed_ms", pa.int64()), *behind])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("held", "keys binary", ttlDurationMs=self.retention_ms)
        self.seen = Seen(handle, self.key, self.came, self.ids_ms) if self.ids else None

    def close(self) -> None:
        pass

    def clock(self, timers) -> int:
        """The time in ms that this operator goes by."""
        return timers.getCurrentProcessingTimeInMs()

    def change(self, held: pa.Table, came: pa.Table, clock: int) -> tuple[pa.Table, pa.Table]:
        """What is held from now on, a row a key, and the rows that go out."""
        raise NotImplementedError

    def due(self, held: pa.Table, limit: int, clock: int) -> tuple[pa.Table, pa.Table, pa.Table]:
        """The same after the time ``limit``, and the keys whose event ids are forgotten."""
        raise NotImplementedError

    def loaded(self, clock: int) -> pa.Table:
        value = self.state.get()
        held = pa.Table.from_batches([] if value is None else [read(value[0], self.kept)], self.kept)
        return held if self.retention_ms is None else held.filter(pc.greater(held["changed_ms"], clock - self.retention_ms))

    def saved(self, held: pa.Table) -> None:
        if held.num_rows:
            self.state.update((written(held),))
        else:
            self.state.clear()
        if self.timed:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            first = pc.min(held.column(held.num_columns - 1)).as_py()
            if first is not None:
                self.handle.registerTimer(first)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        clock = self.clock(timerValues)
        came = pa.Table.from_batches([read(r.rows, self.came) for r in rows], self.came)
        held, out = self.change(self.loaded(clock), came, clock)
        self.saved(held)
        yield from told_columns(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        clock = self.clock(timerValues)
        limit = max(expiredTimerInfo.getExpiryTimeInMs(), clock - 1)
        held, out, forgotten = self.due(self.loaded(clock), limit, clock)
        if forgotten.num_rows:
            self.seen.forget(forgotten)
        self.saved(held)
        yield from told_columns(out)


def told_columns(out: pa.Table) -> Iterator[Row]:
    gone = one_batch(out)
    for i in range(0, gone.num_rows, ROWS_OUT):
        yield Row(rows=gone.slice(i, ROWS_OUT).serialize().to_pybytes())


class Folded(Columnar):
    """Rows of each key folded in order of ``at_us`` and event id, each new id once. Columns are sorted,
    looked up and kept for all keys together; only the fold itself goes from row to row."""

    timed = ids = True

    def fold(self, held: tuple | None, rows: Iterator[tuple], clock: int, out: list[tuple]) -> tuple | None:
        """What is held of a key after rows of the columns behind its own; for each row, what ``out``
        has behind its event id. Null if nothing is to be held."""
        raise NotImplementedError

    def change(self, held: pa.Table, came: pa.Table, clock: int) -> tuple[pa.Table, pa.Table]:
        came = self.seen.new(came.take(pc.sort_indices(came, [("at_us", "ascending"), ("event_id", "ascending")], null_placement="at_start")))
        both = pa.concat_tables([held.select(self.key), came.select(self.key)])
        _, first, number = np.unique(numbers(both, self.key), return_index=True, return_inverse=True)
        before, now = number[: held.num_rows], number[held.num_rows :]
        order = np.argsort(now, kind="stable")
        came, now = came.take(pa.array(order)), now[order]
        states: list[tuple | None] = [None] * len(first)
        for k, state in zip(before.tolist(), zip(*[plain(c) for c in held.columns[len(self.key) :]], strict=True), strict=True):
            states[k] = state
        starts = np.flatnonzero(np.diff(now, prepend=-1))
        rows = zip(*[plain(c) for c in came.columns[len(self.key) :]], strict=True)
        out: list[tuple] = []
        for k, n in zip(now[starts].tolist(), np.diff(starts, append=len(now)).tolist(), strict=True):
            after = self.fold(states[k] and states[k][1:], islice(rows, n), clock, out)
            if after is not None:
                states[k] = (clock, *after)
        keys = both.take(pa.array(first)).filter(pa.array([s is not None for s in states], pa.bool_()))
        kept = listed([s for s in states if s is not None], self.kept, len(self.key))
        gone = listed(out, self.out, len(self.key) + 1)
        return pa.table([*keys.columns, *kept], schema=self.kept), pa.table([*came.select([*self.key, "event_id"]).columns, *gone], schema=self.out)


def listed(rows: list[tuple], schema: pa.Schema, start: int) -> list[pa.Array]:
    """Columns of the schema's fields from ``start`` on."""
    columns = zip(*rows, strict=True) if rows else ((),) * (len(schema) - start)
    return [pa.array(c, t) for c, t in zip(columns, schema.types[start:], strict=True)]


def packed_columns(rows: DataFrame, schema: pa.Schema) -> DataFrame:
    """bucket and others -> bucket and rows: columns of what a task has of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = size = 0

        def flushed() -> pa.RecordBatch:
            whole = one_batch(pa.Table.from_batches(held))
            bucket = whole.column(0).to_numpy()
            order = np.argsort(bucket, kind="stable")
            dealt = pa.RecordBatch.from_arrays(whole.take(pa.array(order)).columns[1:], schema=schema)
            values, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts[1:].tolist(), len(order)]
            parts = [dealt.slice(a, b - a).serialize().to_pybytes() for a, b in zip(starts.tolist(), ends, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(values, pa.int32()), pa.array(parts, pa.binary())], names=["bucket", "rows"])

        for batch in batches:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= ROWS or size >= BYTES:
                yield flushed()
                held, n, size = [], 0, 0
        if n:
            yield flushed()

    return rows.mapInArrow(run, "bucket int, rows binary")


def unpacked_columns(rows: DataFrame, schema: pa.Schema, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                yield pa.ipc.read_record_batch(value.as_buffer(), schema)

    return rows.mapInArrow(run, ddl)


def in_columns(rows: DataFrame, key: list[str], make, out: str, buckets: int = COLUMN_BUCKETS, time_mode: str = "ProcessingTime") -> DataFrame:
    """As ``in_buckets`` for the columnar operator that ``make`` builds of the key and the columns that come and go."""
    kinds = dict(rows.dtypes)
    dealt = rows.select(F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket"), *key, *[c for c in rows.columns if c not in key])
    came = to_arrow_schema(StructType(dealt.schema.fields[1:]))
    ddl = ", ".join(f"`{k}` {kinds[k]}" for k in key) + f", {out}"
    gone = to_arrow_schema(StructType.fromDDL(ddl))
    states = packed_columns(dealt, came).groupBy("bucket").transformWithState(make(key, came, gone), "rows binary", "append", time_mode)
    return unpacked_columns(states, gone, ddl)
