"""A message queue as a Spark sink: sent in batches, failures by message, committed once.

    spark.dataSource.register(MessageQueue)
    df.writeStream.format("message_queue").option("path", folder).option("checkpointLocation", ...).start()
    spark.read.format("message_queue").option("path", folder).load()                        # messages
    spark.read.format("message_queue").option("path", folder).option("failures", "true").load()

Rows: message_id, body. A task sends its rows in batches of at most ten messages and 1 MiB, tries what
failed for a passing reason up to three times, and stages what was taken in a file of its attempt;
messages that are refused for good come with a code. The files of a trigger become visible together,
when the driver commits it, by one rename, and a trigger that is there already is not committed again:
a task that is killed, a trigger that is repeated or a driver that restarts repeats no message.
Tasks hand the driver names and counts only. The folder must be a mounted one.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage

from recordmill.sources.ranges import mounted

#: What a batch and a message may hold.
BATCH_MESSAGES, BATCH_BYTES, OVERHEAD = 10, 1_048_576, 64
ATTEMPTS, WAIT_SECONDS = 3, 0.05
PERMANENT = ("InvalidMessageContents", "BatchRequestTooLong")
MESSAGES = pa.schema([("message_id", pa.string()), ("body", pa.string())])
FAILURES = pa.schema([("message_id", pa.string()), ("code", pa.string()), ("attempts", pa.int32())])
DDL = {"messages": "message_id string, body string", "failures": "message_id string, code string, attempts int"}
STAGED = "_staged"
#: A task holds so many bodies or bytes of them, writing (a row group) as well as reading.
HELD_MESSAGES, HELD_BYTES = 1000, 4 * BATCH_BYTES


@dataclass
class Staged(WriterCommitMessage):
    """What a task attempt has staged, and where: a stream commits in another process."""

    folder: str
    name: str
    sent: int
    failed: int
    calls: int


class Queue:
    """Takes batches; answers with (index, code) of the messages that it did not take.

    This one refuses bodies beyond ``most`` bytes and control characters; a subclass sends elsewhere."""

    def __init__(self, most: int = BATCH_BYTES) -> None:
        self.most = most

    def send(self, batch: list[tuple[str, str]]) -> list[tuple[int, str]]:
        out = []
        for i, (_, body) in enumerate(batch):
            if len(body.encode()) + OVERHEAD > self.most:
                out.append((i, "BatchRequestTooLong"))
            elif any(c < " " and c not in "\t\n\r" for c in body):
                out.append((i, "InvalidMessageContents"))
        return out


def batches(rows: Iterator[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
    """In order, as many as fit; a message that is too large by itself goes alone."""
    held, size = [], 0
    for message_id, body in rows:
        n = len(body.encode()) + OVERHEAD
        if held and (len(held) == BATCH_MESSAGES or size + n > BATCH_BYTES):
            yield held
            held, size = [], 0
        held.append((message_id, body))
        size += n
    if held:
        yield held


def sent(queue: Queue, batch: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], list[tuple[str, str, int]], int]:
    """Taken messages, failures (id, code, attempts), and calls: only what failed is tried again, and
    only if its code is not a permanent one."""
    left, taken, failed = batch, [], []
    for attempt in range(1, ATTEMPTS + 1):
        codes = dict(queue.send(left))
        taken += [m for i, m in enumerate(left) if i not in codes]
        over = [(m, codes[i]) for i, m in enumerate(left) if i in codes]
        failed += [(m[0], code, attempt) for m, code in over if code in PERMANENT or attempt == ATTEMPTS]
        left = [m for m, code in over if code not in PERMANENT and attempt < ATTEMPTS]
        if not left:
            return taken, failed, attempt
        time.sleep(WAIT_SECONDS * 2 ** (attempt - 1))
    return taken, failed, ATTEMPTS


class Sending(DataSourceWriter):
    def __init__(self, root: str, make_queue, key: str | None = None) -> None:
        self.root, self.make_queue, self.key = root, make_queue, key or f"run-{uuid.uuid4().hex}"

    def write(self, iterator) -> Staged:
        name, queue = uuid.uuid4().hex, self.make_queue()
        folders = {k: os.path.join(self.root, STAGED, self.key, k) for k in ("messages", "failures")}
        for f in folders.values():
            os.makedirs(f, exist_ok=True)
        counts = [0, 0, 0]
        rows = ((r["message_id"], r["body"]) for r in iterator)
        with pq.ParquetWriter(f"{folders['messages']}/{name}.parquet", MESSAGES) as good, pq.ParquetWriter(f"{folders['failures']}/{name}.parquet", FAILURES) as bad:
            held: tuple[list, list] = ([], [])
            size = 0

            def flush() -> None:
                for out, kept, schema in ((good, held[0], MESSAGES), (bad, held[1], FAILURES)):
                    if kept:
                        out.write_table(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), schema.types, strict=True)], schema=schema))
                        kept.clear()

            for batch in batches(rows):
                taken, failed, calls = sent(queue, batch)
                held[0].extend(taken)
                held[1].extend(failed)
                counts = [a + b for a, b in zip(counts, (len(taken), len(failed), calls), strict=True)]
                size += sum(len(body.encode()) for _, body in taken)
                if len(held[0]) + len(held[1]) >= HELD_MESSAGES or size >= HELD_BYTES:
                    flush()
                    size = 0
            flush()
        return Staged(os.path.join(self.root, STAGED, self.key), name, *counts)

    def publish(self, messages: list[Staged | None], key: str) -> None:
        """Only files that a finished attempt names; one rename shows them all."""
        final = os.path.join(self.root, key)
        if os.path.isdir(final):
            return
        ready = os.path.join(self.root, STAGED, uuid.uuid4().hex)
        for kind in ("messages", "failures"):
            os.makedirs(os.path.join(ready, kind))
            for m in messages:
                if m is not None:
                    os.replace(os.path.join(m.folder, kind, f"{m.name}.parquet"), os.path.join(ready, kind, f"{m.name}.parquet"))
        try:
            os.rename(ready, final)
        except OSError:
            if not os.path.isdir(final):
                raise

    def commit(self, messages) -> None:
        self.publish(messages, self.key)

    def abort(self, messages) -> None:
        """What was staged stays out of sight."""


class SendingStream(Sending, DataSourceStreamWriter):
    """A trigger is named by its number, so one that comes again after a restart is known."""

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        self.publish(messages, f"batch-{batchId:012d}")

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        pass


class Files(InputPartition):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class Committed(DataSourceReader):
    """The committed files, some MB of them a partition."""

    def __init__(self, root: str, kind: str) -> None:
        self.root, self.kind = root, kind

    def partitions(self) -> list[Files]:
        out, size = [Files([])], 0
        for trigger in sorted(os.listdir(self.root)) if os.path.isdir(self.root) else []:
            folder = os.path.join(self.root, trigger, self.kind)
            for name in sorted(os.listdir(folder)) if os.path.isdir(folder) and not trigger.startswith("_") else []:
                path = os.path.join(folder, name)
                if size > 64 * 1024 * 1024:
                    out.append(Files([]))
                    size = 0
                out[-1].names.append(path)
                size += os.path.getsize(path)
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for name in partition.names:
            with pq.ParquetFile(name) as f:
                for group in range(f.num_row_groups):  # batches across them would be of 65,536 bodies
                    yield from f.iter_batches(HELD_MESSAGES, row_groups=[group])


class MessageQueue(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_queue"

    def schema(self) -> str:
        return DDL[self.kind()]

    def kind(self) -> str:
        return "failures" if self.options.get("failures", "false").lower() == "true" else "messages"

    def root(self) -> str:
        path = mounted(self.options["path"])
        if path is None:
            raise ValueError(f"{self.options['path']} is no mounted folder")
        return path

    def queue(self):
        """Makes the queue in a task."""
        most = int(self.options.get("maxmessagebytes", self.options.get("maxMessageBytes", BATCH_BYTES)))
        return lambda: Queue(most)

    def reader(self, schema) -> Committed:
        return Committed(self.root(), self.kind())

    def writer(self, schema, overwrite: bool) -> Sending:
        """A batch write may name itself by the option ``key``: then it is committed once."""
        return Sending(self.root(), self.queue(), self.options.get("key"))

    def streamWriter(self, schema, overwrite: bool) -> SendingStream:  # noqa: N802
        return SendingStream(self.root(), self.queue())


def deliver(outbox: DataFrame, path: str) -> DataFrame:
    """outbox: message_id, body. Sends what the queue at ``path`` does not hold yet and returns the
    failures of all deliveries so far. What is committed is delivered, so a crash at any place, or a
    second call, repeats nothing; failed messages are tried again by the next call."""
    spark = outbox.sparkSession
    spark.dataSource.register(MessageQueue)
    there = spark.read.format("message_queue").option("path", path).load().select("message_id").distinct()
    outbox.join(there, "message_id", "left_anti").select("message_id", "body").write.format("message_queue").option("path", path).mode("append").save()
    return spark.read.format("message_queue").option("path", path).option("failures", "true").load()
