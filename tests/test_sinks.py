"""The queue sink, the outbox, redelivery, the clustered ledger, and small readers and reports."""

import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from recordmill.operators.config import Settings, read_limits
from recordmill.operators.layout import partition_of, scanned_rows, status_range, write_clustered
from recordmill.operators.localise import local_moment, localised_documents, zone_of
from recordmill.operators.metrics import report_matrix, run_totals
from recordmill.sources.messages import ATTEMPTS, Committed, MessageQueue, Queue, Sending, batches, deliver, sent
from recordmill.sources.sinks import write_files
from recordmill.streaming.redelivery import enqueue, publish_once, redelivered, settled
from recordmill.streaming.runs import folder


class Flaky(Queue):
    """Takes the others; b only at the third try, p never."""

    def __init__(self):
        super().__init__()
        self.calls = []

    def send(self, batch):
        self.calls.append([m for m, _ in batch])
        return [(i, "Throttled") for i, (m, _) in enumerate(batch) if m == "b" and len(self.calls) < 3 or m == "t"] + [(i, "InvalidMessageContents") for i, (m, _) in enumerate(batch) if m == "p"]


def test_only_what_failed_is_sent_again():
    q = Flaky()
    taken, failed, calls = sent(q, [("a", ""), ("b", ""), ("p", ""), ("t", "")])
    assert q.calls == [["a", "b", "p", "t"], ["b", "t"], ["b", "t"]] and calls == ATTEMPTS
    assert sorted(m for m, _ in taken) == ["a", "b"] and sorted(failed) == [("p", "InvalidMessageContents", 1), ("t", "Throttled", 3)]


def test_batches_are_bounded():
    got = list(batches(iter([(str(i), "x" * n) for i, n in enumerate([1] * 12 + [600_000, 600_000, 2_000_000, 1])])))
    assert [len(b) for b in got] == [10, 3, 1, 1, 1]


def test_a_task_holds_few_bodies(tmp_path):
    writer = Sending(str(tmp_path), Queue)
    writer.publish([writer.write({"message_id": str(k), "body": "x" * size} for size, n in ((10, 2500), (1_000_000, 30)) for k in range(n))], writer.key)
    (part,) = Committed(str(tmp_path), "messages").partitions()
    assert pq.ParquetFile(part.names[0]).metadata.num_rows == 2530
    read = list(Committed(str(tmp_path), "messages").read(part))
    assert sum(b.num_rows for b in read) == 2530 and all(b.num_rows <= 1000 and b.nbytes < 8_000_000 for b in read)


def test_a_trigger_that_fails_half_way_repeats_no_message(spark, tmp_path):
    spark.dataSource.register(MessageQueue)
    rows = spark.range(400).select(F.concat(F.lit("m"), "id").alias("message_id"), F.when(F.col("id") % 50 == 0, "\x01").otherwise("body").alias("body"))
    rows.repartition(4).write.parquet(str(tmp_path / "in" / "0"))
    out, mark, flag = str(tmp_path / "queue"), str(tmp_path / "mark"), str(tmp_path / "flag")

    def breaks(batches):
        for k, b in enumerate(batches):
            yield b
            if k == 0 and not os.path.exists(flag):
                open(flag, "w").close()
                raise ValueError("killed")

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in" / "*")).mapInArrow(breaks, rows.schema)
        stream.writeStream.format("message_queue").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    read = lambda **o: spark.read.format("message_queue").option("path", out).options(**o).load()
    assert read().count() == 0
    run()
    run()
    assert read().count() == read().distinct().count() == 392
    assert sorted((r.message_id, r.code, r.attempts) for r in read(failures="true").collect()) == sorted((f"m{k}", "InvalidMessageContents", 1) for k in range(0, 400, 50))


def test_the_outbox_is_delivered_once(spark, tmp_path):
    box = spark.range(30).select(F.concat(F.lit("c"), "id").alias("message_id"), F.lit("x").alias("body"))
    for part in (box.limit(10), box, box):
        assert deliver(part, str(tmp_path / "out")).count() == 0
    rows = spark.read.format("message_queue").option("path", str(tmp_path / "out")).load()
    assert rows.count() == rows.distinct().count() == 30


def test_messages_that_keep_failing_are_dead_once(spark):
    queue, done, dead, mark = (folder(spark, f"q{x}") for x in ("", "-done", "-dead", "-mark"))
    enqueue(spark.createDataFrame([(f"m{k}", str(k)) for k in range(20)], "message_id string, body string"), queue)
    assert not enqueue(spark.createDataFrame([("again", "")], "message_id string, body string"), queue)
    n = F.col("body").cast("int")
    bad = lambda b: b.where((n % 4 == 0) | ((n % 3 == 0) & (F.col("receive_count") < 3))).select("message_id", F.lit("no").alias("error"))
    good, lost = settled(spark, queue, done, dead, mark, bad)
    assert sorted((r.message_id, r.receive_count) for r in lost.collect()) == sorted((f"m{k}", 3) for k in range(0, 20, 4))
    assert sorted((r.message_id, r.receive_count) for r in good.collect()) == sorted((f"m{k}", 3 if k % 3 == 0 else 1) for k in range(20) if k % 4)
    # nothing is left, and a run more changes nothing
    redelivered(spark, queue, done, dead, mark, bad).awaitTermination()
    assert spark.read.parquet(dead).count() == 5


def test_publish_once(spark, tmp_path):
    path = f"file://{tmp_path}/a/b"
    assert publish_once(spark.range(3), path) and not publish_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3


def test_the_clustered_ledger_reads_few_rows(spark, tmp_path):
    n = 60_000
    rows = spark.range(n).select(F.format_string("JOB#%06d", (F.col("id") % 3000).cast("int")).alias("pk"), F.format_string("CHUNK#%05d", F.col("id").cast("int")).alias("sk"), F.element_at(F.array(*map(F.lit, "PQRS")), (F.col("id") % 4 + 1).cast("int")).alias("status"), F.timestamp_seconds(F.col("id") * 60).alias("updated_at"))
    write_clustered(rows, str(tmp_path / "t"), "pk", "sk", files=8, row_group_bytes=50_000)
    write_clustered(rows, str(tmp_path / "s"), "status", "updated_at", files=8, row_group_bytes=50_000)
    one = partition_of(spark, str(tmp_path / "t"), "JOB#000042", "CHUNK#")
    assert one.count() == 20 and one.first().sk == "CHUNK#00042"
    assert scanned_rows(one)[1] < n / 4
    assert scanned_rows(partition_of(spark, str(tmp_path / "t"), "JOB#000042x"))[1] == 0  # in a file's range: the bloom filter knows
    few = status_range(spark, str(tmp_path / "s"), "R", F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(6000)))
    assert few.count() == 25 and scanned_rows(few)[1] < n / 4
    assert status_range(spark, str(tmp_path / "s"), "R", None, F.timestamp_seconds(F.lit(120))).count() == 0
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write_clustered(rows, str(tmp_path / "t"), "pk", "sk")


@pytest.mark.parametrize(("value", "want"), [("2024-01-01T00:30:00Z", "2023-12-31T21:30:00-03:00"), ("2024-01-01T00:30:00.120+02:00", "2023-12-31T19:30:00.12-03:00"), ("2024-13-01T00:00:00Z", None), ("soon", None), ("2024-01-01", None)])
def test_moments(value, want):
    assert local_moment(value, zone_of("-03:00")) == (want or value)


def test_only_times_change(spark):
    doc = '{"a" :{"createdAt":\t"2024-01-01T03:00:00Z","x":["\\"doneAt\\":\\"2024-01-01T03:00:00Z\\"",{"timestamp":"2024-07-01T03:00:00.500Z" , "n":1.0}]},"atAt":5,"c\\u0041t":"é"}'
    want = doc.replace('"2024-01-01T03:00:00Z","x"', '"2024-01-01T00:00:00-03:00","x"').replace("2024-07-01T03:00:00.500Z", "2024-07-01T00:00:00.5-03:00")
    rows = spark.createDataFrame([(doc,), ('{"createdAt":"2024-01-01T03:00:00Z"',), (None,)], "d string")
    assert [r.d for r in localised_documents(rows, "d", "America/Sao_Paulo").collect()] == [want, '{"createdAt":"2024-01-01T03:00:00Z"', None]
    assert localised_documents(rows, "d", "UTC").first().d == doc.replace(".500Z", ".5Z")


def test_limits_are_read_and_checked(spark, tmp_path):
    good = {"maxFileBytes": 10**9, "maxChunkBytes": 10**8, "maxEventBytes": 500_000, "maxBatchSize": 8, "inputTypes": {t: {"maxFileBytes": 10**6, "maxRecordBytes": 1000} for t in ("text", "json", "multi-line")}}
    for name, doc in (("good", good), ("bad", good | {"maxBatchSize": 11, "inputTypes": {}})):
        (tmp_path / name).mkdir()
        (tmp_path / name / "limits.json").write_text(json.dumps(doc, indent=1))
    got = read_limits(spark, str(tmp_path / "good"))
    assert got.max_batch_size == 8 and got.types["json"] == (10**6, 1000)
    with pytest.raises(ValueError, match="BATCH_SIZE, TYPES"):
        read_limits(spark, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="more than one"):
        read_limits(spark, str(tmp_path / "*"))


def test_settings_of_the_environment(monkeypatch):
    monkeypatch.setenv("RECORDMILL_BATCH_SIZE", "7")
    assert Settings.from_env().batch_size == 7 and Settings.from_env().max_attempts == 3
    monkeypatch.setenv("RECORDMILL_BATCH_SIZE", "11")
    with pytest.raises(ValueError, match="batch_size"):
        Settings.from_env()


def test_totals_and_matrix(spark):
    runs = spark.createDataFrame([("a", 5), ("b", 7), ("a", 1)], "name string, records int")
    letters = spark.createDataFrame([("intake",), ("chunk",), ("chunk",)], "queue string")
    assert tuple(run_totals(runs, letters).first()) == (2, 13, 1, 2, 0)
    assert tuple(run_totals(runs.limit(0), letters.limit(0)).first()) == (0, 0, 0, 0, 0)
    cases = spark.createDataFrame([(512, "x"), (128, "y"), (128, "a"), (128, "y")], "memory int, stage string")
    assert [tuple(r) for r in report_matrix(cases).collect()] == [(128, "a", [128, 512]), (128, "y", [128, 512]), (512, "x", [128, 512])]


def test_files_go_to_mounted_folders_only(spark):
    with pytest.raises(ValueError, match="no mounted folder"):
        write_files(spark.createDataFrame([("a", b"")], "name string, content binary"), "s3a://bucket/x")
