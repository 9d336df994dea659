import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from recordmill.operators import commands, metrics, quality
from recordmill.sources.framed import FramedFiles
from recordmill.streaming import buckets, ledgers, runs
from recordmill.streaming.flows import with_quarantine
from recordmill.streaming.ledgers import admission_stream, alarm_stream, chunk_stream, completion_stream, gap_stream
from recordmill.streaming.runs import fed, folder, started

T0 = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """A state store and a worker for each partition of each trigger take longer than these rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


COMMANDS = "job_id string, chunk_id string, at timestamp, event_id long, kind string, attempt int, records long"


def test_quarantine(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, "INVALID_UTF8"), (3, "odd")], "id int, reason string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, reason string").parquet(str(tmp_path / "in"))
    q = with_quarantine(stream, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "mark"))
    q.awaitTermination()
    assert [r.id for r in spark.read.parquet(str(tmp_path / "good")).collect()] == [1]
    bad = spark.read.parquet(str(tmp_path / "bad")).orderBy("id").select("id", "reason")
    assert [tuple(r) for r in bad.collect()] == [(2, "INVALID_UTF8"), (3, "INVALID_CONFIGURATION")]


def outcomes(rows):
    return sorted((r.chunk_id, r.event_id, r.outcome, r.state, r.revision) for r in rows if r.event_id is not None)


def test_chunk_stream_folds_like_the_batch_and_ends_leases(spark):
    kinds = ["acquire", "complete", "start", "fail", "start"]
    rows = [("j", str(k % 3), T0 + timedelta(seconds=k), k, kinds[k % 5], 1 + k % 2, k) for k in range(40)]
    far = [("z", str(k), T0 + timedelta(hours=2 + k), 99 + k, "acquire", 0, 0) for k in range(2)]
    df = spark.createDataFrame(rows + far, COMMANDS)
    slices = F.when(F.col("event_id") < 22, 0).when(F.col("event_id") < 99, 1).when(F.col("event_id") == 99, 2).otherwise(3)
    got = fed(df, slices, 4, chunk_stream, "chunks", F.col("event_id") % 4 == 0).collect()
    log = commands.chunk_log(spark.createDataFrame(rows, COMMANDS))
    assert outcomes([r for r in got if r.job_id == "j"]) == outcomes(log.collect())
    running = {r.chunk_id for r in commands.chunk_states(log).where("state = 'RUNNING'").collect()}
    assert {r.chunk_id for r in got if r.outcome == "leaseExpired" and r.job_id == "j"} == running


def test_late_commands_are_kept_and_redeliveries_move_no_lease(spark):
    at = lambda m: T0 + timedelta(minutes=m)
    first = [("a", "0", at(60), 1, "acquire", 0, 0), ("b", "0", at(60), 2, "acquire", 0, 0)]
    second = [("c", "0", at(54), 3, "acquire", 0, 0)]  # six minutes behind the others
    third = [("d", "0", at(62), 4, "acquire", 0, 0)]
    last = [("e", "0", at(63), 5, "acquire", 0, 0)]
    df = spark.createDataFrame(first + second + third + last, COMMANDS)
    slices = F.when(F.col("event_id") < 3, 0).otherwise(F.col("event_id") - 2)
    # every command comes twice
    got = fed(df, slices, 4, chunk_stream, "late", F.lit(True)).collect()
    assert sorted(r.event_id for r in got if r.event_id) == [1, 2, 3, 4, 5] and all(r.outcome == "applied" for r in got if r.event_id)
    assert [r for r in got if r.outcome == "leaseExpired"] == []


ADMIT = "file_id string, at_us long, event_id long, kind string"


def admissions(n=300):
    rng = random.Random(4)
    kinds = ["deliver"] * 6 + ["VALIDATING", "PLANNING", "PROCESSING", "COMPLETED", "FAILED", "RECEIVED"]
    return [(f"f{rng.randrange(25)}", k * 90_000_000, k, rng.choice(kinds)) for k in range(n)]


def test_admission_stream_is_the_batch_fold(spark):
    df = spark.createDataFrame(admissions(), ADMIT)
    got = fed(df, F.floor(F.col("event_id") / 100), 3, admission_stream, "admission", F.col("event_id") % 3 == 0, clocked=True)
    want = commands.admission_log(df).collect()
    key = lambda r: (r.event_id, r.outcome, r.state, r.revision, r.owner)
    assert sorted(map(key, got.where("event_id is not null").collect()), key=str) == sorted(map(key, want), key=str)
    assert {"acquired", "busy", "alreadyCompleted", "unknown", "applied", "conflict"} <= {r.outcome for r in want}
    assert any(r.outcome == "acquired" and r.revision > 0 for r in want)


def test_admission_leases_run_out_on_the_clock(spark):
    df = spark.createDataFrame([("f", 0, 1, "deliver"), ("g", 0, 2, "deliver"), ("g", 1, 3, "FAILED"), ("h", 0, 4, "deliver")], ADMIT)
    slices = F.when(F.col("file_id") == "h", 1).otherwise(0)
    got = fed(df, slices, 2, lambda s: admission_stream(s, lease_us=1000), "leases", clocked=True).where("outcome = 'leaseExpired'").collect()
    assert [(r.file_id, r.state) for r in got if r.file_id != "h"] == [("f", "RECEIVED")]


RESULTS = "job_id long, chunk_id string, ordinal long, status string, records_read long, records_published long, records_rejected long, records_ignored long, expected_chunks long, sealed boolean"


def test_one_intent_for_each_job(spark):
    rows = []
    for job in range(12):
        for chunk in range(3):
            status = "FAILED" if (job, chunk) == (4, 1) else "RETRY_PENDING" if job == 5 else "COMPLETED"
            rows += [(job, str(chunk), 10 * chunk, status, 7, 6, job % 2, 0, None, None), (job, str(chunk), 10 * chunk + 5, "COMPLETED", 99, 99, 9, 9, None, None)][: 1 if job == 5 else 2]
        rows.append((job, None, 12, None, None, None, None, None, 4 if job == 6 else 3, job != 7))
        rows.append((job, None, 21, None, None, None, None, None, 3, True))
    df = spark.createDataFrame(rows, RESULTS)
    make = lambda s: completion_stream(s.where("chunk_id is not null"), s.where("expected_chunks is not null"))
    got = {r.job_id: r for r in fed(df, F.floor(F.col("ordinal") / 10), 3, make, "intents", F.lit(True), clocked=True).collect()}
    assert fed(df, F.lit(0), 1, make, "intents-once", clocked=True).count() == len(got)
    assert sorted(got) == [0, 1, 2, 3, 4, 7, 8, 9, 10, 11]
    assert (got[0].status, got[0].result, got[0].records_read, got[0].records_rejected) == ("COMPLETED", "SUCCESS", 21, 0)
    assert (got[1].result, got[1].records_rejected) == ("WITH_REJECTIONS", 3)
    assert (got[4].status, got[4].result, got[4].completed, got[4].failed, got[4].records_read) == ("FAILED", None, 2, 1, 14)


def test_ends_and_counters_of_a_bucket_are_folded_together():
    """Against a loop over rows, for three triggers in a row, with a key that is null and one beyond doubles."""
    rng = random.Random(6)
    names = ledgers.COUNTERS
    longs = lambda *c: [pa.field(n, pa.int64()) for n in c]
    key, more = longs("job_id"), [*longs("expected_chunks"), pa.field("sealed", pa.bool_()), *longs("completed", "failed", *names)]
    chunk = pa.field("chunk_id", pa.string())
    ends = ledgers.FirstEnd(["job_id", "chunk_id"], pa.schema([*key, chunk, *longs("ordinal"), pa.field("status", pa.string()), *longs(*names)]), pa.schema([*key, chunk, *more]), 1000)
    jobs = ledgers.JobCounters(["job_id"], pa.schema([*key, *more]), pa.schema([*key, *longs("expected_chunks", "completed", "failed", *names)]), 1000)
    held, kept, seen, state = ends.kept.empty_table(), jobs.kept.empty_table(), set(), {}
    for trigger in range(3):
        rows = [(rng.choice([None, 1, 2, 2**60, 2**60 + 1]), rng.choice("abcd"), i, rng.choice(["COMPLETED", "FAILED"]), *[rng.choice([None, 3, 2**54 + 1]) for _ in names]) for i in rng.sample(range(99), 9)]
        want = []
        for j, c, _, status, *n in sorted(rows, key=lambda r: r[2]):
            if (j, c) not in seen:
                seen.add((j, c))
                done = status == "COMPLETED"
                want.append((j, c, None, None, int(done), int(not done), *[(x or 0) if done else 0 for x in n]))
        held, out = ends.change(held, pa.table(list(zip(*rows)), schema=ends.came), trigger)
        assert list(zip(*out.to_pydict().values())) == want and held.num_rows == len(seen)
        came = [(r[0], *r[2:]) for r in want] + [(rng.choice([None, 1, 2, 2**60]), rng.choice([1, 2, 3]), rng.choice([True, False, None]), 0, 0, *[0] * len(names)) for _ in range(4)]
        rng.shuffle(came)
        intents = set()
        for j, expected, sealed, *n in came:
            s = state.setdefault(j, [None, False, False, *[0] * len(n)])
            if expected is not None and not s[1]:
                s[:2] = expected, bool(sealed)
            s[3:] = [x + y for x, y in zip(s[3:], n)]
        for j in {r[0] for r in came}:
            s = state[j]
            if s[1] and not s[2] and s[3] + s[4] >= s[0]:
                s[2] = True
                intents.add((j, s[0], *s[3:]))
        kept, out = jobs.change(kept, pa.table(list(zip(*came)), schema=jobs.came), trigger)
        assert set(zip(*out.to_pydict().values())) == intents and out.num_rows == len(intents) and kept.num_rows == len(state)
    assert any(s[2] for s in state.values())


class Bucket:
    """One bucket's handle, list and value state, timer and clock."""

    def __init__(self):
        self.values, self.one, self.timers, self.now = [], None, [], 0

    def getListState(self, *_, **__):  # noqa: N802
        outer = self
        return type("L", (), {"get": lambda s: list(outer.values), "appendValue": lambda s, v: outer.values.append(v), "put": lambda s, v: setattr(outer, "values", v), "clear": lambda s: setattr(outer, "values", [])})()

    def getValueState(self, *_, **__):  # noqa: N802
        outer = self
        return type("V", (), {"get": lambda s: outer.one, "update": lambda s, v: setattr(outer, "one", v), "clear": lambda s: setattr(outer, "one", None)})()

    def listTimers(self):  # noqa: N802
        return list(self.timers)

    def deleteTimer(self, t):  # noqa: N802
        self.timers.remove(t)

    def registerTimer(self, t):  # noqa: N802
        self.timers.append(t)

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now

    getCurrentWatermarkInMs = getCurrentProcessingTimeInMs

    def trigger(self, op, rows, now):
        self.now = now
        came = [Row(rows=buckets.written(pa.table(list(zip(*part)), schema=op.came))) for part in (rows[:5], rows[5:]) if part]
        return self.rows(op, op.handleInputRows((0,), came, self))

    def fired(self, op, now):
        self.now = now
        (due,) = self.timers
        assert due <= now
        return self.rows(op, op.handleExpiredTimer((0,), self, type("E", (), {"getExpiryTimeInMs": lambda s: due})()))

    @staticmethod
    def rows(op, told):
        return [tuple(r.values()) for x in told for r in buckets.read(x.rows, op.out).to_pylist()]


def fields(**kinds):
    return pa.schema([pa.field(n, k) for n, k in kinds.items()])


LONG, INT, STRING = pa.int64(), pa.int32(), pa.string()


def test_chunks_of_a_bucket_come_and_go_as_columns():
    """Against a loop over keys, for four triggers that bring some again, with keys that are null."""
    rng = random.Random(8)
    came = fields(job_id=LONG, chunk_id=STRING, event_id=LONG, at_us=LONG, kind=STRING, attempt=INT, records=LONG)
    out = fields(job_id=LONG, chunk_id=STRING, event_id=LONG, outcome=STRING, state=STRING, revision=INT)
    op, bucket = ledgers.ChunkProcessor(["job_id", "chunk_id"], came, out, lease_ms=1000, remember_ms=9000), Bucket()
    op.init(bucket)
    seen, chunks, last, before = set(), {}, {}, []
    for trigger in range(4):
        new = [(rng.choice([None, 1, 2, 2**60 + 1]), rng.choice("ab"), 100 * trigger + i, rng.randrange(10**6), rng.choice(["acquire", "start", "complete", "fail"]), rng.choice([1, 2, 3]), i) for i in range(30)]
        rows = new + before[::3] + new[:4]
        rng.shuffle(rows)
        want = []
        for j, c, i, at, kind, attempt, n in sorted(rows, key=lambda r: (r[3], r[2])):
            if (j, c, i) not in seen:
                seen.add((j, c, i))
                chunk = chunks.setdefault((j, c), commands.Chunk())
                want.append((j, c, i, commands.on_chunk(chunk, kind, attempt, n), chunk.state, chunk.revision))
                last[j, c] = max(last.get((j, c), 0), at // 1000)
        assert sorted(bucket.trigger(op, rows, 0), key=str) == sorted(want, key=str)
        before = new
    assert len(bucket.values) == 4 and bucket.trigger(op, before, 0) == []  # a value a trigger, none for redeliveries alone
    running = {k for k, c in chunks.items() if c.state == "RUNNING"}
    assert bucket.timers == [min(last[k] + (1000 if k in running else 9000) for k in chunks)] and running
    late = bucket.fired(op, 2500)
    assert {r[:2] for r in late} == running and {r[2:4] for r in late} == {(None, "leaseExpired")} and len(late) == len(running)
    assert bucket.trigger(op, before, 2500) == []
    assert bucket.fired(op, 20_000) == [] and bucket.timers == [] and bucket.values == []
    assert len(bucket.trigger(op, before, 20_000)) == len(before)  # forgotten


def test_admissions_of_a_bucket_come_and_go_as_columns():
    rng = random.Random(9)
    came, out = fields(file_id=STRING, event_id=LONG, at_us=LONG, kind=STRING), fields(file_id=STRING, event_id=LONG, outcome=STRING, state=STRING, revision=INT, owner=LONG)
    op, bucket = ledgers.AdmissionProcessor(["file_id"], came, out, lease_us=10**7, retention_ms=10**6), Bucket()
    op.init(bucket)
    rows = [(f, i, at * 1000, kind) for f, i, at, kind in ((rng.choice(["a", "b", None, "c"]), k, k, rng.choice(["deliver", "VALIDATING", "PLANNING", "FAILED"])) for k in range(60))]
    jobs, want = {}, []
    for f, i, at, kind in rows:
        job = jobs.setdefault(f, commands.Admitted())
        want.append((f, i, commands.on_admission(job, kind, at, i, 10**7), job.state, job.revision, job.owner))
    got = [r for k in range(3) for r in bucket.trigger(op, rows[20 * k : 20 * k + 20] + rows[20 * k - 20 : 20 * k : 3] * (k > 0), k)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bucket.trigger(op, [("new", 99, 0, "VALIDATING")], 3) == [("new", 99, "unknown", None, 0, None)]
    early = {f for f, job in jobs.items() if job.state in commands.EARLY}
    assert {r[0] for r in bucket.fired(op, 20_000)} == early and bucket.timers == []
    assert bucket.trigger(op, [("a", 100, 0, "deliver")], 2 * 10**6)[0][2] == "acquired"  # forgotten by then


def test_job_states_of_a_bucket_come_and_go_as_columns():
    rng = random.Random(10)
    came, out = fields(job_id=LONG, event_id=LONG, at_us=LONG, state=STRING), fields(job_id=LONG, state=STRING, events=LONG)
    op, bucket = ledgers.JobState(["job_id"], came, out, ids_ms=1000), Bucket()
    op.init(bucket)
    seen, before = {}, []
    for trigger in range(4):
        new = [(rng.choice([None, 1, 2, 2**60]), 100 * trigger + i, rng.randrange(6), rng.choice(["A", "B", None])) for i in range(12)]
        rows = new + before[::3] + new[:3]
        for j, i, at, state in rows:
            seen.setdefault(j, {})[i] = (at, i, state)
        want = {(j, max(seen[j].values(), key=lambda e: e[:2])[2], len(seen[j])) for j in {r[0] for r in rows}}
        got = bucket.trigger(op, rows, trigger)
        assert set(got) == want and len(got) == len(want)
        before = new
    assert set(bucket.trigger(op, before, 9)) == {r for r in {(j, max(seen[j].values(), key=lambda e: e[:2])[2], len(seen[j])) for j in {r[0] for r in before}}}


def test_a_stream_keeps_its_state_in_as_many_partitions_as_cores_need(spark, monkeypatch):
    queries, start = [], runs.started
    monkeypatch.setattr(runs, "started", lambda *a, **k: queries.append(start(*a, **k)) or queries[-1])
    monkeypatch.setattr(runs, "STATE_PARTITIONS", 1)
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    df = spark.range(30).selectExpr("id % 10 AS job_id", "id AS event_id", "timestamp_seconds(id) AS at", "string(id) AS state")
    got = fed(df, F.lit(0), 1, ledgers.state_stream, "few", clocked=True)
    assert {r.job_id: (r.state, r.events) for r in got.collect()} == {k: (str(20 + k), 3) for k in range(10)}
    assert queries[0].lastProgress["stateOperators"][0]["numShufflePartitions"] == 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.shuffle.partitions") == "50"


def rows_of_state(spark, monkeypatch, make, *columns):
    """Of a stream over 8000 keys: what is read and written one by one, and takes a trigger's time."""
    queries, start = [], runs.started
    monkeypatch.setattr(runs, "started", lambda *a, **k: queries.append(start(*a, **k)) or queries[-1])
    out = fed(spark.range(8000).selectExpr(*columns), F.lit(0), 1, make, "rows", clocked=True)
    assert out.where("state = 'RECEIVED'").count() == 8000
    return queries[0].lastProgress["stateOperators"][0]["numRowsTotal"]


def test_admissions_have_two_rows_of_state_for_a_bucket(spark, monkeypatch):
    n = rows_of_state(spark, monkeypatch, admission_stream, "id AS file_id", "id AS at_us", "id AS event_id", "'deliver' AS kind")
    assert n <= 2 * buckets.COLUMN_BUCKETS


def test_job_states_have_two_rows_of_state_for_a_bucket(spark, monkeypatch):
    n = rows_of_state(spark, monkeypatch, ledgers.state_stream, "id AS job_id", "id AS event_id", "timestamp_seconds(id) AS at", "'RECEIVED' AS state")
    assert n <= 2 * buckets.COLUMN_BUCKETS


def test_gaps_are_known_after_each_trigger(spark):
    rng = random.Random(2)
    rows = [(g, rng.randrange(1, 60), k) for k, g in enumerate(rng.choices("ab", k=120))]
    df = spark.createDataFrame(rows, "g string, o long, k long")
    got = {(r.group, r.trigger): (r.n_missing, r.missing) for r in fed(df, F.floor(F.col("k") / 40), 3, lambda s: gap_stream(s, "g", "o", 1, 10), "gaps", F.col("k") % 5 == 0).collect()}
    for trigger in (1, 2, 3):
        upto = df.where(F.col("k") < 40 * trigger)
        want = {}
        for r in quality.gaps(upto, "g", "o", 1, 10).collect():
            want.setdefault(r.group if "group" in r else r.g, []).append(r.missing)
        for g in "ab":
            assert got[g, trigger][1] == sorted(want.get(g, []))
            seen = {o for x, o, k in rows if x == g and k < 40 * trigger}
            assert got[g, trigger][0] == max(seen) - len(seen)


def test_keys_share_the_state_of_a_bucket(spark, monkeypatch):
    queries, start = [], runs.started
    monkeypatch.setattr(runs, "started", lambda *a, **k: queries.append(start(*a, **k)) or queries[-1])
    df = spark.range(1200).selectExpr("id % 300 AS g", "1 + id * 7 % 11 AS o", "id % 2 AS k").withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = [fed(df, F.col("k"), 2, lambda s, n=n: gap_stream(s, "g", "o", 1, 3, buckets=n), "shared", F.lit(True)) for n in (3, 1000)]
    assert all(q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 for q in queries[:2])
    few, many = (sorted(map(str, x.collect())) for x in got)
    assert few == many and len(few) == 300 + 150  # odd groups come in the second slice only


def test_a_key_of_many_ordinals_is_merged_as_one_of_few():
    rng = random.Random(5)
    for n in (0, 1, 5, 40):
        old = sorted(rng.sample(range(0, 400, 4), 9))
        new = [rng.randrange(400) for _ in range(n)]
        a, b = ledgers.merged(np.array(old), np.array(old) + 1, np.unique(np.array(new, np.int64)))
        assert ledgers.merged_few(old, [o + 1 for o in old], new) == (a.tolist(), b.tolist())


def test_alarms_of_two_periods_in_a_row(spark):
    rng = random.Random(3)
    rows = [(k, T0 + timedelta(seconds=30 * k), rng.random() < 0.5) for k in range(400)] + [(400, T0 + timedelta(days=2), False)]
    df = spark.createDataFrame(rows, "k int, at timestamp, bad boolean")
    got = fed(df, F.floor(F.col("k") / 134), 3, lambda s: alarm_stream(s, "at", F.col("bad"), 5, "300 seconds", 2), "alarms")
    want = metrics.alarms(df, "at", F.col("bad"), 5, "300 seconds", 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 3


def test_files_are_read_once_whatever_their_names(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.dataSource.register(FramedFiles)
    out, mark = folder(spark, "files"), folder(spark, "files-checkpoint")
    for names in (["b", "c"], ["a"], [], ["d", "aa"]):
        for name in names:
            (tmp_path / "in" / name).write_text(f"{name}-1\n{name}-2\n")
        started(spark.readStream.format("framed_file").option("path", str(tmp_path / "in")).load(), out, mark).awaitTermination()
    assert sorted(r.raw for r in spark.read.parquet(out).collect()) == [f"{n}-{k}" for n in ("a", "aa", "b", "c", "d") for k in (1, 2)]


@pytest.mark.parametrize("age", [1, 7 * 86_400])
def test_offsets_of_files(tmp_path, age):
    import os

    from recordmill.sources.framed import FramedStreamReader

    reader = FramedStreamReader({"path": str(tmp_path), "maxfileage": str(age)})
    put = lambda name, at: ((tmp_path / name).write_text("x\n"), os.utime(tmp_path / name, (at, at)))
    names = lambda parts: sorted(p.file.path.rsplit("/", 1)[1] for p in parts)
    start = reader.initialOffset()
    put("b", 1000), put("c", 1010)
    one = reader.latestOffset()
    assert names(reader.partitions(start, one)) == ["b", "c"] and len(one["seen"]) == (1 if age == 1 else 2)
    put("a", 1009.5), put("old", 5)
    two = reader.latestOffset()
    assert names(reader.partitions(one, two)) == (["a"] if age == 1 else ["a", "old"])
    put("b", 1020)
    assert names(reader.partitions(two, reader.latestOffset())) == ["b"]
