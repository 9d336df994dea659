"""Functions that no query calls."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordmill.functions import sizes
from recordmill.operators import commands, config, ledger, ops, quality
from recordmill.operators.envelope import localised, redacted, split_by_size
from recordmill.sources.sinks import write_by_route, write_csv, write_reports


def test_reports_by_route_and_key(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", 2, "y")], "id string, n int, route string")
    write_reports(str(tmp_path / "r"), events=df.limit(0), summary=df)
    assert spark.read.json(str(tmp_path / "r" / "summary")).count() == 3
    from recordmill.sources.sinks import write_report

    write_report(df, str(tmp_path / "once"), "id")
    assert spark.read.json(str(tmp_path / "once")).count() == 2
    write_by_route(df, str(tmp_path / "routes"))
    assert (tmp_path / "routes" / "route=y").is_dir() and spark.read.parquet(str(tmp_path / "routes")).count() == 3


def test_csv_with_its_mark(spark, tmp_path):
    write_csv(spark.createDataFrame([("a;b", 1), ("é", None)], "t string, n int").coalesce(1), str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("part-*")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbft;n\n") and sorted(text.decode("utf-8-sig").splitlines()[1:]) == ['"a;b";1', "é;"]


def test_configs_and_jobs_on_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "p" / "q").mkdir(parents=True)
    for k in range(2):
        (tmp_path / "p" / "q" / f"{k}.json").write_text(json.dumps({"bucket": "b", "prefix": f"p{k}/", "name": f"n{k}"}, indent=2))
    assert sorted(r.name for r in config.read_configs(spark, str(tmp_path / "p"), "bucket string, prefix string, name string").collect()) == ["n0", "n1"]
    jobs = spark.createDataFrame([("j1", "PLANNING", datetime(2020, 1, 1)), ("j2", "COMPLETED", datetime(2020, 1, 2))], "job_id string, state string, updated_at timestamp")
    jobs.write.parquet(str(tmp_path / "jobs"))
    where = ["--jobs", str(tmp_path / "jobs")]
    assert ops.main([*where, "--job-id", "j2"]) == 0 and json.loads(capsys.readouterr().out)["state"] == "COMPLETED"
    assert ops.main([*where, "--job-id", "none"]) == 1
    assert ops.main([*where, "--status", "PLANNING", "--before", "2020-01-01"]) == 0 and capsys.readouterr().out.strip() == ""
    assert ops.main([*where, "--stuck", "1 hour"]) == 0 and json.loads(capsys.readouterr().out)["job_id"] == "j1"
    with pytest.raises(SystemExit):
        ops.main(where)


def test_summaries_have_no_nulls(spark):
    df = spark.createDataFrame([("j", None, None, None, None)], "job_id string, reason string, n long, sealed boolean, at timestamp")
    assert tuple(ops.summaries(df).first()) == ("j", "", 0, False, None)


def test_events_that_are_too_large_fail_their_chunk(spark):
    df = spark.createDataFrame([(5,), (2_000_000,)], "message_bytes long")
    good, bad = split_by_size(df)
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match="MESSAGE_TOO_LARGE"):
        split_by_size(df, fail=True)[0].collect()


def test_small_columns(spark):
    one = lambda *c: tuple(spark.range(1).select(*c).first())
    assert one(sizes.utilisation(F.lit(1.0), F.lit(2.0), F.lit(4.0)), sizes.utilisation(F.lit(1.0), F.lit(2.0), F.lit(0.0)), sizes.speedup(F.lit(6.0), F.lit(2.0)), sizes.speedup(F.lit(6.0), F.lit(0.0))) == (75.0, 0.0, 3.0, 0.0)
    assert one(sizes.contains_all_terms(F.lit("The quick fox"), F.lit(" FOX  the")), sizes.contains_all_terms(F.lit("The fox"), F.lit("dog"))) == (True, False)
    assert one(sizes.duration(F.lit(250)), sizes.duration(F.lit(1250)), sizes.valid_zone(F.lit("+14:59")), sizes.valid_zone(F.lit("+15:00"))) == ("250ms", "1.250s", True, False)
    df = spark.createDataFrame([("secret", datetime(2024, 1, 1), datetime(2024, 1, 1))], "url string, createdAt timestamp, other timestamp")
    assert tuple(localised(redacted(df, "url"), "-03:00").first()) == ("", datetime(2023, 12, 31, 21), datetime(2024, 1, 1))


def test_ledger_folds_without_a_query(spark):
    jobs = spark.createDataFrame([("a", 100), ("b", 2_000_000_000)], "job_id string, expires_at long")
    assert [r.job_id for r in ledger.unexpired(jobs, F.timestamp_seconds(F.lit(1000))).collect()] == ["b"]
    assert [r.job_id for r in ledger.new_keys(spark.createDataFrame([("a",), ("c",), ("c",)], "job_id string"), jobs, "job_id").collect()] == ["c"]
    assert [r.job_id for r in ops.get_job(jobs, "b").collect()] == ["b"]
    plan = spark.createDataFrame([("j", "1", 0, 9), ("j", "1", 0, 9), ("j", "2", 0, 9), ("j", "2", 0, 8)], "job_id string, chunk_id string, start_byte int, end_byte int")
    once, conflicts = ledger.sealed_once(plan)
    assert once.count() == 2 and [tuple(r) for r in conflicts.collect()] == [("j", "2")]
    ids = spark.createDataFrame([("e1", "s1"), ("e2", "s1"), ("e3", None)], "e string, s string")
    assert tuple(quality.all_unique(ids, "e", "s").first()) == (3, 0, 1)
    sent = spark.createDataFrame([("m", datetime(2024, 1, 1, 0, 0, 0)), ("m", datetime(2024, 1, 1, 0, 0, 1)), ("n", datetime(2023, 1, 1))], "message_id string, sent_at timestamp")
    assert [r.message_id for r in quality.snapshot(sent, F.lit(datetime(2024, 1, 1, 0, 0, 1))).collect()] == ["m"]


def test_a_running_chunk_has_the_token_of_its_attempt(spark):
    rows = [("j", "1", datetime(2024, 1, 1, 0, 0, k), k, kind, attempt, 5) for k, (kind, attempt) in enumerate([("acquire", 0), ("fail", 1), ("start", 2), ("complete", 2)])]
    log = commands.chunk_log(spark.createDataFrame(rows, "job_id string, chunk_id string, at timestamp, event_id int, kind string, attempt int, records long")).orderBy("event_id").collect()
    assert [(r.outcome, r.state, r.attempt) for r in log] == [("applied", "RUNNING", 1), ("applied", "RETRY_PENDING", 1), ("applied", "RUNNING", 2), ("applied", "COMPLETED", 2)]
    assert log[0].token and log[2].token and log[0].token != log[2].token and len(log[0].token) == 36 and log[1].token is log[3].token is None
