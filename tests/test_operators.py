import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from recordmill.functions import identity, sizes, states
from recordmill.functions.validate import attribute_rules, errors, split_valid, url_allowed
from recordmill.operators import commands, config, ledger, metrics, ops, quality
from recordmill.operators.bundles import greedy, packed
from recordmill.plans.planner import balanced_tiles, chunk_count, pinned_version, tiles


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_identities(spark):
    import hashlib

    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    a = [F.lit(x) for x in ("b", "k/1", None, "e", 7)]
    got = one(spark, identity.file_id(*a), identity.bundle_id(F.array(F.lit("z"), F.lit("a"))), identity.completion_id(F.lit("j"), F.lit(1)), identity.completion_token(F.lit("j"), F.lit("c"), F.lit(1), F.lit(0)))
    assert got == (h("b/k/1//e/7"), h("az"), h("j/completion/1"), h("j\0c\0" + "1\0" + "0")[:36])


def test_scalars(spark):
    names = [one(spark, sizes.base_name(F.lit(x)))[0] for x in ("a/b.txt", "a/b/", "", "///")]
    assert names == ["b.txt", "b", ".", "/"]
    assert one(spark, sizes.duration(F.lit(250)), sizes.duration(F.lit(1250)), sizes.throughput(F.lit(5), F.lit(0))) == ("250ms", "1.250s", 0.0)
    assert one(spark, *[sizes.valid_zone(F.lit(x)) for x in ("-03:00", "+14:59", "+15:00", "Z")]) == (True, True, False, False)
    assert one(spark, *[url_allowed(F.lit(x), "s3.test") for x in ("https://a.s3.test/k", "http://a.s3.test/k", "https://u@a.s3.test/", "https://xs3.test/", None)]) == (True, False, False, False, False)


def test_states(spark):
    assert one(spark, *[states.can_transition(states.JOB, F.lit(a), F.lit(b)) for a, b in (("RECEIVED", "VALIDATING"), ("COMPLETED", "FAILED"), ("NO", "FAILED"))]) == (True, False, False)
    assert one(spark, *[states.terminal(states.CHUNK, F.lit(a)) for a in ("FAILED", "RUNNING", "NO")]) == (True, False, False)


def test_rules(spark):
    rows = spark.createDataFrame([("ok", "String", "1"), (".dot..", "String", "1"), ("aws. ", None, None)], "name string, kind string, value string")
    good, bad = split_valid(rows, attribute_rules())
    assert [r.name for r in good.collect()] == ["ok", ".dot.."] and bad.first().errors == ["NAME", "RESERVED", "KIND", "VALUE"]
    assert rows.select(errors(attribute_rules())).count() == 3


def test_planner_agrees_with_readers(spark):
    mb = 1024 * 1024
    rows = spark.createDataFrame([(1, 0), (2, 5 * mb - 1), (3, 5 * mb), (4, 800 * mb), (5, 10_000 * mb)], "id int, size long")
    got = {r.id: r.n for r in rows.select("id", chunk_count(F.col("size"), F.lit(50 * mb), F.lit(0)).alias("n")).collect()}
    assert got == {1: None, 2: 1, 3: 1, 4: 100, 5: 200}
    t = balanced_tiles(spark.createDataFrame([(1003, 7)], "size long, chunk_count long"))
    assert [(r.start_byte, r.end_byte) for r in t.orderBy("start_byte").collect()] == tiles(1003, 144)
    assert one(spark, *[pinned_version(F.lit(x)) for x in ("null", "", "v")]) == (None, None, "v")


def test_both_prefix_resolutions_agree(spark):
    configs = spark.createDataFrame([("b", "a/", "n1"), ("b", "a/b", "n2"), ("b", "a/b", "n0"), ("b", "", "n3")], "bucket string, prefix string, name string")
    keys = spark.createDataFrame([("b", "a/x"), ("b", "a/bc"), ("b", "z"), ("c", "a/x")], "bucket string, key string")
    for f in (config.resolve, config.resolve_small):
        assert {(r.key, r.name) for r in f(keys, configs).collect()} == {("a/x", "n1"), ("a/bc", "n0")}
        assert f(keys, configs, "left").count() == 4


def test_packing_is_the_greedy_fold(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randrange(1, 60)) for g in range(5) for i in range(rng.randrange(1, 80))]
    df = spark.createDataFrame(rows, "g int, i int, s long")
    out = packed(df, ["g"], ["i"], "s", max_items=7, max_bytes=150, empty_bytes=10, separator_bytes=1)
    got = {(r.g, r.i): r.bundle_no for r in out.collect()}
    for g in range(5):
        mine = [s for h, _, s in rows if h == g]
        assert [got[g, i] for i in range(len(mine))] == greedy(mine, 7, 150, 10, 1)


def test_ledger_folds_do_not_depend_on_order(spark):
    t0 = datetime(2024, 1, 1)
    log = [(1, k, t0 + timedelta(minutes=k), s) for k, s in enumerate(["RECEIVED", "VALIDATING", "PLANNING"])] + [(2, 9, t0, "FAILED")]
    schema = "job_id long, event_id long, at timestamp, state string"
    a = spark.createDataFrame(log, schema)
    b = spark.createDataFrame(log[::-1] + log[:1], schema).dropDuplicates(["event_id"])
    assert sorted(map(tuple, ledger.current(a).collect())) == sorted(map(tuple, ledger.current(b).collect()))
    assert ledger.history(a).where("job_id = 1").first().history == ["RECEIVED", "VALIDATING", "PLANNING"]
    now = F.lit(t0 + timedelta(minutes=10))
    assert {r.job_id: r.admission for r in ledger.admission(ledger.current(a), now).collect()} == {1: "busy", 2: "alreadyCompleted"}
    assert {r.job_id: r.admission for r in ledger.admission(ledger.current(a), now, "1 minute").collect()} == {1: "acquired", 2: "alreadyCompleted"}
    assert [r.job_id for r in ops.stuck(ledger.current(a), now, "5 minutes").collect()] == [1]


def test_quality_and_metrics(spark):
    seen = spark.createDataFrame([("j", 1), ("j", 4), ("k", 2)], "job string, n long")
    assert sorted(map(tuple, quality.gaps(seen, "job", "n", 1).collect())) == [("j", 2), ("j", 3), ("k", 1)]
    df = spark.createDataFrame([("a", float(x)) for x in range(100)], "g string, v double")
    assert metrics.percentile_by_group(df, ["g"], "v", 0.95, "p").first().p == 94.0
    empty = df.limit(0)
    assert metrics.percentile_by_group(empty, ["g"], "v", 0.95, "p").count() == 0


def test_gaps_of_large_ordinals_and_limits(spark):
    seen = spark.createDataFrame([("j", 3), ("j", 2_000_000_000), ("j", 2_000_000_002), ("k", 2), ("k", 2), ("n", None)], "job string, n long")
    got = {}
    for job, n in quality.gaps(seen, "job", "n", 1, 5).collect():
        got.setdefault(job, []).append(n)
    assert {k: sorted(v) for k, v in got.items()} == {"j": [1, 2, 4, 5, 6], "k": [1]}
    assert quality.gaps(seen.limit(0), "job", "n", 1).count() == 0


def test_percentile_of_many_values(spark):
    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v")).union(spark.range(50_000).selectExpr("7L as g", "id % 3 as v"))
    got = {r.g: r.p for r in metrics.percentile_by_group(df, ["g"], "v", 0.95, "p").collect()}
    rows = {}
    for g, v in df.collect():
        rows.setdefault(g, []).append(v)
    assert got == {g: sorted(v)[int((len(v) - 1) * 0.95)] for g, v in rows.items()}
    assert metrics.percentile_by_group(df.where("g = 7"), [], "v", 0.5, "p").first().p == 1


def test_prefixes_of_repeated_objects_after_a_shuffle(spark):
    configs = spark.createDataFrame([("b", "k1", "one"), ("b", "k", "any")], "bucket string, prefix string, name string")
    objects = spark.range(2000).select(F.lit("b").alias("bucket"), F.concat(F.lit("k"), F.col("id") % 50).alias("key"), "id").repartition(7)
    got = config.resolve(objects, configs).collect()
    assert len(got) == 2000 and all(r.name == ("one" if r.key.startswith("k1") else "any") for r in got)


def test_commands_on_chunks(spark):
    t0 = datetime(2024, 1, 1)
    kinds = [("acquire", 0), ("acquire", 0), ("complete", 2), ("fail", 1), ("start", 2), ("fail", 2), ("start", 3), ("start", 3), ("fail", 3), ("fail", 3), ("complete", 3), ("acquire", 0), ("nonsense", 0)]
    rows = [("j", "c", t0 + timedelta(minutes=i), i, k, a, 5) for i, (k, a) in enumerate(kinds)] + [("j", "d", t0, 99, "start", 1, 0), ("j", "d", t0, 100, "complete", 1, 7)]
    log = commands.chunk_log(spark.createDataFrame(rows[::-1], "job_id string, chunk_id string, at timestamp, event_id long, kind string, attempt int, records long"))
    assert [r.outcome for r in log.where("chunk_id = 'c'").orderBy("event_id").collect()] == ["applied", "busy", "conflict", "applied", "applied", "applied", "applied", "conflict", "applied", "unchanged", "conflict", "alreadyCompleted", "conflict"]
    assert {tuple(r) for r in commands.chunk_states(log).collect()} == {("j", "c", "FAILED", 6, 0, 4), ("j", "d", "COMPLETED", 2, 7, 0)}
    manifest = spark.createDataFrame([("j", 2, True), ("k", 0, True), ("l", 1, False)], "job_id string, expected_chunks long, sealed boolean")
    out = commands.reconciled(manifest, commands.chunk_states(log))
    assert {r.job_id: r.status for r in out.collect()} == {"j": "FAILED", "k": "COMPLETED", "l": None}
    assert commands.broken_counts(out).count() == 0


def test_commands_on_jobs():
    j = commands.Job()
    steps = ["plan", "validate", "validate", "schedule", "plan", "validate", "schedule", "seal", "seal", "schedule", "schedule", "reject", "other"]
    assert [commands.on_job(j, k) for k in steps] == ["conflict", "applied", "unchanged", "conflict", "applied", "unchanged", "conflict", "applied", "unchanged", "applied", "unchanged", "conflict", "conflict"]
    j = commands.Job()
    assert commands.on_job(j, "reject", "EMPTY_FILE", "no bytes") == "applied" and j.reason == "EMPTY_FILE: no bytes" and commands.on_job(j, "reject") == "unchanged"


def test_conversations_keep_every_line(spark, tmp_path):
    from recordmill.catalog.scanning import LAYOUT, conversations, frame

    rows = [(1, 0, "system", "s"), (1, 1, "user", "a\nb\r\n\rc"), (1, 2, "assistant", "d\ne\n"), (1, 3, "user", ""), (1, 4, "tool", "x\ny"), (1, 5, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    files = conversations(spark, str(tmp_path))
    assert files.first().content == "H\nSs\nUa\nUb\nU\nUc\nAd\nAe\nA\nU\nSx\nSy\nT\n"
    records = frame(files, F.col("content"), ["conv_id"], "multi-line", layout=LAYOUT).orderBy("ordinal").collect()
    assert [r.raw for r in records] == ["Ua", "Ub", "U", "Uc\x1cAd\x1cAe\x1cA", "U"]


def test_delivery_counts_sends_no_contents_through_python(spark, tmp_path):
    from recordmill.catalog.scanning import delivery_counts

    spark.createDataFrame([(1, "a\r\nb\rc\n\nd", "en", "web"), (2, None, "en", "web"), (3, "\n", "en", "web")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = delivery_counts(spark, str(tmp_path))
    # ordinals 0 and 7, 14, ... fail; those left of the first document hold 1, 2, 1 and 1 events
    assert [tuple(r) for r in out.collect()] == [(1, 0, 4, 5)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    into_python = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert into_python and not any("content" in line or "raw" in line for line in into_python)
