"""Planning, configuration and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.catalog.base import B, O, large_objects, objects, query, table
from recordmill.functions.validate import Limits, chunk_rules, errors, global_limit_rules, prefix_config_rules
from recordmill.operators.config import resolve_small
from recordmill.plans.planner import balanced_tiles, chunk_count, effective, nominal_tiles, plan_summary
from recordmill.plans.requests import checked, manifest, planned, with_controls

MAX_CHUNK, TARGET = 64 * 1024 * 1024, 16 * 1024 * 1024
_COUNT = f"CASE WHEN size < 5242880 THEN 1 ELSE least(greatest((size + {TARGET} - 1) // {TARGET}, (size + {MAX_CHUNK} - 1) // {MAX_CHUNK}), size // 5242880) END"
_PLANNED = f"(SELECT *, CAST({_COUNT} AS BIGINT) AS chunk_count FROM {B} WHERE size > 0)"
_TILED = f"(SELECT object_id, bucket, key, size, k, size * k // chunk_count AS start_byte, size * (k + 1) // chunk_count - 1 AS end_byte FROM (SELECT *, unnest(range(0, chunk_count)) AS k FROM {_PLANNED}))"


def _planned(spark: SparkSession, sf: str) -> DataFrame:
    return large_objects(spark, sf).withColumn("chunk_count", chunk_count(F.col("size"), F.lit(MAX_CHUNK), F.lit(TARGET)))


@query(f"SELECT object_id, chunk_count, CAST(CASE WHEN size < 5242880 THEN 1 ELSE least(greatest(100, (size + {MAX_CHUNK} - 1) // {MAX_CHUNK}), size // 5242880) END AS BIGINT) AS default_count FROM {_PLANNED}")
def chunk_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _planned(spark, sf).where("chunk_count is not null").select("object_id", "chunk_count", chunk_count(F.col("size"), F.lit(MAX_CHUNK), F.lit(0)).alias("default_count"))


#: Largest chunks and targets on both sides of 5 MiB; zero is none given.
_MAXIMA = [(4 * 1024**2, 0), (5242880, 0), (5242880, 6 * 1024**2), (7 * 1024**2, 0), (7 * 1024**2, 1), (MAX_CHUNK, TARGET), (0, 0), (0, 300 * 1024**2)]
_MAXIMA_SQL = "(SELECT mx, tg, CASE WHEN mx > 0 THEN mx ELSE 67108864 END AS lim FROM (VALUES " + ", ".join(f"({m}, {t})" for m, t in _MAXIMA) + ") AS v(mx, tg))"


@query(f"""SELECT object_id, CAST(mx AS BIGINT) AS max_chunk, CAST(tg AS BIGINT) AS target, CASE WHEN size = 0 THEN 'EMPTY' WHEN size >= 5242880 AND lim < 5242880 THEN 'CHUNK_MINIMUM' END AS error,
  CAST(CASE WHEN size = 0 THEN 0 WHEN size < 5242880 THEN 1 WHEN lim < 5242880 THEN 0 ELSE least(greatest(CASE WHEN tg > 0 THEN (size + tg - 1) // tg ELSE 100 END, (size + lim - 1) // lim), size // 5242880) END AS BIGINT) AS chunk_count FROM {B}, {_MAXIMA_SQL}""")
def chunk_count_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Every object under several largest chunks and targets, and why it has no count."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("max_chunk"), F.lit(t).cast("long").alias("target")) for m, t in _MAXIMA])).alias("m")
    rows = large_objects(spark, sf).select("object_id", "size", pairs).select("object_id", "size", "m.*")
    count = chunk_count(F.col("size"), F.col("max_chunk"), F.col("target"))
    error = F.when(F.col("size") == 0, "EMPTY").when(count.isNull(), "CHUNK_MINIMUM")
    return rows.select("object_id", "max_chunk", "target", error.alias("error"), F.coalesce(count, F.lit(0)).alias("chunk_count"))


@query(f"SELECT object_id, lpad(CAST(k + 1 AS VARCHAR), 8, '0') AS chunk_id, CAST(start_byte AS BIGINT) AS start_byte, CAST(end_byte AS BIGINT) AS end_byte FROM {_TILED}")
def tile_text(spark: SparkSession, sf: str) -> DataFrame:
    return balanced_tiles(_planned(spark, sf)).select("object_id", "chunk_id", "start_byte", "end_byte")


@query(f"SELECT object_id, lpad(CAST(k + 1 AS VARCHAR), 8, '0') AS chunk_id, CAST(k * 50000000 AS BIGINT) AS start_byte, CAST(least((k + 1) * 50000000, size) - 1 AS BIGINT) AS end_byte FROM (SELECT *, unnest(range(0, (size - 1) // 50000000 + 1)) AS k FROM {B} WHERE size > 0)")
def tile_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return nominal_tiles(large_objects(spark, sf), F.lit(50_000), F.lit(1000)).select("object_id", "chunk_id", "start_byte", "end_byte")


@query(f"SELECT object_id, CAST(size AS BIGINT) AS covered, true AS whole, true AS disjoint FROM {_PLANNED}")
def tile_coverage(spark: SparkSession, sf: str) -> DataFrame:
    tiles = balanced_tiles(_planned(spark, sf))
    ends = F.array_sort(F.collect_list(F.struct("start_byte", "end_byte")))
    rows = tiles.groupBy("object_id").agg(F.sum(F.col("end_byte") - F.col("start_byte") + 1).alias("covered"), F.first("size").alias("size"), ends.alias("t"))
    return rows.select("object_id", "covered", (F.col("covered") == F.col("size")).alias("whole"), F.forall(F.transform("t", lambda x, i: (i == 0) | (F.get("t", i - 1)["end_byte"] + 1 == x["start_byte"])), lambda x: x).alias("disjoint"))


@query(f"SELECT bucket, key, CAST(chunk_count AS BIGINT) AS chunks, size FROM {_PLANNED}")
def plan_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return plan_summary(balanced_tiles(_planned(spark, sf)), ["bucket", "key"])


@query(f"SELECT object_id, CASE priority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 10 ELSE 50 END AS batch_size FROM {B}")
def effective_config(spark: SparkSession, sf: str) -> DataFrame:
    own = F.when(F.col("priority") == "1-URGENT", 5).when(F.col("priority") == "2-HIGH", 10).when(F.col("priority") == "5-LOW", 0).cast("long")
    return large_objects(spark, sf).select("object_id", effective(own, F.lit(50)).cast("int").alias("batch_size"))


_CONFIGS = [("corpus", "src1", "wide", 100), ("corpus", "src1/en", "english", 50), ("corpus", "src1/e", "short", 70), ("corpus", "src2/", "two-b", 20), ("corpus", "src2/", "two-a", 30), ("corpus", "", "never", 1), ("other", "src3", "elsewhere", 9)]
_CONFIG_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"('{b}', '{p}', '{n}', {r})" for b, p, n, r in _CONFIGS) + ") AS v(config_bucket, config_prefix, name, records))"


def _configs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_CONFIGS, "bucket string, prefix string, name string, records int")


@query(f"SELECT doc_id, config_prefix, name, records FROM (SELECT doc_id, config_prefix, name, records, row_number() OVER (PARTITION BY doc_id ORDER BY length(config_prefix) DESC, name) AS r FROM {O} JOIN {_CONFIG_SQL} ON bucket = config_bucket AND config_prefix <> '' AND starts_with(key, config_prefix)) WHERE r = 1")
def longest_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_small(objects(spark, sf).select("doc_id", "bucket", "key"), _configs(spark)).select("doc_id", "config_prefix", "name", "records")


@query(f"SELECT doc_id, key FROM {O} WHERE NOT EXISTS (SELECT 1 FROM {_CONFIG_SQL} WHERE bucket = config_bucket AND config_prefix <> '' AND starts_with(key, config_prefix))")
def unmatched_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_small(objects(spark, sf).select("doc_id", "bucket", "key"), _configs(spark), "left").where("name is null").select("doc_id", "key")


LIMITS = Limits(10**9, 10**8, 500_000, 8, {"text": (10**9, 100_000), "json": (5 * 10**8, 50_000), "multi-line": (10**8, 20_000)})


def prefix_configs(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as configurations, of which each field goes wrong at its own pace."""
    k = F.col("p_partkey")
    pick = lambda m, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % m + 1).cast("int"))
    field = lambda n: F.struct(F.when(k % 37 == 0, -1).otherwise(0).alias("start"), F.lit(1).alias("length"), F.lit(n).alias("value"))
    return table(spark, sf, "part").select(
        k.alias("id"), pick(4, "text", "json", "multi-line", "csv").alias("data_type"), (k % 11).cast("int").alias("records_per_chunk"), (k % 12).cast("int").alias("batch_size"),
        ((k % 9) * 100_000).cast("int").alias("max_event_bytes"), pick(5, 10**9, 10**8, 2 * 10**9, 3 * 10**8, 500).alias("max_file_bytes"), pick(6, 10**7, 10**8, 1000, 10**6, 6 * 10**7, 2 * 10**8).alias("max_chunk_bytes"),
        pick(7, 0, 1, 6 * 10**6, 2 * 10**8, 0, 10**8, 0).alias("target_chunk_bytes"), pick(3, 0, 30_000, 60_000).alias("max_record_bytes"),
        pick(13, "r", "r", "", "r", "r", "r", "r", "r", "r", "r", "r", "r", "r").alias("event_schema_id"), F.lit("1").alias("event_schema_version"), pick(8, "raw", "raw", "raw", "raw", "raw", "", "raw", "raw").alias("event_format"),
        pick(5, "id", "", "id", "id", "id").alias("json_first_field"), pick(7, 1000, 0, 40_000, 60_000, 10, 10, 10).alias("json_max_element_bytes"), pick(6, 100, 0, 10_000, 30_000, 1, 1).alias("lines_max_record_bytes"),
        F.when(k % 10 == 0, F.array().cast("array<struct<start:int,length:int,value:string>>")).when(k % 29 == 0, F.array_repeat(field("U"), 100)).otherwise(F.array(field("U"))).alias("break_fields"), F.array(field("A")).alias("include_fields"),
        F.when(k % 17 == 0, F.array(field("SS"))).otherwise(F.array(field("S"))).alias("ignore_fields"), pick(4, "", "bundle", "single", "pile").alias("output_mode"), (k % 5 - 1).cast("int").alias("max_envelopes"), pick(3, 0, 500, 200_000).alias("max_message_bytes"),
        pick(7, "", "p-1", "a b", "A_9", "", "x" * 80, "é").alias("prefix_id"), pick(4, "", "https://sqs.a/q", "http://local", "https://q.a").alias("output_queue_url"), pick(5, "", "https://sqs.a/c", "ftp://x", "http://c", "").alias("chunk_queue_url"),
    )


def _pick(m: int, *xs) -> str:
    return "CASE k % " + f"{m} " + " ".join(f"WHEN {i} THEN {x!r}" for i, x in enumerate(xs)) + " END"


_G = f"""(SELECT k, {_pick(4, 'text', 'json', 'multi-line', 'csv')} AS dt, k % 11 AS rpc, k % 12 AS bs, (k % 9) * 100000 AS ev, {_pick(5, 10**9, 10**8, 2 * 10**9, 3 * 10**8, 500)} AS fb, {_pick(6, 10**7, 10**8, 1000, 10**6, 6 * 10**7, 2 * 10**8)} AS cb,
  {_pick(7, 0, 1, 6 * 10**6, 2 * 10**8, 0, 10**8, 0)} AS tb, {_pick(3, 0, 30000, 60000)} AS rb, k % 13 = 2 OR k % 8 = 5 AS noschema, k % 5 = 1 AS nofirst, {_pick(7, 1000, 0, 40000, 60000, 10, 10, 10)} AS jb, {_pick(6, 100, 0, 10000, 30000, 1, 1)} AS lb,
  k % 10 = 0 AS nobreak, k % 37 = 0 OR k % 29 = 0 AND k % 10 <> 0 OR k % 17 = 0 AS badfields, {_pick(4, '', 'bundle', 'single', 'pile')} AS om, k % 5 - 1 AS env, {_pick(3, 0, 500, 200000)} AS mb,
  k % 7 AS pid, {_pick(4, '', 'https://sqs.a/q', 'http://local', 'https://q.a')} AS oq, {_pick(5, '', 'https://sqs.a/c', 'ftp://x', 'http://c', '')} AS cq FROM (SELECT p_partkey AS k FROM part))"""
_URL_OK = "({0} = '' OR starts_with({0}, 'https://sqs.') OR starts_with({0}, 'http://'))"


@query(f"""SELECT CAST(k AS BIGINT) AS id, concat_ws(',', CASE WHEN dt = 'csv' THEN 'TYPE' END, CASE WHEN rpc = 0 THEN 'RECORDS_PER_CHUNK' END, CASE WHEN bs NOT BETWEEN 1 AND 8 THEN 'BATCH_SIZE' END, CASE WHEN ev NOT BETWEEN 1024 AND 500000 THEN 'EVENT_BYTES' END,
  CASE WHEN cb NOT BETWEEN 1024 AND 100000000 THEN 'CHUNK_BYTES' END, CASE WHEN fb < cb OR fb > 1000000000 OR fb > CASE dt WHEN 'json' THEN 500000000 WHEN 'multi-line' THEN 100000000 END THEN 'FILE_BYTES' END,
  CASE WHEN greatest(rb, jb, lb) > CASE dt WHEN 'text' THEN 100000 WHEN 'json' THEN 50000 WHEN 'multi-line' THEN 20000 END THEN 'RECORD_BYTES' END, CASE WHEN noschema THEN 'SCHEMA' END,
  CASE WHEN dt = 'json' AND (nofirst OR jb < 1) THEN 'JSON_LAYOUT' END, CASE WHEN dt = 'multi-line' AND (nobreak OR lb < 1 OR badfields) THEN 'LINES_LAYOUT' END, CASE WHEN om = 'pile' THEN 'OUTPUT_MODE' END,
  CASE WHEN om = 'bundle' AND (env < 0 OR (mb <> 0 AND mb NOT BETWEEN 1024 AND ev)) THEN 'BUNDLE' END, CASE WHEN pid IN (2, 6) THEN 'PREFIX_ID' END, CASE WHEN NOT {_URL_OK.format('oq')} THEN 'QUEUE_URL' END,
  CASE WHEN NOT {_URL_OK.format('cq')} OR (pid NOT IN (0, 4) AND cq = '') THEN 'CHUNK_QUEUE_URL' END, CASE WHEN tb <> 0 AND (tb < 5242880 OR tb > 104857600 OR tb > cb) THEN 'TARGET_BYTES' END) AS codes FROM {_G}""")
def validate_prefix_config(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_configs(spark, sf).select("id", F.array_join(errors(prefix_config_rules(LIMITS)), ",").alias("codes"))


@query("""SELECT CAST(s AS BIGINT) AS id, concat_ws(',', CASE WHEN f < 1024 THEN 'FILE_BYTES' END, CASE WHEN c < 1024 OR c > f THEN 'CHUNK_BYTES' END, CASE WHEN e < 1024 OR e > 1048576 THEN 'EVENT_BYTES' END, CASE WHEN b < 1 OR b > 10 THEN 'BATCH_SIZE' END,
  CASE WHEN s % 9 = 0 OR tf < 1 OR tf > f OR tr < 1 OR tr > e THEN 'TYPES' END) AS codes
  FROM (SELECT s_suppkey AS s, CASE s_suppkey % 3 WHEN 0 THEN 1000 WHEN 1 THEN 100000 ELSE 5000000 END AS f, CASE s_suppkey % 4 WHEN 0 THEN 500 WHEN 1 THEN 2000 WHEN 2 THEN 100000 ELSE 200000 END AS c, (s_suppkey % 7) * 200000 AS e, s_suppkey % 12 AS b, CASE s_suppkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1000000 ELSE 900 END AS tf, CASE s_suppkey % 6 WHEN 0 THEN 0 ELSE (s_suppkey % 6) * 100000 END AS tr FROM supplier)""")
def validate_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as limits."""
    s = F.col("s_suppkey")
    pick = lambda m, *xs: F.element_at(F.array(*[F.lit(x).cast("long") for x in xs]), (s % m + 1).cast("int"))
    of = F.struct(pick(5, 0, 10**6, 900, 900, 900).alias("max_file_bytes"), ((s % 6) * 100_000).cast("long").alias("max_record_bytes"))
    types = F.when(s % 9 == 0, F.create_map(F.lit("text"), of, F.lit("json"), of)).otherwise(F.create_map(F.lit("text"), of, F.lit("json"), of, F.lit("multi-line"), of))
    rows = table(spark, sf, "supplier").select(s.cast("long").alias("id"), pick(3, 1000, 100_000, 5_000_000).alias("max_file_bytes"), pick(4, 500, 2000, 100_000, 200_000).alias("max_chunk_bytes"), ((s % 7) * 200_000).cast("int").alias("max_event_bytes"), (s % 12).cast("int").alias("max_batch_size"), types.alias("input_types"))
    return rows.select("id", F.array_join(errors(global_limit_rules()), ",").alias("codes"))


@query(f"""SELECT object_id, lpad(CAST(k + 1 AS VARCHAR), 8, '0') AS chunk_id, concat_ws(',', CASE WHEN object_id % 11 = 3 THEN 'VERSION' END, CASE WHEN object_id % 4 = 1 THEN 'RANGE' END,
  CASE WHEN end_byte - (CASE WHEN object_id % 4 = 1 THEN -1 ELSE start_byte END) + 1 > 16000000 THEN 'CHUNK_BYTES' END, CASE WHEN object_id % 4 = 2 THEN 'SIZE' END, CASE WHEN object_id % 7 = 3 THEN 'TYPE' END,
  CASE WHEN object_id % 5 > 0 AND (object_id % 3 = 0 OR object_id % 13 > object_id % 5) THEN 'PADDING' END, CASE WHEN object_id % 7 = 1 AND object_id % 2 = 0 THEN 'JSON_LAYOUT' END, CASE WHEN object_id % 7 = 2 AND object_id % 2 = 0 THEN 'LINES_LAYOUT' END) AS codes FROM {_TILED}""")
def validate_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles that are spoilt in several ways at once."""
    n = F.col("object_id")
    kind = n % 4
    rows = balanced_tiles(_planned(spark, sf)).withColumn("schema_version", F.when(n % 11 == 3, "").otherwise("1")).withColumn("file_size", F.when(kind == 2, F.lit(1)).when(kind == 1, F.lit(0)).otherwise(F.col("size")))
    rows = rows.withColumn("start_byte", F.when(kind == 1, -1).otherwise(F.col("start_byte"))).withColumn("data_type", F.when(n % 7 == 3, "csv").when(n % 7 == 1, "json").when(n % 7 == 2, "multi-line").otherwise("text"))
    rows = rows.withColumn("max_record_bytes", n % 5).withColumn("trailing_padding", F.when(n % 3 == 0, -1).otherwise(n % 13))
    rows = rows.withColumn("json_first_field", F.when(n % 2 == 0, "").otherwise("id")).withColumn("json_max_element_bytes", F.lit(10)).withColumn("break_fields", F.when(n % 2 == 1, F.array(F.lit("U"))))
    return rows.select("object_id", "chunk_id", F.array_join(errors(chunk_rules(16_000_000)), ",").alias("codes"))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as requests for their objects, of which some ask for what is not there or not allowed."""
    n = F.col("object_id")
    field = lambda start: F.array(F.struct(F.lit(start).alias("start"), F.lit(1).alias("length"), F.lit("U").alias("value")))
    none = F.array().cast("array<struct<start:int,length:int,value:string>>")
    largest = lambda wide, usual: F.when(n % 13 == 0, 0).when(n % 11 == 0, 900_000_000_000_000).when(n % 7 == 0, wide).otherwise(usual).cast("long")
    return large_objects(spark, sf).select(
        F.concat(F.lit("x"), F.floor(n / 2).cast("string")).alias("execution_id"), F.when(n % 31 == 0, "0").otherwise("1").alias("schema_version"), F.when(n % 29 == 0, "").otherwise(F.col("bucket")).alias("bucket"), F.when(n % 23 == 0, F.concat("key", F.lit("?"))).otherwise(F.col("key")).alias("key"),
        F.when(n % 3 == 0, "v1").when(n % 3 == 1, "null").otherwise("").alias("version_id"), F.when(n % 5 == 0, F.concat(F.lit("e"), n.cast("string"))).when(n % 17 == 0, "old").otherwise("").alias("etag"),
        F.when(n % 19 == 0, "csv").when(n % 4 == 1, "json").when(n % 4 == 3, "multi-line").otherwise("text").alias("data_type"), (n % 4 * 1000).cast("long").alias("max_record_bytes"),
        F.when(n % 43 == 0, "").otherwise("id").alias("json_first_field"), largest(10_000, 1000).alias("json_max_element_bytes"), largest(2000, 500).alias("lines_max_record_bytes"),
        F.when(n % 41 == 0, none).otherwise(field(0)).alias("break_fields"), F.when(n % 37 == 1, field(-1)).otherwise(none).alias("include_fields"), none.alias("ignore_fields"), "object_id",
    )


def _heads(spark: SparkSession, sf: str) -> DataFrame:
    """The objects' only versions; every 37th is empty."""
    n = F.col("object_id")
    return large_objects(spark, sf).select("bucket", "key", F.lit("v1").alias("version_id"), F.concat(F.lit("e"), n.cast("string")).alias("etag"), F.when(n % 37 == 0, 0).otherwise(F.col("size")).alias("size"), F.lit(True).alias("current"))


PLAN = {"max_chunk_bytes": MAX_CHUNK, "records_per_chunk": 50_000}
#: The checks of a type follow those of every object: its layout, then its bytes, then its tiles.
_REQUEST = f"""(SELECT object_id, 'x' || (object_id // 2) AS execution_id, dt AS data_type, size, mrb, big, CASE WHEN object_id % 31 = 0 THEN 'REQUEST' WHEN object_id % 29 = 0 THEN 'FILE' WHEN dt = 'csv' THEN 'TYPE' WHEN object_id % 23 = 0 THEN 'NOT_FOUND' WHEN object_id % 5 <> 0 AND object_id % 17 = 0 THEN 'CHANGED'
  WHEN size > 400000000 THEN 'FILE_BYTES'
  WHEN dt = 'json' THEN CASE WHEN big < 1 OR object_id % 43 = 0 THEN 'LAYOUT' WHEN size = 0 THEN 'EMPTY' WHEN tile > 9223372036854775807 THEN 'OVERFLOW' WHEN tile > {MAX_CHUNK} THEN 'CHUNK_BYTES' END
  WHEN dt = 'multi-line' THEN CASE WHEN big < 1 OR object_id % 41 = 0 OR object_id % 37 = 1 THEN 'LAYOUT' WHEN size = 0 THEN 'EMPTY' WHEN tile > 9223372036854775807 THEN 'OVERFLOW' WHEN tile > {MAX_CHUNK} THEN 'CHUNK_BYTES' END
  WHEN size = 0 THEN 'EMPTY' WHEN mrb = 0 AND size > {MAX_CHUNK} THEN 'NOT_SPLITTABLE' END AS error
  FROM (SELECT *, CAST(big AS HUGEINT) * 50000 AS tile FROM (SELECT object_id, size, dt, object_id % 4 * 1000 AS mrb, CASE WHEN object_id % 13 = 0 THEN 0 WHEN object_id % 11 = 0 THEN 900000000000000 WHEN object_id % 7 = 0 THEN CASE dt WHEN 'json' THEN 10000 ELSE 2000 END ELSE CASE dt WHEN 'json' THEN 1000 ELSE 500 END END AS big
  FROM (SELECT object_id, CASE WHEN object_id % 19 = 0 THEN 'csv' WHEN object_id % 4 = 1 THEN 'json' WHEN object_id % 4 = 3 THEN 'multi-line' ELSE 'text' END AS dt, CASE WHEN object_id % 37 = 0 THEN 0 ELSE size END AS size FROM {B}))))"""
_CHUNKS = f"""(SELECT execution_id, object_id, size, unnest(range(0, n)) AS k, n, dt, tile FROM (SELECT *, data_type AS dt, CAST(big AS HUGEINT) * 50000 AS tile, CAST(CASE WHEN data_type <> 'text' THEN (size - 1) // (CAST(big AS HUGEINT) * 50000) + 1 WHEN mrb = 0 THEN 1 ELSE {_COUNT} END AS BIGINT) AS n FROM {_REQUEST} WHERE error IS NULL))"""


def _plan(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = checked(_requests(spark, sf), _heads(spark, sf), max_file_bytes=400_000_000, **PLAN)
    return rows, planned(rows.where("error is null"), target_chunk_bytes=TARGET, **PLAN)


@query(f"SELECT object_id, error FROM {_REQUEST}")
def plan_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf)[0].select("object_id", "error")


@query(f"SELECT object_id, lpad(CAST(k + 1 AS VARCHAR), 8, '0') AS chunk_id, CAST(CASE WHEN dt <> 'text' THEN k * tile ELSE size * k // n END AS BIGINT) AS start_byte, CAST(CASE WHEN dt <> 'text' THEN least((k + 1) * tile, size) ELSE size * (k + 1) // n END - 1 AS BIGINT) AS end_byte FROM {_CHUNKS}")
def plan_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf)[1].select("object_id", "chunk_id", "start_byte", "end_byte")


_GOOD = f"(SELECT execution_id FROM {_REQUEST} GROUP BY execution_id HAVING count(error) = 0)"


def _asked(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """With one execution that asks for nothing."""
    return rows.select("execution_id", "key", "error").union(spark.createDataFrame([("none", None, None)], "execution_id string, key string, error string"))


@query(f"SELECT g.execution_id, CAST(count(c.k) AS BIGINT) AS expected_chunks, count(c.k) = 0 AS complete_only FROM {_GOOD} g LEFT JOIN {_CHUNKS} c ON g.execution_id = c.execution_id GROUP BY 1 UNION ALL SELECT 'none', CAST(0 AS BIGINT), true")
def plan_manifests(spark: SparkSession, sf: str) -> DataFrame:
    rows, chunks = _plan(spark, sf)
    return manifest(_asked(spark, rows), chunks).select("execution_id", "expected_chunks", "complete_only")


@query(f"SELECT execution_id, lpad(CAST(k + 1 AS VARCHAR), 8, '0') AS chunk_id, CAST(NULL AS VARCHAR) AS control FROM {_CHUNKS} WHERE execution_id IN (SELECT * FROM {_GOOD}) UNION ALL SELECT 'none', NULL, 'COMPLETE'")
def plan_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows, chunks = _plan(spark, sf)
    sealed = manifest(_asked(spark, rows), chunks)
    return with_controls(chunks.join(sealed.select("execution_id"), "execution_id", "left_semi").select("execution_id", "chunk_id"), sealed)
