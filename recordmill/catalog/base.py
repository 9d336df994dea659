"""The driver's tables read as objects, files, state logs and results; and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordmill.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as objects of a bucket."""
    key = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select("doc_id", F.lit("corpus").alias("bucket"), key.alias("key"), F.lit("").alias("version_id"), F.md5(F.col("text").cast("binary")).alias("etag"), F.octet_length("text").cast("long").alias("size"), F.col("text").alias("content"))


O = "(SELECT doc_id, 'corpus' AS bucket, source || '/' || lang || '/' || doc_id || '.txt' AS key, '' AS version_id, md5(text) AS etag, CAST(strlen(text) AS BIGINT) AS size, text AS content FROM documents)"
FILE_ID = "sha256(bucket || '/' || key || '/' || version_id || '/' || etag || '/' || size)"


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with CR, LF and CRLF."""
    return objects(spark, sf_dir).withColumn("content", F.concat(F.replace(F.replace("content", F.lit(". "), F.lit(".\r\n")), F.lit(", "), F.lit(",\n\r")), F.lit("\r")))


OC = f"(SELECT doc_id, bucket, key, version_id, etag, size, replace(replace(content, '. ', '.' || chr(13) || chr(10)), ', ', ',' || chr(10) || chr(13)) || chr(13) AS content FROM {O})"
PHYSICAL = r"'[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+'"


def lines_sql(source: str) -> str:
    """doc_id, ordinal, byte_offset, raw, phys of every line."""
    return f"""(SELECT doc_id, ordinal, CAST(coalesce(sum(strlen(phys)) OVER (PARTITION BY doc_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset,
      regexp_replace(phys, '[\\r\\n]+$', '') AS raw, phys
    FROM (SELECT doc_id, unnest(ps) AS phys, CAST(generate_subscripts(ps, 1) - 1 AS BIGINT) AS ordinal FROM (SELECT doc_id, regexp_extract_all(content, {PHYSICAL}) AS ps FROM {source})))"""


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as multi-line files: a header, the lines of each turn with its mark, a trailer."""
    mark = F.when(F.col("role") == "user", "U").when(F.col("role") == "assistant", "A").otherwise("S")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(F.transform(F.split("text", "\r\n|\r|\n"), lambda x: F.concat(mark, x)), "\n").alias("line"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n")
    return turns.groupBy("conv_id").agg(F.concat(F.lit("H\n"), listed, F.lit("\nT\n")).alias("content"))


C = "(SELECT conv_id, 'H' || chr(10) || string_agg(line, chr(10) ORDER BY turn, line) || chr(10) || 'T' || chr(10) AS content FROM (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' ELSE 'S' END AS mark, mark || regexp_replace(text, '\\r\\n|\\r|\\n', chr(10) || mark, 'g') AS line FROM conversations) GROUP BY conv_id)"

STATES = {"signup": "RECEIVED", "view": "VALIDATING", "click": "PLANNING", "purchase": "COMPLETED", "error": "FAILED"}
_STATE_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATES.items())


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as state changes of jobs, with a duration."""
    state = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])[F.col("event_type")]
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), "event_id", F.col("ts").cast("timestamp").alias("at"), state.alias("state"), F.col("value").alias("ms"))


E = f"(SELECT user_id AS job_id, event_id, CAST(ts AS TIMESTAMP) AS moment, CASE event_type {_STATE_SQL} END AS state, value AS ms FROM events)"
CURRENT = f"(SELECT job_id, arg_max(state, (moment, event_id)) AS state, max(moment) AS updated_at, min(moment) AS created_at, count(*) AS revision FROM {E} GROUP BY job_id)"

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as results of chunks."""
    rows = table(spark, sf_dir, "lineitem")
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER))
    status = F.when(F.col("l_returnflag") == "A", "COMPLETED").when(F.col("l_returnflag") == "N", "RETRY_PENDING").otherwise("FAILED")
    return rows.select(F.col("l_orderkey").alias("job_id"), F.lpad(number.cast("string"), 8, "0").alias("chunk_id"), number.cast("long").alias("number"), (F.col("l_linenumber") % 3 + 1).cast("long").alias("attempt"), status.alias("status"), F.floor("l_quantity").cast("long").alias("records_read"), F.when(F.col("l_discount") >= 0.09, 1).otherwise(0).cast("long").alias("records_rejected"), (F.col("l_linenumber") * 100).cast("long").alias("start_byte"))


L = f"(SELECT l_orderkey AS job_id, lpad(CAST(n AS VARCHAR), 8, '0') AS chunk_id, n AS number, CAST(l_linenumber % 3 + 1 AS BIGINT) AS attempt, CASE l_returnflag WHEN 'A' THEN 'COMPLETED' WHEN 'N' THEN 'RETRY_PENDING' ELSE 'FAILED' END AS status, CAST(floor(l_quantity) AS BIGINT) AS records_read, CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END AS records_rejected, CAST(l_linenumber * 100 AS BIGINT) AS start_byte FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) AS n FROM lineitem))"


def large_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as objects with sizes from a few to some hundred MB."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("object_id"), F.lit("orders").alias("bucket"), F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("key"), F.floor(F.col("o_totalprice") * 1000).cast("long").alias("size"), F.col("o_orderpriority").alias("priority"))


B = "(SELECT o_orderkey AS object_id, 'orders' AS bucket, 'o/' || o_orderkey AS key, CAST(floor(o_totalprice * 1000) AS BIGINT) AS size, o_orderpriority AS priority FROM orders)"
