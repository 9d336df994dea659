"""Queries over files that tasks write from the tables: JSON arrays cut anywhere, planned padding, the
clustered ledger, localised documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.catalog.base import E, L, conversations, query, results, state_log, table
from recordmill.operators.framing import Layout
from recordmill.operators.json_split import json_records
from recordmill.operators.layout import partition_of, status_range, write_clustered
from recordmill.operators.localise import localised_documents
from recordmill.plans.padding import padded_tiles
from recordmill.sources.ranges import listed
from recordmill.sources.sinks import write_files
from recordmill.streaming.runs import folder

# ---- JSON arrays whose texts look like elements

TRICK = '\\"},{\\"id\\":7,\\"t\\":\\"[{\\\\'  # as it stands in a JSON text
PER_FILE = 40


def _json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Forty documents a file, a few of them as elements that are passed over or do not parse."""
    n = F.col("doc_id")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x00-\\x1F\\x7F]", " ")
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    body = F.concat(F.lit('{"id":'), n.cast("string"), F.lit(',"t":"'), text, F.lit(TRICK), F.lit('"}'))
    element = F.when(n % 13 == 0, F.concat(F.lit("["), body, F.lit("]"))).when(n % 17 == 0, F.concat(F.lit('{"id": tru,'), F.substring(body, 2, 2**30))).when(n % 11 == 0, F.concat(F.lit('{"key":1,'), F.substring(body, 2, 2**30))).otherwise(body)
    rows = table(spark, sf, "documents").select(F.floor(n / PER_FILE).alias("file"), "doc_id", element.alias("element"))
    listed_ = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "element"))), lambda x: x["element"]), ",\n ")
    return rows.groupBy("file").agg(F.concat(F.lit(" [\n"), listed_, F.lit("\n]\n")).alias("content"))


_TEXT = "replace(replace(regexp_replace(coalesce(text, ''), '[\\x00-\\x1F\\x7F]', ' ', 'g'), '\\', '\\\\'), '\"', '\\\"')"
_BODY = f"""'{{"id":' || doc_id || ',"t":"' || {_TEXT} || '{TRICK}' || '"}}'"""
_ELEMENTS = f"""(SELECT doc_id // {PER_FILE} AS file, doc_id, CASE WHEN doc_id % 13 = 0 THEN '[' || b || ']' WHEN doc_id % 17 = 0 THEN '{{"id": tru,' || substr(b, 2) WHEN doc_id % 11 = 0 THEN '{{"key":1,' || substr(b, 2) ELSE b END AS e,
  CASE WHEN doc_id % 13 = 0 THEN 'over' WHEN doc_id % 17 = 0 THEN 'MALFORMED_JSON' WHEN doc_id % 11 = 0 THEN 'over' END AS reason FROM (SELECT doc_id, {_BODY} AS b FROM documents))"""


@query(f"""SELECT file, byte_offset, CASE WHEN reason IS NULL THEN md5(e) END AS raw_md5, reason
  FROM (SELECT file, CAST(3 + coalesce(sum(strlen(e) + 3) OVER (PARTITION BY file ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset, e, reason FROM {_ELEMENTS}) WHERE reason IS NULL OR reason <> 'over'""")
def json_split_elements(spark: SparkSession, sf: str) -> DataFrame:
    """The arrays written as files and read in ranges of 700 bytes, most of which begin in a text."""
    out = folder(spark, "json-arrays")
    write_files(_json_arrays(spark, sf).select(F.concat(F.col("file").cast("string"), F.lit(".json")).alias("name"), "content"), out)
    rows = json_records(spark, out, first_field="id", target=700)
    return rows.select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("long").alias("file"), "byte_offset", F.md5(F.col("raw").cast("binary")).alias("raw_md5"), "reason")


# ---- padding of multi-line tiles

NOMINAL, MOST = 200, 100
_CONTENT = "(SELECT conv_id, 'H' || chr(10) || string_agg(line, chr(10) ORDER BY turn, line) || chr(10) || 'T' || chr(10) AS content FROM (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' ELSE 'S' END AS mark, mark || regexp_replace(text, '\\r\\n|\\r|\\n', chr(10) || mark, 'g') AS line FROM conversations) GROUP BY conv_id)"
_LINES = f"(SELECT conv_id, strlen(content) AS size, l, coalesce(sum(strlen(l) + 1) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM (SELECT conv_id, content, unnest(string_split(content, chr(10))) AS l, generate_subscripts(string_split(content, chr(10)), 1) AS i FROM {_CONTENT}))"


@query(f"""WITH b AS (SELECT conv_id, pos FROM {_LINES} WHERE starts_with(l, 'U')
), t AS (SELECT conv_id, strlen(content) AS size, unnest(range(0, (strlen(content) - 1) // {NOMINAL} + 1)) AS k FROM {_CONTENT}
), e AS (SELECT conv_id, size, k, least((k + 1) * {NOMINAL}, size) - 1 AS last FROM t
), p AS (SELECT e.conv_id, e.k, any_value(size) AS size, any_value(last) AS last, min(pos) AS nearest FROM e LEFT JOIN b ON e.conv_id = b.conv_id AND b.pos > e.last AND b.pos <= e.last + {MOST} GROUP BY 1, 2
), q AS (SELECT *, CASE WHEN last = size - 1 THEN 0 WHEN nearest IS NOT NULL THEN nearest - last - 1 WHEN last + {MOST} >= size - 1 THEN size - 1 - last END AS pad FROM p)
SELECT conv_id, lpad(CAST(k + 1 AS VARCHAR), 8, '0') AS chunk_id, CAST(k * {NOMINAL} AS BIGINT) AS start_byte, CAST(last + coalesce(pad, 0) AS BIGINT) AS end_byte, CAST(coalesce(pad, 0) AS BIGINT) AS trailing_padding, CASE WHEN pad IS NULL THEN 'NO_BREAK' END AS error FROM q""")
def plan_padding(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as multi-line files, planned from what lies behind each tile's end."""
    out = folder(spark, "conversations")
    write_files(conversations(spark, sf).select(F.concat(F.col("conv_id").cast("string"), F.lit(".txt")).alias("name"), "content"), out)
    files = spark.createDataFrame([(p.path, p.size, p.version) for p in listed(out)], "path string, size long, version string")
    tiles = padded_tiles(files, Layout(breaks=[(0, 1, "U")]), F.lit(NOMINAL // MOST), F.lit(MOST))
    return tiles.select(F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("long").alias("conv_id"), "chunk_id", "start_byte", "end_byte", "trailing_padding", "error")


# ---- the ledger by key prefix, status and time


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs and chunks of the orders as rows of one table."""
    rows = results(spark, sf)
    pk = F.concat(F.lit("JOB#"), F.lpad(F.col("job_id").cast("string"), 9, "0")).alias("pk")
    chunks = rows.select(pk, F.concat(F.lit("CHUNK#"), "chunk_id").alias("sk"), "status", "records_read")
    jobs = rows.groupBy("job_id").agg(F.sum("records_read").cast("long").alias("records_read")).select(pk, F.lit("JOB").alias("sk"), F.lit("RUNNING").alias("status"), "records_read")
    return chunks.unionByName(jobs)


_MID = f"(SELECT (min(job_id) + max(job_id)) // 2 AS mid FROM {L})"
_FIRST_FROM = f"(SELECT min(job_id) AS job FROM {L} WHERE job_id >= (SELECT mid FROM {_MID}))"


@query(f"SELECT 'JOB#' || lpad(CAST(job_id AS VARCHAR), 9, '0') AS pk, 'CHUNK#' || chunk_id AS sk, status, records_read FROM {L} WHERE job_id = (SELECT job FROM {_FIRST_FROM})")
def ledger_partition(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks of one job out of the whole ledger, clustered by key and read by prefix."""
    rows, out = _ledger(spark, sf), folder(spark, "ledger")
    write_clustered(rows, out, "pk", "sk")
    jobs = results(spark, sf).select("job_id")
    low, high = jobs.agg(F.min("job_id"), F.max("job_id")).first()
    job = jobs.where(F.col("job_id") >= (low + high) // 2).agg(F.min("job_id")).first()[0]
    return partition_of(spark, out, f"JOB#{job:09d}", "CHUNK#")


_DAY = "date_trunc('day', (SELECT min(moment) + (max(moment) - min(moment)) / 2 FROM {}))".format(E)


@query(f"SELECT event_id, job_id, epoch_us(moment) AS updated_us FROM {E} WHERE state = 'PLANNING' AND moment BETWEEN {_DAY} AND {_DAY} + INTERVAL 1 DAY")
def ledger_status_range(spark: SparkSession, sf: str) -> DataFrame:
    """All states as a table clustered by status and time, of which one day of one status is read."""
    rows, out = state_log(spark, sf).select("event_id", "job_id", F.col("state").alias("status"), F.col("at").alias("updated_at")), folder(spark, "ledger-status")
    write_clustered(rows, out, "status", "updated_at")
    day = rows.agg(F.date_trunc("day", F.timestamp_micros(F.floor((F.unix_micros(F.min("updated_at")) + F.unix_micros(F.max("updated_at"))) / 2).cast("long"))).alias("d")).first().d
    found = status_range(spark, out, "PLANNING", F.lit(day), F.lit(day) + F.expr("INTERVAL 1 DAY"))
    return found.select("event_id", "job_id", F.unix_micros("updated_at").alias("updated_us"))


# ---- localisation

_T = "strftime(moment{}, '%Y-%m-%dT%H:%M:%S')"
_DOC = """'{{"id":' || event_id || ', "createdAt": "' || {0} || '{1}","n":[{{"note":"\\"doneAt\\":\\"2024-01-01T00:00:00Z\\" at","x":{{"doneAt" :"' || {0} || '{1}","at":"' || {2} || 'Z"}}}},["' || {2} || 'Z"]],"timestamp":"' || {0} || '{1}","seenAt":null,"badAt":"soon"}}'"""


@query(f"SELECT event_id, {_DOC.format(_T.format(' - INTERVAL 3 HOUR'), '-03:00', _T.format(''))} AS document FROM {E}")
def localised_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested documents with times in UTC, in a zone three hours behind."""
    at = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss")
    parts = _DOC.format("%s", "Z", "%s").replace("'{", "{", 1).removesuffix("'").split("' || ")
    text = [F.lit(parts[0].removesuffix("'"))]
    for p in parts[1:]:
        column, _, rest = p.partition(" || '")
        text += [F.col("event_id").cast("string") if column == "event_id" else at, F.lit(rest)]
    return localised_documents(state_log(spark, sf).select("event_id", F.concat(*text).alias("document")), "document", "-03:00")
