"""Scans, identities, framing and envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordmill.catalog.base import C, FILE_ID, O, OC, E, conversations, lines_sql, mixed, objects, query, state_log, table
from recordmill.functions import identity, sizes
from recordmill.functions.validate import PERMANENT_ERRORS, attribute_rules, errors, message_rules, send_error_class, type_supported
from recordmill.operators.bundles import bodies, bundle_stats, bundled, by_count, fits, packed
from recordmill.operators.envelope import envelopes, split_by_size
from recordmill.operators.framing import Layout, frame, frame_lines, match_at, owned
from recordmill.operators.ledger import confirmed, deliveries
from recordmill.operators.quality import expanded, reasons
from recordmill.plans.planner import balanced_tiles
from recordmill.sources.notifications import notifications, requests

ROW = ["doc_id", "bucket", "key", "version_id", "etag", "size"]
LAYOUT = Layout(breaks=[(0, 1, "U")], includes=[(0, 1, "A")], ignores=[(0, 1, "S")])


@query(f"SELECT key, size, etag FROM {O}")
def scan_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return objects(spark, sf).select("key", "size", "etag")


@query("SELECT doc_id, 'corpus' AS bucket, source || '/a b/' || doc_id || '.txt' AS key, CAST(NULL AS VARCHAR) AS version_id FROM documents WHERE doc_id % 5 <> 0")
def notification_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Builds a notification for each document, a fifth of them of another kind, and parses it."""
    docs = objects(spark, sf)
    name = F.when(F.col("doc_id") % 5 == 0, "ObjectRemoved:Delete").otherwise("ObjectCreated:Put")
    key = F.concat(F.element_at(F.split("key", "/"), 1), F.lit("/a+b/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    body = F.to_json(F.struct(F.array(F.struct(name.alias("eventName"), F.struct(F.struct(F.lit("corpus").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3"))).alias("Records")))
    return notifications(docs.select("doc_id", body.alias("body")), "body", ["doc_id"])


@query(f"SELECT 'r' || doc_id AS execution_id, bucket, unnest([key, key || '.bak']) AS key, 'text' AS data_type FROM {O}")
def request_explode(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda suffix: F.struct("bucket", F.concat("key", F.lit(suffix)).alias("key"), F.lit("text").alias("dataType"))
    body = F.to_json(F.struct(F.lit("1").alias("schemaVersion"), F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("executionId"), F.array(one(""), one(".bak")).alias("files")))
    return requests(objects(spark, sf).select(body.alias("body")), "body").select("execution_id", "bucket", "key", "data_type")


@query(f"SELECT doc_id, {FILE_ID} AS file_id FROM {O}")
def file_identity(spark: SparkSession, sf: str) -> DataFrame:
    return objects(spark, sf).select("doc_id", identity.file_id("bucket", "key", "version_id", "etag", "size").alias("file_id"))


@query(f"SELECT doc_id, sha256(f || '/0') AS v2, sha256(f || '/00000001/1/record/1') AS v1 FROM (SELECT doc_id, {FILE_ID} AS f FROM {O})")
def record_identity_v1_v2(spark: SparkSession, sf: str) -> DataFrame:
    rows = objects(spark, sf).withColumn("f", identity.file_id("bucket", "key", "version_id", "etag", "size"))
    return rows.select("doc_id", identity.source_record_id("f", F.lit(0)).alias("v2"), identity.source_record_id_v1("f", F.lit("00000001"), F.lit(1), F.lit("record"), F.lit("1")).alias("v1"))


@query(f"SELECT doc_id, sha256('job-a/' || r) AS first_event, sha256('job-b/' || r) AS replay_event, sha256('job-a/' || r) = sha256('job-b/' || r) AS same FROM (SELECT doc_id, sha256({FILE_ID} || '/0') AS r FROM {O})")
def event_identity_replay(spark: SparkSession, sf: str) -> DataFrame:
    rows = objects(spark, sf).withColumn("r", identity.source_record_id(identity.file_id("bucket", "key", "version_id", "etag", "size"), F.lit(0)))
    a, b = identity.event_id(F.lit("job-a"), "r"), identity.event_id(F.lit("job-b"), "r")
    return rows.select("doc_id", a.alias("first_event"), b.alias("replay_event"), (a == b).alias("same"))


@query(f"SELECT doc_id, ordinal, raw FROM {lines_sql(O)}")
def frame_text(spark: SparkSession, sf: str) -> DataFrame:
    return frame_lines(objects(spark, sf), F.col("content"), ["doc_id"])


@query(f"SELECT doc_id, ordinal, byte_offset, raw FROM {lines_sql(OC)}")
def frame_text_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return frame(mixed(spark, sf), F.col("content"), ["doc_id"]).select("doc_id", "ordinal", "byte_offset", "raw")


@query(f"SELECT doc_id, count(*) AS empty_records FROM {lines_sql(OC)} WHERE raw = '' GROUP BY doc_id")
def frame_text_empty_lines(spark: SparkSession, sf: str) -> DataFrame:
    return frame(mixed(spark, sf), F.col("content"), ["doc_id"]).where("raw = ''").groupBy("doc_id").agg(F.count("*").alias("empty_records"))


@query(f"SELECT doc_id, ordinal, byte_offset, 'OVERSIZED_RECORD' AS reason FROM {lines_sql(O)} WHERE strlen(raw) > 600")
def frame_text_oversized(spark: SparkSession, sf: str) -> DataFrame:
    return frame(objects(spark, sf), F.col("content"), ["doc_id"], max_bytes=600).where("reason is not null").select("doc_id", "ordinal", "byte_offset", "reason")


@query(f"SELECT doc_id, ordinal, regexp_matches(phys, '[\\r\\n]$') AS terminated, CASE WHEN NOT regexp_matches(phys, '[\\r\\n]$') THEN 'UNTERMINATED_RECORD' END AS reason FROM {lines_sql(O)}")
def frame_unterminated(spark: SparkSession, sf: str) -> DataFrame:
    return frame(objects(spark, sf), F.col("content"), ["doc_id"], strict_end=True).select("doc_id", "ordinal", "terminated", "reason")


def damaged(files: DataFrame) -> DataFrame:
    """Whole contents as bytes: of every four lines the first stays, the others get the first two of
    a character's three bytes, in front of the line, after half of its characters, and at its end."""
    physical = F.filter(F.regexp_extract_all("content", F.lit("[^\\r\\n]*(?:\\r\\n|\\r|\\n)|[^\\r\\n]+"), F.lit(0)), lambda x: x != "")

    def line(x: Column, i: Column) -> Column:
        raw = F.regexp_replace(x, "[\\r\\n]+$", "")
        n = F.length(raw)
        at = F.when(i % 4 == 1, F.lit(0)).when(i % 4 == 2, F.floor(n / 2).cast("int")).otherwise(n)
        return F.concat(F.hex(F.encode(F.substring(x, F.lit(1), at), "UTF-8")), F.when(i % 4 > 0, "E697").otherwise(""), F.hex(F.encode(F.substring(x, at + 1, F.length(x)), "UTF-8")))

    return files.withColumn("content", F.unhex(F.array_join(F.transform(physical, line), "")))


@query(f"SELECT doc_id, ordinal, CASE WHEN ordinal % 4 > 0 THEN 'INVALID_UTF8' END AS reason FROM {lines_sql(OC)}")
def utf8_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every text; those with part of a character somewhere are not valid."""
    return frame(damaged(mixed(spark, sf)), F.col("content"), ["doc_id"]).select("doc_id", "ordinal", "reason")


@query(f"SELECT l.doc_id, lpad(CAST(k + 1 AS VARCHAR), 8, '0') AS chunk_id, count(*) AS records FROM {lines_sql(OC)} l JOIN (SELECT doc_id, k, strlen(content) * k // 3 AS a, strlen(content) * (k + 1) // 3 - 1 AS b FROM {OC}, (VALUES (0), (1), (2)) AS v(k)) t ON l.doc_id = t.doc_id AND byte_offset BETWEEN a AND b GROUP BY l.doc_id, k")
def ownership_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Records by the one of three tiles that holds their first byte."""
    files = mixed(spark, sf).withColumn("size", F.octet_length("content").cast("long")).withColumn("n", F.lit(3).cast("long"))
    tiles = balanced_tiles(files.select("doc_id", "size", "n"), "size", "n")
    records = frame(files, F.col("content"), ["doc_id"]).select("doc_id", "byte_offset").join(tiles, "doc_id")
    return owned(records, F.col("start_byte"), F.col("end_byte")).groupBy("doc_id", "chunk_id").agg(F.count("*").alias("records"))


_CL = lines_sql(C.replace("SELECT conv_id,", "SELECT conv_id AS doc_id,", 1))


@query(f"SELECT doc_id AS conv_id, ordinal, raw[1] = 'U' AS is_break, raw[1] = 'A' AS is_include, raw[1] = 'S' AS is_ignore FROM {_CL}")
def match_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = frame_lines(conversations(spark, sf), F.col("content"), ["conv_id"])
    return rows.select("conv_id", "ordinal", *[match_at(F.col("raw"), f).alias(n) for n, f in (("is_break", LAYOUT.breaks), ("is_include", LAYOUT.includes), ("is_ignore", LAYOUT.ignores))])


_GROUPED = f"(SELECT doc_id AS conv_id, ordinal, byte_offset, raw, raw[1] AS mark, sum(CASE WHEN raw[1] = 'U' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ordinal) AS g FROM {_CL})"


@query(f"SELECT conv_id, min(byte_offset) AS byte_offset, string_agg(raw, chr(28) ORDER BY ordinal) AS raw FROM {_GROUPED} WHERE g > 0 AND mark IN ('U', 'A') GROUP BY conv_id, g")
def frame_multiline(spark: SparkSession, sf: str) -> DataFrame:
    return frame(conversations(spark, sf), F.col("content"), ["conv_id"], "multi-line", layout=LAYOUT).select("conv_id", "byte_offset", "raw")


@query(f"SELECT conv_id, CAST(sum(CASE WHEN g = 0 THEN 1 ELSE 0 END) AS BIGINT) AS headers, CAST(sum(CASE WHEN g > 0 AND mark NOT IN ('U', 'A') THEN 1 ELSE 0 END) AS BIGINT) AS trailers FROM {_GROUPED} GROUP BY conv_id")
def multiline_ignored_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The declarative form: lines, a running count of breaks, and what is dropped before and after."""
    lines = frame_lines(conversations(spark, sf), F.col("content"), ["conv_id"])
    breaks, includes = match_at(F.col("raw"), LAYOUT.breaks), match_at(F.col("raw"), LAYOUT.includes)
    rows = lines.withColumn("g", F.sum(breaks.cast("int")).over(Window.partitionBy("conv_id").orderBy("ordinal"))).withColumn("dropped", ~breaks & ~((F.col("g") > 0) & includes))
    return rows.groupBy("conv_id").agg(F.count_if(F.col("dropped") & (F.col("g") == 0)).alias("headers"), F.count_if(F.col("dropped") & (F.col("g") > 0)).alias("trailers"))


def _json_files(spark: SparkSession, sf: str, broken: bool = False) -> DataFrame:
    """Per job an array of its events; with ``broken`` every seventh element lacks its end."""
    item = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"state":"'), "state", F.lit('"'), F.when(F.lit(broken) & (F.col("event_id") % 7 == 0), F.lit(":1}")).otherwise("}"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", item.alias("x")))), lambda x: x["x"]), ",\n")
    return state_log(spark, sf).groupBy("job_id").agg(F.concat(F.lit("["), listed, F.lit("]")).alias("content"))


_ITEM = "'{\"id\":' || event_id || ',\"state\":\"' || state || '\"}'"


@query(f"SELECT job_id, row_number() OVER (PARTITION BY job_id ORDER BY event_id) - 1 AS ordinal, {_ITEM} AS raw FROM {E}")
def frame_json_array(spark: SparkSession, sf: str) -> DataFrame:
    return frame(_json_files(spark, sf), F.col("content"), ["job_id"], "json", first_field="id").select("job_id", "ordinal", "raw")


@query(f"SELECT job_id, count(*) AS elements FROM {E} WHERE event_id % 2 = 0 GROUP BY job_id")
def json_first_key(spark: SparkSession, sf: str) -> DataFrame:
    """Of elements whose first key alternates, those that begin with id."""
    files = _json_files(spark, sf).withColumn("content", F.regexp_replace("content", '\\{"id":(\\d*[13579]),', '{"key":$1,"id":0,'))
    return frame(files, F.col("content"), ["job_id"], "json", first_field="id").groupBy("job_id").agg(F.count("*").alias("elements"))


@query(f"SELECT job_id, 'MALFORMED_JSON' AS reason, count(*) AS n FROM {E} WHERE event_id % 7 = 0 GROUP BY job_id")
def json_reject_malformed(spark: SparkSession, sf: str) -> DataFrame:
    out = frame(_json_files(spark, sf, True), F.col("content"), ["job_id"], "json", first_field="id")
    return out.where("reason is not null").groupBy("job_id", "reason").agg(F.count("*").alias("n"))


def enveloped(spark: SparkSession, sf: str) -> DataFrame:
    records = frame(objects(spark, sf), F.col("content"), ROW).withColumn("chunk_id", F.lit("00000001"))
    return envelopes(records, F.col("doc_id").cast("string"), context={"sourceSystem": F.lit("corpus")})


_RECORDS = f"(SELECT l.*, bucket, key, version_id, etag, size, sha256({FILE_ID} || '/' || byte_offset) AS source_record_id, sha256(l.doc_id || '/' || sha256({FILE_ID} || '/' || byte_offset)) AS event_id FROM {lines_sql(O)} l JOIN {O} o ON l.doc_id = o.doc_id)"


@query(f"SELECT doc_id, event_id, source_record_id, split_part(key, '/', 3) AS file_name, ordinal AS record_number, byte_offset, CAST(nullif(strlen(raw), 0) AS BIGINT) AS byte_length, raw FROM {_RECORDS}")
def envelope_text(spark: SparkSession, sf: str) -> DataFrame:
    e = "envelope."
    return enveloped(spark, sf).select("doc_id", F.col(e + "metadata.eventId").alias("event_id"), F.col(e + "metadata.sourceRecordId").alias("source_record_id"), F.col(e + "source.fileName").alias("file_name"), F.col(e + "processing.recordNumber").alias("record_number"), F.col(e + "processing.byteOffset").alias("byte_offset"), F.col(e + "processing.byteLength").alias("byte_length"), F.col(e + "data.raw").alias("raw"))


def _attributes() -> Column:
    return sizes.attributes(schema=F.lit("record:1"), format=F.lit("text"), lang=F.element_at(F.split("key", "/"), 2), trace=F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("t"), F.col("doc_id").cast("string"))))


_TRACE = "CASE WHEN doc_id % 2 = 0 THEN 't' || doc_id END"


@query(f"SELECT doc_id, 'format=text;lang=' || split_part(key, '/', 2) || ';schema=record:1' || coalesce(';trace=' || {_TRACE}, '') AS attributes FROM {O}")
def envelope_attributes(spark: SparkSession, sf: str) -> DataFrame:
    entries = F.transform(F.array_sort(F.map_entries(_attributes())), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return objects(spark, sf).select("doc_id", F.array_join(entries, ";").alias("attributes"))


_ATTR_BYTES = f"(6 + 6 + 8 + 32) + (6 + 6 + 4 + 32) + (4 + 6 + strlen(split_part(key, '/', 2)) + 32) + CASE WHEN doc_id % 2 = 0 THEN 5 + 6 + strlen({_TRACE}) + 32 ELSE 0 END"


@query(f"SELECT doc_id, CAST(size + 64 + {_ATTR_BYTES} AS BIGINT) AS message_bytes FROM {O}")
def message_size(spark: SparkSession, sf: str) -> DataFrame:
    return objects(spark, sf).select("doc_id", sizes.message_size(F.col("content"), _attributes()).alias("message_bytes"))


@query(f"SELECT CASE WHEN size + 64 > 4000 THEN 'MESSAGE_TOO_LARGE' ELSE 'ACCEPTED' END AS reason, count(*) AS n FROM {O} GROUP BY 1")
def oversize_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = objects(spark, sf).withColumn("message_bytes", sizes.message_size(F.col("content"), F.create_map().cast("map<string,string>")))
    good, bad = split_by_size(rows, limit=4000)
    return reasons(good.withColumn("reason", F.lit("ACCEPTED")).select("reason").union(bad.select("reason")))


MAX_ITEMS, MAX_BYTES, EMPTY = 8, 2000, 100


def _bundles(spark: SparkSession, sf: str) -> DataFrame:
    items = enveloped(spark, sf).select("doc_id", "ordinal", "event_id", F.octet_length("raw").cast("long").alias("bytes"))
    return packed(items.where(fits(F.col("bytes"), MAX_BYTES, EMPTY)), ["doc_id"], ["ordinal"], "bytes", max_items=MAX_ITEMS, max_bytes=MAX_BYTES, empty_bytes=EMPTY, separator_bytes=1)


_PACK = f"""i AS (
  SELECT doc_id, ordinal, event_id, CAST(strlen(raw) AS BIGINT) AS bytes, row_number() OVER (PARTITION BY doc_id ORDER BY ordinal) AS rn FROM {_RECORDS} WHERE strlen(raw) + {EMPTY} <= {MAX_BYTES}
), p AS (
  SELECT doc_id, ordinal, event_id, bytes, rn, CAST(0 AS BIGINT) AS bundle_no, 1 AS n, {EMPTY} + bytes AS used FROM i WHERE rn = 1
  UNION ALL
  SELECT i.doc_id, i.ordinal, i.event_id, i.bytes, i.rn,
    CASE WHEN n >= {MAX_ITEMS} OR used + 1 + i.bytes > {MAX_BYTES} THEN bundle_no + 1 ELSE bundle_no END,
    CASE WHEN n >= {MAX_ITEMS} OR used + 1 + i.bytes > {MAX_BYTES} THEN 1 ELSE n + 1 END,
    CASE WHEN n >= {MAX_ITEMS} OR used + 1 + i.bytes > {MAX_BYTES} THEN {EMPTY} + i.bytes ELSE used + 1 + i.bytes END
  FROM p JOIN i ON p.doc_id = i.doc_id AND i.rn = p.rn + 1
)"""


@query(f"WITH RECURSIVE {_PACK} SELECT doc_id, bundle_no, count(*) AS items, CAST(sum(bytes) + {EMPTY} + count(*) - 1 AS BIGINT) AS bytes FROM p GROUP BY 1, 2")
def pack_bundles(spark: SparkSession, sf: str) -> DataFrame:
    return _bundles(spark, sf).groupBy("doc_id", "bundle_no").agg(F.count("*").alias("items"), (F.sum("bytes") + EMPTY + F.count("*") - 1).cast("long").alias("bytes"))


@query(f"WITH RECURSIVE {_PACK} SELECT doc_id, bundle_no, sha256(string_agg(event_id, '' ORDER BY event_id)) AS bundle_id FROM p GROUP BY 1, 2")
def bundle_identity(spark: SparkSession, sf: str) -> DataFrame:
    return bundled(_bundles(spark, sf), ["doc_id"], "event_id", ["ordinal"]).select("doc_id", "bundle_no", "bundle_id")


@query(f"SELECT event_id FROM {_RECORDS} WHERE strlen(raw) + {EMPTY} <= {MAX_BYTES}")
def bundle_expand(spark: SparkSession, sf: str) -> DataFrame:
    """Bundles to JSON bodies and back to single envelopes."""
    listed = bundled(_bundles(spark, sf), ["doc_id"], "event_id", ["ordinal"])
    bodies = listed.select(F.to_json(F.struct("bundle_id", F.transform("event_ids", lambda x: F.struct(x.alias("eventId"))).alias("items"))).alias("body"))
    return expanded(bodies, "struct<eventId: string>").select(F.col("envelope.eventId").alias("event_id"))


_BATCH = f"""i AS (SELECT doc_id, ordinal, CAST(strlen(raw) AS BIGINT) AS bytes, ordinal + 1 AS rn FROM {lines_sql(O)}
), p AS (
  SELECT doc_id, ordinal, bytes, rn, CAST(0 AS BIGINT) AS b, 1 AS n, bytes AS used FROM i WHERE rn = 1
  UNION ALL
  SELECT i.doc_id, i.ordinal, i.bytes, i.rn, CASE WHEN n >= 10 OR used + i.bytes > 3000 THEN b + 1 ELSE b END,
    CASE WHEN n >= 10 OR used + i.bytes > 3000 THEN 1 ELSE n + 1 END, CASE WHEN n >= 10 OR used + i.bytes > 3000 THEN i.bytes ELSE used + i.bytes END
  FROM p JOIN i ON p.doc_id = i.doc_id AND i.rn = p.rn + 1)"""


@query(f"WITH RECURSIVE {_BATCH} SELECT doc_id, b AS batch_no, count(*) AS entries, CAST(sum(bytes) AS BIGINT) AS bytes FROM p GROUP BY 1, 2")
def batch_split(spark: SparkSession, sf: str) -> DataFrame:
    items = frame_lines(objects(spark, sf), F.col("content"), ["doc_id"]).select("doc_id", "ordinal", F.octet_length("raw").cast("long").alias("bytes"))
    out = packed(items, ["doc_id"], ["ordinal"], "bytes", max_items=10, max_bytes=3000)
    return out.groupBy("doc_id", F.col("bundle_no").alias("batch_no")).agg(F.count("*").alias("entries"), F.sum("bytes").cast("long").alias("bytes"))


@query(f"SELECT doc_id, CAST(ordinal // 10 AS BIGINT) AS batch_no, count(*) AS entries FROM {lines_sql(O)} GROUP BY 1, 2")
def batch_by_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = frame_lines(objects(spark, sf), F.col("content"), ["doc_id"])
    return by_count(rows, ["ordinal"], 10, ["doc_id"]).groupBy("doc_id", "batch_no").agg(F.count("*").alias("entries"))


@query(f"SELECT coalesce(CASE WHEN split_part(key, '/', 2) = 'en' THEN 'https://queues/en' END, 'https://queues/default') AS route, count(*) AS n FROM {O} GROUP BY 1")
def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    own = F.when(F.element_at(F.split("key", "/"), 2) == "en", "https://queues/en")
    return objects(spark, sf).groupBy(F.coalesce(own, F.lit("https://queues/default")).alias("route")).agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, d AS data_type, d IN ('text', 'json', 'multi-line') AS accepted FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'csv' WHEN 2 THEN 'json' WHEN 3 THEN 'fixed-width' ELSE 'multi-line' END AS d FROM {O})")
def type_whitelist(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.element_at(F.array(*map(F.lit, ["text", "csv", "json", "fixed-width", "multi-line"])), (F.col("doc_id") % 5 + 1).cast("int"))
    return objects(spark, sf).select("doc_id", kinds.alias("data_type"), type_supported(kinds).alias("accepted"))


_ATTRIBUTE = "(SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'trace' WHEN 1 THEN 'aws.x' WHEN 2 THEN '.dot' WHEN 3 THEN 'a..b' WHEN 4 THEN 'Amazon.' || doc_id WHEN 5 THEN 'sp ace' WHEN 6 THEN repeat('n', 250 + doc_id % 13) ELSE lang END AS name, CASE doc_id % 5 WHEN 0 THEN 'Number' WHEN 1 THEN 'Binary' WHEN 2 THEN NULL ELSE 'String' END AS kind, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE source END AS value FROM documents)"


@query(f"SELECT doc_id, concat_ws(',', CASE WHEN NOT regexp_full_match(name, '[A-Za-z0-9_.-]{{1,256}}') THEN 'NAME' END, CASE WHEN lower(name) LIKE 'aws.%' OR lower(name) LIKE 'amazon.%' THEN 'RESERVED' END, CASE WHEN kind IS DISTINCT FROM 'String' THEN 'KIND' END, CASE WHEN value IS NULL OR value = '' THEN 'VALUE' END) AS codes FROM {_ATTRIBUTE}")
def validate_attributes(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("doc_id")
    name = F.when(n % 8 == 0, "trace").when(n % 8 == 1, "aws.x").when(n % 8 == 2, ".dot").when(n % 8 == 3, "a..b").when(n % 8 == 4, F.concat(F.lit("Amazon."), n.cast("string"))).when(n % 8 == 5, "sp ace").when(n % 8 == 6, F.repeat(F.lit("n"), (n % 13 + 250).cast("int"))).otherwise(F.col("lang"))
    kind = F.when(n % 5 == 0, "Number").when(n % 5 == 1, "Binary").when(n % 5 > 2, "String")
    value = F.when(n % 7 == 0, "").when(n % 7 > 1, F.col("source"))
    return table(spark, sf, "documents").select("doc_id", name.alias("name"), kind.alias("kind"), value.alias("value")).select("doc_id", F.array_join(errors(attribute_rules()), ",").alias("codes"))


@query("SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 9 = 0 THEN 'BODY' END, CASE WHEN doc_id % 13 > 10 THEN 'ATTRIBUTES' END, CASE WHEN (CASE WHEN doc_id % 9 = 0 THEN 0 WHEN doc_id % 50 = 1 THEN 1048500 ELSE 5 END) + 64 + (doc_id % 13) * (2 + 6 + 1 + 32) > 1048576 THEN 'SIZE' END) AS codes FROM documents")
def validate_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with up to twelve attributes and bodies up to the limit."""
    n = F.col("doc_id")
    body = F.when(n % 9 == 0, "").when(n % 50 == 1, F.repeat(F.lit("x"), F.lit(1_048_500))).otherwise("short")
    keys = F.when(n % 13 > 0, F.transform(F.sequence(F.lit(10), (n % 13 + 9).cast("int")), lambda i: i.cast("string"))).otherwise(F.array().cast("array<string>"))
    attributes = F.map_from_arrays(keys, F.transform(keys, lambda k: F.lit("v")))
    rows = table(spark, sf, "documents").select("doc_id", body.alias("body"), attributes.alias("attributes"))
    return rows.select("doc_id", F.array_join(errors(message_rules(F.col("body"), F.col("attributes"))), ",").alias("codes"))


@query(f"SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'permanent' WHEN 1 THEN 'permanent' WHEN 2 THEN 'permanent' WHEN 3 THEN 'permanent' WHEN 4 THEN 'permanent' ELSE 'transient' END AS error_class FROM documents")
def send_errors(spark: SparkSession, sf: str) -> DataFrame:
    codes = [*PERMANENT_ERRORS, "ThrottlingException"]
    code = F.get(F.array(*map(F.lit, codes)), (F.col("doc_id") % 7).cast("int"))
    return table(spark, sf, "documents").select("doc_id", send_error_class(code).alias("error_class"))


@query(f"WITH RECURSIVE {_PACK} SELECT doc_id, bundle_no, sha256(string_agg(event_id, '' ORDER BY event_id)) AS bundle_id, count(*) AS items, '{{\"schemaVersion\":\"1\",\"bundleId\":\"' || sha256(string_agg(event_id, '' ORDER BY event_id)) || '\",\"items\":[' || string_agg('{{\"eventId\":\"' || event_id || '\",\"bytes\":' || bytes || '}}', ',' ORDER BY ordinal) || ']}}' AS body FROM p GROUP BY 1, 2")
def bundle_bodies(spark: SparkSession, sf: str) -> DataFrame:
    items = _bundles(spark, sf).withColumn("body", F.to_json(F.struct(F.col("event_id").alias("eventId"), "bytes")))
    return bodies(items, ["doc_id"], "event_id", "body", ["ordinal"])


@query(f"WITH RECURSIVE {_PACK}, s AS (SELECT count(*) AS items, sum(bytes) + {EMPTY} + count(*) - 1 AS n FROM p GROUP BY doc_id, bundle_no) SELECT count(*) AS bundles, min(items) AS min_items, max(items) AS max_items, round(avg(items), 6) AS avg_items, CAST(min(n) AS BIGINT) AS min_bytes, CAST(max(n) AS BIGINT) AS max_bytes, round(avg(n), 4) AS avg_bytes FROM s")
def bundle_statistics(spark: SparkSession, sf: str) -> DataFrame:
    sizes_ = _bundles(spark, sf).groupBy("doc_id", "bundle_no").agg(F.count("*").alias("items"), (F.sum("bytes") + EMPTY + F.count("*") - 1).cast("int").alias("n"))
    out = bundle_stats(sizes_.withColumn("body", F.repeat(F.lit("x"), F.col("n"))))
    return out.withColumn("min_bytes", F.col("min_bytes").cast("long")).withColumn("max_bytes", F.col("max_bytes").cast("long"))


@query(f"WITH RECURSIVE {_BATCH} SELECT doc_id, b AS batch_no, count(*) AS messages, CAST(sum(CASE WHEN ordinal % 3 = 0 THEN 1 ELSE ordinal % 3 END) AS BIGINT) AS logical_events FROM p WHERE ordinal % 7 <> 0 GROUP BY 1, 2")
def delivery_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of batches but for those that failed; a message without a count holds one event."""
    items = frame_lines(objects(spark, sf), F.col("content"), ["doc_id"]).select("doc_id", "ordinal", F.octet_length("raw").cast("long").alias("bytes"), (F.col("ordinal") % 3).alias("logical_events"))
    sent = packed(items, ["doc_id"], ["ordinal"], "bytes", max_items=10, max_bytes=3000).withColumnRenamed("bundle_no", "batch_no")
    return deliveries(confirmed(sent, sent.where("ordinal % 7 = 0"), ["doc_id", "ordinal"]), ["doc_id", "batch_no"])
