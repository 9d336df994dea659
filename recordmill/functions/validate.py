"""Validation rules: each a code and the condition under which it is broken.

``errors`` gives the codes of all broken rules as an array, so a row is valid if that is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.sizes import MAX_ATTRIBUTES, message_size
from recordmill.functions.states import DATA_TYPES

Rule = tuple[str, Column]
MIN_CHUNK, MAX_CHUNK = 5 * 1024 * 1024, 100 * 1024 * 1024
MIN_BYTES, MAX_EVENT = 1024, 1_048_576
DEFAULT_CHUNK_LIMIT = 64 * 1024 * 1024
MAX_FIELDS = 99


@dataclass(frozen=True)
class Limits:
    """What no configuration may exceed. types: data type -> (largest file, largest record)."""

    max_file_bytes: int
    max_chunk_bytes: int
    max_event_bytes: int
    max_batch_size: int
    types: dict[str, tuple[int, int]]

    def of_type(self, data_type: Column, k: int) -> Column:
        """Null for an unknown type."""
        return F.try_element_at(F.create_map(*[F.lit(x) for t, v in self.types.items() for x in (t, v[k])]).cast("map<string,bigint>"), data_type)


def errors(rules: list[Rule]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(code)) for code, broken in rules]), lambda x: x.isNotNull())


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    checked = df.withColumn("errors", errors(rules))
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def type_supported(data_type: Column) -> Column:
    return F.coalesce(data_type.isin(DATA_TYPES), F.lit(False))


def absent(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def outside(value: Column, low: int, high: Column | int) -> Column:
    return value.isNull() | (value < low) | (value > (F.lit(high) if isinstance(high, int) else high))


def bad_fields(fields: Column) -> Column:
    """More than 99 fields, or one whose value is not as long as it says."""
    wrong = lambda x: (x["start"] < 0) | (x["length"] < 1) | (F.octet_length(x["value"]) != x["length"])
    return (F.size(fields) > MAX_FIELDS) | F.coalesce(F.exists(fields, wrong), F.lit(False))


def bad_queue(name: str) -> Column:
    return ~absent(name) & ~F.col(name).startswith("https://sqs.") & ~F.col(name).startswith("http://")


def prefix_config_rules(limits: Limits) -> list[Rule]:
    """For rows of prefix configuration."""
    c = F.col
    file_limit, record_limit = limits.of_type(c("data_type"), 0), limits.of_type(c("data_type"), 1)
    largest = F.greatest(c("max_record_bytes"), c("json_max_element_bytes"), c("lines_max_record_bytes"))
    lines = (F.coalesce(F.size("break_fields"), F.lit(0)) < 1) | outside(c("lines_max_record_bytes"), 1, 2**62) | bad_fields(c("break_fields")) | bad_fields(c("include_fields")) | bad_fields(c("ignore_fields"))
    bundle = (c("max_envelopes") < 0) | ((c("max_message_bytes") != 0) & outside(c("max_message_bytes"), MIN_BYTES, c("max_event_bytes")))
    return [
        ("TYPE", ~type_supported(c("data_type"))),
        ("RECORDS_PER_CHUNK", outside(c("records_per_chunk"), 1, 2**31 - 1)),
        ("BATCH_SIZE", outside(c("batch_size"), 1, min(10, limits.max_batch_size))),
        ("EVENT_BYTES", outside(c("max_event_bytes"), MIN_BYTES, min(MAX_EVENT, limits.max_event_bytes))),
        ("CHUNK_BYTES", outside(c("max_chunk_bytes"), MIN_BYTES, limits.max_chunk_bytes)),
        ("FILE_BYTES", c("max_file_bytes").isNull() | (c("max_file_bytes") < c("max_chunk_bytes")) | (c("max_file_bytes") > limits.max_file_bytes) | (c("max_file_bytes") > file_limit)),
        ("RECORD_BYTES", largest > record_limit),
        ("SCHEMA", absent("event_schema_id") | absent("event_schema_version") | absent("event_format")),
        ("JSON_LAYOUT", (c("data_type") == "json") & (absent("json_first_field") | outside(c("json_max_element_bytes"), 1, 2**62))),
        ("LINES_LAYOUT", (c("data_type") == "multi-line") & lines),
        ("OUTPUT_MODE", ~F.coalesce(c("output_mode"), F.lit("")).isin("", "single", "bundle")),
        ("BUNDLE", (c("output_mode") == "bundle") & bundle),
        ("PREFIX_ID", ~absent("prefix_id") & ~c("prefix_id").rlike("^[A-Za-z0-9_-]+$")),
        ("QUEUE_URL", bad_queue("output_queue_url")),
        ("CHUNK_QUEUE_URL", bad_queue("chunk_queue_url") | (~absent("prefix_id") & absent("chunk_queue_url"))),
        ("TARGET_BYTES", (c("target_chunk_bytes") != 0) & outside(c("target_chunk_bytes"), MIN_CHUNK, F.least(F.lit(MAX_CHUNK), c("max_chunk_bytes")))),
    ]


def global_limit_rules() -> list[Rule]:
    """For rows of limits; input_types: map of type to (max_file_bytes, max_record_bytes)."""
    c = F.col

    def wrong(t: str) -> Column:
        of = F.try_element_at(c("input_types"), F.lit(t))
        return of.isNull() | outside(of["max_file_bytes"], 1, c("max_file_bytes")) | outside(of["max_record_bytes"], 1, c("max_event_bytes"))

    return [
        ("FILE_BYTES", c("max_file_bytes").isNull() | (c("max_file_bytes") < MIN_BYTES)),
        ("CHUNK_BYTES", outside(c("max_chunk_bytes"), MIN_BYTES, c("max_file_bytes"))),
        ("EVENT_BYTES", outside(c("max_event_bytes"), MIN_BYTES, MAX_EVENT)),
        ("BATCH_SIZE", outside(c("max_batch_size"), 1, 10)),
        ("TYPES", wrong("text") | wrong("json") | wrong("multi-line")),
    ]


def chunk_rules(max_chunk_bytes: int = 0) -> list[Rule]:
    c = F.col
    n = c("end_byte") - c("start_byte") + 1
    return [
        ("VERSION", absent("schema_version")),
        ("ORIGIN", absent("bucket") | absent("key")),
        ("RANGE", c("start_byte").isNull() | (c("start_byte") < 0) | (c("end_byte") < c("start_byte"))),
        ("CHUNK_BYTES", n > (max_chunk_bytes or DEFAULT_CHUNK_LIMIT)),
        ("SIZE", (c("file_size") > 0) & (c("end_byte") >= c("file_size"))),
        ("TYPE", ~type_supported(c("data_type"))),
        ("PADDING", (c("max_record_bytes") > 0) & ((c("trailing_padding") < 0) | (c("trailing_padding") > c("max_record_bytes")) | (n < c("trailing_padding")))),
        ("JSON_LAYOUT", (c("data_type") == "json") & (absent("json_first_field") | outside(c("json_max_element_bytes"), 1, 2**62))),
        ("LINES_LAYOUT", (c("data_type") == "multi-line") & (F.coalesce(F.size("break_fields"), F.lit(0)) < 1)),
    ]


def attribute_rules(name: str = "name", kind: str = "kind", value: str = "value") -> list[Rule]:
    c = F.col
    return [
        ("NAME", ~F.coalesce(c(name).rlike(r"^[A-Za-z0-9_.-]{1,256}$"), F.lit(False))),
        ("RESERVED", F.lower(c(name)).startswith("aws.") | F.lower(c(name)).startswith("amazon.")),
        ("KIND", ~F.coalesce(c(kind) == "String", F.lit(False))),
        ("VALUE", F.coalesce(c(value), F.lit("")) == ""),
    ]


def message_rules(body: Column, attributes: Column) -> list[Rule]:
    """For a message of a body and a map of attributes."""
    return [
        ("BODY", F.coalesce(body, F.lit("")) == ""),
        ("ATTRIBUTES", F.size(attributes) > MAX_ATTRIBUTES),
        ("SIZE", message_size(body, attributes) > MAX_EVENT),
    ]


def url_allowed(url: Column, host_suffix: str) -> Column:
    """https, no user information, and a host that is or ends in the suffix."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.coalesce((F.try_parse_url(url, F.lit("PROTOCOL")) == "https") & F.try_parse_url(url, F.lit("USERINFO")).isNull() & ((host == host_suffix) | host.endswith("." + host_suffix)), F.lit(False))


#: Errors of a send that trying again does not mend.
PERMANENT_ERRORS = ["BatchRequestTooLong", "InvalidBatchEntryId", "InvalidMessageContents", "TooManyEntriesInBatchRequest", "UnsupportedOperation"]


def send_error_class(code: Column) -> Column:
    return F.when(code.isin(PERMANENT_ERRORS), "permanent").otherwise("transient")
