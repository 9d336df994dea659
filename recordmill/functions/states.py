"""States of jobs and chunks, reasons, and predicates on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a job or a chunk may go from each state.
JOB = {
    "RECEIVED": ["VALIDATING", "REJECTED", "FAILED"],
    "VALIDATING": ["PLANNING", "REJECTED", "FAILED"],
    "PLANNING": ["PROCESSING", "COMPLETED", "REJECTED", "FAILED"],
    "PROCESSING": ["COMPLETED", "FAILED"],
    "COMPLETED": [],
    "REJECTED": [],
    "FAILED": [],
}
CHUNK = {
    "PENDING": ["RUNNING"],
    "RUNNING": ["COMPLETED", "RETRY_PENDING", "FAILED"],
    "RETRY_PENDING": ["RUNNING"],
    "COMPLETED": [],
    "FAILED": [],
}
#: The older words for job states.
LEGACY = {"PENDING": "PLANNING", "SCHEDULED": "PROCESSING", "SCHEDULING_FAILED": "FAILED", "RUNNING": "PROCESSING"}
#: Why a file or record is refused.
REASONS = ["EMPTY_FILE", "INVALID_CONFIGURATION", "UNSUPPORTED_TYPE", "FILE_TOO_LARGE", "INVALID_UTF8", "OVERSIZED_RECORD", "UNTERMINATED_RECORD", "MALFORMED_JSON", "MESSAGE_TOO_LARGE", "MULTILINE_HEADER", "MULTILINE_TRAILER"]
DATA_TYPES = ["text", "multi-line", "json"]


def _map(transitions: dict[str, list[str]]) -> Column:
    return F.create_map(*[x for k, v in transitions.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])


def can_transition(transitions: dict[str, list[str]], old: Column, new: Column) -> Column:
    """False from or to an unknown state."""
    return F.coalesce(F.array_contains(F.try_element_at(_map(transitions), old), new), F.lit(False))


def terminal(transitions: dict[str, list[str]], state: Column) -> Column:
    """Known, and with nowhere to go."""
    return F.coalesce(F.size(F.try_element_at(_map(transitions), state)) == 0, F.lit(False))


def canonical(state: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in LEGACY.items() for x in kv]), state), state)


def job_result(failed: Column, rejected: Column) -> tuple[Column, Column]:
    """Status and result of a job whose chunks have all ended; a failed job has no result."""
    status = F.when(failed > 0, "FAILED").otherwise("COMPLETED")
    return status, F.when(failed > 0, F.lit(None).cast("string")).when(rejected > 0, "WITH_REJECTIONS").otherwise("SUCCESS")
