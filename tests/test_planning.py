"""Plans on both sides of 5 MiB, of the largest chunk and of what a number can hold."""

import pytest
from pyspark.sql import functions as F

from recordmill.operators.framing import Layout
from recordmill.plans.padding import padded_tiles
from recordmill.plans.planner import chunk_count
from recordmill.plans.requests import checked, manifest, planned
from recordmill.sources.ranges import listed

MIB = 1024 * 1024
FIELDS = "array<struct<start:int,length:int,value:string>>"
REQUEST = f"execution_id string, schema_version string, bucket string, key string, version_id string, etag string, data_type string, max_record_bytes long, json_first_field string, json_max_element_bytes long, lines_max_record_bytes long, break_fields {FIELDS}, include_fields {FIELDS}, ignore_fields {FIELDS}"
U = [(0, 1, "U")]


def plan(spark, rows, **limits):
    """rows: (key, size, data_type, max_record, first, element bytes, line bytes, breaks)."""
    asked = [(k, "1", "b", k, None, None, kind, rec, first, el, ln, br, [], []) for k, _, kind, rec, first, el, ln, br in rows]
    heads = spark.createDataFrame([("b", k, "v", "e", size, True) for k, size, *_ in rows], "bucket string, key string, version_id string, etag string, size long, current boolean")
    checks = checked(spark.createDataFrame(asked, REQUEST), heads, **limits)
    chunks = planned(checks.where("error is null"), **limits)
    errors = {r.key: r.error for r in checks.collect()}
    ranges: dict = {}
    for r in chunks.orderBy("key", "start_byte").collect():
        ranges.setdefault(r.key, []).append((r.start_byte, r.end_byte))
    return errors, ranges, {r.execution_id: r.expected_chunks for r in manifest(checks, chunks).collect()}


def test_no_request_without_an_error_is_left_without_a_chunk(spark):
    rows = [
        ("small-text", MIB, "text", 100, None, None, None, None),
        ("text-at-5", 5 * MIB, "text", 100, None, None, None, None),
        ("whole-text", 4 * MIB, "text", 0, None, None, None, None),
        ("whole-text-larger", 4 * MIB + 1, "text", 0, None, None, None, None),
        ("json-cap", 10 * MIB, "json", 0, "id", 10 * MIB, None, None),
        ("json-overflow", 10 * MIB, "json", 0, "id", 2**62, None, None),
        ("json-good", 10 * MIB, "json", 0, "id", 30, None, None),
        ("json-no-field", 10 * MIB, "json", 0, "", 30, None, None),
        ("json-empty", 0, "json", 0, "id", 30, None, None),
        ("json-no-field-empty", 0, "json", 0, None, 30, None, None),
        ("lines-good", 3_000_001, "multi-line", 0, None, None, 10, U),
        ("lines-no-break", 10, "multi-line", 0, None, None, 10, []),
        ("lines-bad-break", 10, "multi-line", 0, None, None, 10, [(0, 2, "U")]),
        ("text-empty", 0, "text", 100, None, None, None, None),
    ]
    errors, ranges, expected = plan(spark, rows, max_chunk_bytes=4 * MIB, records_per_chunk=100_000)
    assert errors == {
        "small-text": None, "text-at-5": "CHUNK_MINIMUM", "whole-text": None, "whole-text-larger": "NOT_SPLITTABLE", "json-cap": "CHUNK_BYTES", "json-overflow": "OVERFLOW", "json-good": None, "json-no-field": "LAYOUT",
        "json-empty": "EMPTY", "json-no-field-empty": "LAYOUT", "lines-good": None, "lines-no-break": "LAYOUT", "lines-bad-break": "LAYOUT", "text-empty": "EMPTY",
    }
    good = {k for k, e in errors.items() if e is None}
    assert set(ranges) == set(expected) == good and all(n == len(ranges[k]) > 0 for k, n in expected.items())
    sizes = {r[0]: r[1] for r in rows}
    for k, tiles in ranges.items():
        assert tiles[0][0] == 0 and tiles[-1][1] == sizes[k] - 1 and all(a[1] + 1 == b[0] for a, b in zip(tiles, tiles[1:]))  # noqa: B905
    assert ranges["lines-good"] == [(0, 999_999), (1_000_000, 1_999_999), (2_000_000, 2_999_999), (3_000_000, 3_000_000)]


@pytest.mark.parametrize(("size", "most", "target", "count"), [(7 * MIB, 5 * MIB, 0, 1), (5 * MIB - 1, MIB, 0, 1), (5 * MIB, 4 * MIB, 0, None), (0, 64 * MIB, 0, None), (1000 * MIB, 64 * MIB, 0, 100), (1000 * MIB, 64 * MIB, 200 * MIB, 16), (30 * MIB, 0, MIB, 6), (10_000 * MIB, 0, 0, 157)])
def test_chunk_counts(spark, size, most, target, count):
    row = spark.range(1).select(chunk_count(F.lit(size).cast("long"), F.lit(most).cast("long"), F.lit(target).cast("long")).alias("n"))
    assert row.first().n == count


def test_an_execution_that_asks_for_something_is_not_sealed_without_chunks(spark):
    rows = spark.createDataFrame([("a", "k", None), ("b", None, None), ("c", "k", "EMPTY")], "execution_id string, key string, error string")
    none = spark.createDataFrame([], "execution_id string")
    assert [tuple(r) for r in manifest(rows, none).collect()] == [("b", 0, True, True)]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_padding_is_that_of_the_whole_file(spark, tmp_path, end):
    lines = ["H", "U1", "Acont", "xU", "U22", "AU", "A" * 30, "U3", "AA", "U4444444", "T"]
    data = (end.join(lines) + end).encode()
    (tmp_path / "f").write_bytes(data)
    breaks, at = [], 0
    for line in lines:
        if line.startswith("U"):
            breaks.append(at)
        at += len(line) + len(end)
    files = spark.createDataFrame([(p.path, p.size, p.version) for p in listed(str(tmp_path))], "path string, size long, version string")
    for most in (3, 7, 20):
        got = [(r.start_byte, r.end_byte, r.trailing_padding, r.error) for r in padded_tiles(files, Layout(breaks=[(0, 1, "U")]), F.lit(1), F.lit(most)).orderBy("start_byte").collect()]
        want = []
        for start in range(0, len(data), most):
            last = min(start + most, len(data)) - 1
            near = [b for b in breaks if last < b <= last + most]
            pad = 0 if last == len(data) - 1 else near[0] - last - 1 if near else len(data) - 1 - last if last + most >= len(data) - 1 else None
            want.append((start, last + (pad or 0), pad or 0, "NO_BREAK" if pad is None else None))
        assert got == want
    assert any(r[3] for r in want) or most == 20
