"""Timestamps of JSON documents in a zone's local time, at any depth, with every other byte kept."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone, tzinfo
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_text = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: A field with a text value, or a text by itself; the latter so that nothing inside texts is looked at.
_field = re.compile(rf"(?P<key>{_text})(?P<colon>[ \t\r\n]*:[ \t\r\n]*)(?P<value>{_text})|{_text}", re.DOTALL)
_moment = re.compile(r"(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)(\.\d+)?(Z|[+-]\d\d:\d\d)")


def zone_of(name: str) -> tzinfo:
    """A zone by name, or a fixed one by its offset (±HH:MM)."""
    if found := re.fullmatch(r"([+-])(\d\d):(\d\d)", name):
        sign, hours, minutes = found.groups()
        return timezone((-1 if sign == "-" else 1) * timedelta(hours=int(hours), minutes=int(minutes)))
    return ZoneInfo(name)


def local_moment(value: str, zone: tzinfo) -> str:
    """An RFC 3339 time in the zone, fractions without trailing zeros; any other text as it is."""
    found = _moment.fullmatch(value)
    if not found:
        return value
    try:
        at = datetime.fromisoformat(found[1] + found[3].replace("Z", "+00:00")).astimezone(zone)
    except (ValueError, OverflowError):
        return value
    out = at.strftime("%Y-%m-%dT%H:%M:%S").rjust(19, "0")
    offset = at.strftime("%z")
    fraction = (found[2] or "").rstrip("0").rstrip(".")
    return out + fraction + ("Z" if int(offset[1:5]) == 0 else f"{offset[:3]}:{offset[3:5]}")


def localised_json(document: str, zone: tzinfo) -> str:
    """Fields named timestamp or ...At, wherever they are; what is no JSON stays as it is."""

    def change(m: re.Match) -> str:
        if m["key"] is None:
            return m[0]
        name, value = json.loads(m["key"]), json.loads(m["value"])
        if not (name.endswith("At") or name == "timestamp") or (moved := local_moment(value, zone)) == value:
            return m[0]
        return m["key"] + m["colon"] + json.dumps(moved)

    try:
        json.loads(document)
    except (ValueError, RecursionError):
        return document
    return _field.sub(change, document)


def localised_documents(df: DataFrame, column: str, zone: str) -> DataFrame:
    """``df`` with the JSON texts of ``column`` localised; a projection. Null texts stay null."""
    names = df.columns
    at = names.index(column)
    rows = df.withColumn(column, F.col(f"`{column}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = zone_of(zone)
        for b in batches:
            done = pa.array([None if x is None else localised_json(x, where) for x in b.column(at).to_pylist()], pa.string())
            yield b.set_column(at, b.schema.field(at), done)

    return rows.mapInArrow(run, rows.schema)
