"""Sinks: reports as JSON lines, records by route, files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.sources.ranges import mounted


def write_report(df: DataFrame, path: str, key: str | None = None) -> None:
    """JSON lines, one per distinct key."""
    (df.dropDuplicates([key]) if key else df).write.mode("overwrite").json(path)


def write_reports(path: str, **reports: DataFrame) -> None:
    """The reports of a run, each in a folder of its name."""
    for name, df in reports.items():
        write_report(df, f"{path}/{name}")


def write_by_route(df: DataFrame, path: str, route: str = "route") -> None:
    """Records in a folder per route; a failed task commits nothing."""
    df.write.mode("append").partitionBy(route).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Files with a header, semicolons between fields, and the mark by which spreadsheets know UTF-8."""
    names = ";".join(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = True
        for b in batches:
            if head:
                yield pa.RecordBatch.from_pydict({"value": ["\ufeff" + names]})
            head = False
            yield b

    df.select(F.to_csv(F.struct("*"), {"sep": ";"}).alias("value")).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def write_files(df: DataFrame, path: str, name: str = "name", content: str = "content") -> None:
    """Each row's content as a file of that name below a mounted folder, written by the tasks. A file
    appears whole or not at all, so a task that runs again only repeats it. Null contents have none; of
    rows with one name any one's content stays. A path of another scheme than file: is an error."""
    root = mounted(path)
    if root is None:
        raise ValueError(f"{path} is no mounted folder")

    def write(rows) -> None:
        for file, data in rows:
            to = os.path.join(root, file)
            os.makedirs(os.path.dirname(to), exist_ok=True)
            part = f"{to}.{uuid.uuid4().hex}.part"
            with open(part, "wb") as f:
                f.write(data)
            os.replace(part, to)

    rows = df.select(name, df[content].cast("binary"))
    rows.where(rows[content].isNotNull()).foreachPartition(write)
