"""What the operators of this subpackage share: shared folders, written tables, Arrow helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Only where that
    is unset (tests, a single machine) is a local folder made and set for the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="recordmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/recordmill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, keep: Sequence[str | Column], results: Sequence[str]) -> tuple[tuple[Column, ...], Callable[[DataFrame], DataFrame]]:
    """The kept columns under generated names, whatever theirs are (dots, names that an operator uses
    itself), and a function that gives them their names back; one that is named like a result is
    called input_<name> there."""
    columns = [quoted(c) if isinstance(c, str) else c for c in keep]
    names = docs.select(*columns).columns
    taken = {r.lower() for r in results}

    def back(df: DataFrame) -> DataFrame:
        kept = [F.col(f"__keep{i}").alias(f"input_{c}" if c.lower() in taken else c) for i, c in enumerate(names)]
        return df.select(*kept, *[quoted(c) for c in df.columns if not c.startswith("__keep")])

    return tuple(c.alias(f"__keep{i}") for i, c in enumerate(columns)), back


def quoted(name: str) -> Column:
    """The column of exactly that name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def crc32_of(name: str) -> Column:
    """crc32 of the id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def arrow_map(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None]], schema: str, most: int = 4_000_000) -> DataFrame:
    """mapInArrow with a function made once per task; batches of more than ``most`` bytes are cut first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            for part in small(batch, most):
                out = step(part)
                if out is not None:
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def small(batch: pa.RecordBatch, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes at most, one row at least."""
    if not batch.num_rows:
        return
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)
