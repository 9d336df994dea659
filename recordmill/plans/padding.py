"""Multi-line plans: tiles of a fixed size, each with the bytes up to the next record's break.

Only the bytes behind each tile's end are read, as many as a record may have, by tasks; a tile's end is
a row, whatever the file's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.operators.framing import Layout, matches
from recordmill.plans.planner import nominal_tiles
from recordmill.sources.ranges import Pinned, opened


def next_break(f, border: int, size: int, most: int, layout: Layout) -> int | None:
    """Bytes from ``border`` (the first byte behind a tile) to the first line at or behind it that is a
    break and begins within ``most`` bytes; those to the end of the file if that comes first; null if
    there is neither. A line counts where it really starts, so the two bytes before the border are
    read, and as much of it as the break fields look at."""
    look = min(border + most, size)
    widest = max(s + n for s, n, _ in layout.breaks)
    begin = max(border - 1, 0)
    f.seek(begin)
    data = f.read(look - begin + widest + 1)
    at = border - begin
    start = at if border == 0 or data[at - 1 : at] == b"\n" or (data[at - 1 : at] == b"\r" and data[at : at + 1] != b"\n") else None
    while True:
        if start is None:  # to the next line
            ends = [i for i in (data.find(b"\n", at), data.find(b"\r", at)) if i >= 0]
            if data[at - 1 : at] == b"\r" and data[at : at + 1] == b"\n":
                ends = [at]
            if not ends:
                break
            end = min(ends)
            start = end + (2 if data[end : end + 2] == b"\r\n" else 1)
        if begin + start >= look:
            break
        line = data[start:]
        for mark in (b"\r", b"\n"):
            line = line.split(mark, 1)[0]
        if matches(line, layout.breaks):
            return begin + start - border
        at, start = start, None
    return size - border if look == size else None


def padded_tiles(objects: DataFrame, layout: Layout, records: Column, max_element: Column) -> DataFrame:
    """objects: path, size, version and more -> a row for each tile: chunk_id, start_byte, end_byte,
    trailing_padding and ``error`` (NO_BREAK, if no record begins within the largest one's bytes).

    Tiles own the nominal bytes from start_byte; end_byte counts the padding in. The last tile of a file
    has none."""
    tiles = nominal_tiles(objects.withColumn("__most", max_element.cast("long")), records, max_element)
    rows = tiles.repartition("path", "chunk_id")
    fields = asdict(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = Layout(**fields)
        for b in batches:
            paths, sizes, versions, ends, most = (b.column(c).to_pylist() for c in ("path", "size", "version", "end_byte", "__most"))
            padding = []
            for p, size, version, end, n in zip(paths, sizes, versions, ends, most, strict=True):
                if end == size - 1:
                    padding.append(0)
                    continue
                with opened(Pinned(p, size, version)) as f:
                    padding.append(next_break(f, end + 1, size, n, how))
            yield b.append_column("__padding", pa.array(padding, pa.int64()))

    found = rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", __padding bigint")
    pad = F.coalesce("__padding", F.lit(0).cast("long"))
    out = found.withColumns({"end_byte": F.col("end_byte") + pad, "trailing_padding": pad, "error": F.when(F.col("__padding").isNull(), "NO_BREAK")})
    return out.drop("__padding", "__most")
