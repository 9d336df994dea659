"""Framed files as a Spark data source: partitions of byte ranges, records by their first byte.

    spark.dataSource.register(FramedFiles)
    spark.read.format("framed_file").option("path", folder).option("mode", "text").load()

A range of text or of multi-line records reads on past its end until its last record is complete, and
skips the record that began before it, so every tiling gives the same records. A JSON file is one range
here, read in blocks; ``operators.json_split.json_records`` reads large ones in parallel. A file that is
not the planned one any more ends the read, and so does a border without a line break (or a break of
the layout) within nine of the largest records. A partition is one range, or with ``partitionBytes``
as many as hold so many bytes: small files don't make a task each. The files' sizes are all that
planning looks at. Paths are those of ``sources.ranges``: mounted files, or a store that pyarrow knows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from recordmill.operators.framing import RECORD_SCHEMA, Layout, framed, line_bounds, matches, text_records
from recordmill.operators.json_split import Entry, Growing, elements
from recordmill.plans.planner import tiles
from recordmill.sources.ranges import Pinned, listed, opened

SCHEMA = "path string, file_size long, chunk_id string, ordinal long, byte_offset long, raw string, reason string, terminated boolean"
BLOCK = 8 * 1024 * 1024
BATCH_ROWS, BATCH_BYTES = 10_000, 4 * 1024 * 1024


class Range(InputPartition):
    def __init__(self, file: Pinned, chunk: int, start: int, end: int) -> None:
        self.file, self.chunk, self.start, self.end = file, chunk, start, end

    @property
    def size(self) -> int:
        return self.file.size


class Ranges(InputPartition):
    def __init__(self, ranges: list[Range]) -> None:
        self.ranges = ranges


def grouped_ranges(ranges: list[Range], most: int) -> list[Ranges]:
    """Neighbours together while they hold at most so many bytes; a larger one stays alone."""
    out, held = [], 0
    for r in ranges:
        size = r.end - r.start + 1
        if not out or held + size > most:
            out.append(Ranges([]))
            held = 0
        out[-1].ranges.append(r)
        held += size
    return out


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches as one of some thousand rows or some MB: each that is handed on takes its time."""
    held, rows, size = [], 0, 0
    for b in batches:
        held.append(b)
        rows, size = rows + b.num_rows, size + b.nbytes
        if rows >= BATCH_ROWS or size >= BATCH_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def ends_line(data: bytes) -> bool:
    return bool(data) and data[-1] in b"\r\n"


#: How many of the largest records a border may lie from the next break.
OVERLAP = 9


class BorderError(ValueError):
    """No break near the border of a range: a record is longer than the limit says."""

    def __init__(self, at: int, limit: int) -> None:
        super().__init__(f"no record break within {limit} bytes of the border at byte {at}; a record may be longer than the limit")


def line_start(f, at: int, size: int, limit: int = 0) -> int:
    """The first line start at or after ``at``; an error if that is over ``limit`` bytes away."""
    border = at
    if at == 0:
        return 0
    f.seek(at - 1)
    before = f.read(2)
    if before[:1] == b"\n" or (before[:1] == b"\r" and before[1:] != b"\n"):
        return at
    if before[:1] == b"\r":  # the range cuts a CRLF in two
        return at + 1
    f.seek(at)
    while block := f.read(65536):
        found = [i for i in (block.find(b"\n"), block.find(b"\r")) if i >= 0]
        if found:
            i = at + min(found)
            if limit and i - border > limit:
                raise BorderError(border, limit)
            f.seek(i)
            return i + (2 if f.read(2) == b"\r\n" else 1)
        at += len(block)
        if limit and at - border > limit:
            raise BorderError(border, limit)
    return size


def blocks_of_lines(f, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Whole lines between two line starts, some MB at a time, with their offsets."""
    f.seek(start)
    rest, at = b"", start
    while at + len(rest) < stop:
        block = f.read(min(BLOCK, stop - at - len(rest)))
        data = rest + block
        if at + len(data) >= stop:
            yield at, data
            return
        cut = max(data.rfind(b"\n"), data.rfind(b"\r"))
        if data[cut : cut + 1] == b"\r" and cut == len(data) - 1:  # its LF may follow
            cut = max(data.rfind(b"\n", 0, cut), data.rfind(b"\r", 0, cut))
        yield at, data[: cut + 1]
        rest, at = data[cut + 1 :], at + cut + 1


class FramedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.mode = options.get("mode", "text")
        self.path = options["path"]
        self.target = int(options.get("targetchunkbytes", options.get("targetChunkBytes", 64 * 1024 * 1024)))
        self.partition_bytes = int(options.get("partitionbytes", options.get("partitionBytes", 0)))
        self.max_bytes = int(options.get("maxrecordbytes", options.get("maxRecordBytes", 0)))
        self.strict = options.get("finalterminator", options.get("finalTerminator", "lenient")) == "strict"
        self.first_field = options.get("firstfieldname", options.get("firstFieldName"))
        layout = options.get("layout")
        self.layout = Layout(**json.loads(layout)) if layout else None
        if self.layout:
            for name in ("breaks", "includes", "ignores"):
                setattr(self.layout, name, [tuple(x) for x in getattr(self.layout, name)])

    def ranges(self, files: list[Pinned]) -> list[Range]:
        out = []
        for p in files:
            cut = [(0, p.size - 1)] * bool(p.size) if self.mode == "json" else tiles(p.size, self.target)
            out += [Range(p, k, a, b) for k, (a, b) in enumerate(cut, 1)]
        return out

    def planned(self, files: list[Pinned]) -> list[Range] | list[Ranges]:
        ranges = self.ranges(files)
        return grouped_ranges(ranges, self.partition_bytes) if self.partition_bytes else ranges

    def partitions(self) -> list[Range] | list[Ranges]:
        return self.planned(listed(self.path))

    def read(self, part: Range | Ranges) -> Iterator[pa.RecordBatch]:
        return together(self.read_ranges(part.ranges if isinstance(part, Ranges) else [part]))

    def read_ranges(self, ranges: list[Range]) -> Iterator[pa.RecordBatch]:
        for file, of_file in groupby(ranges, key=lambda r: r.file):
            with opened(file) as f:
                for r in of_file:
                    yield from self.read_range(f, r)

    def read_range(self, f, r: Range) -> Iterator[pa.RecordBatch]:
        n = 0
        batches = {"json": self.elements, "text": self.text}.get(self.mode, self.grouped)(f, r)
        for b in batches:
            same = [pa.array([x] * b.num_rows, t) for x, t in ((r.file.path, pa.string()), (r.size, pa.int64()), (f"{r.chunk:08d}", pa.string()))]
            ordinal = pa.array(np.arange(n, n + b.num_rows))
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([*same, ordinal, *b.columns[1:]], names=["path", "file_size", "chunk_id", *RECORD_SCHEMA.names])

    def elements(self, f, r: Range) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, RECORD_SCHEMA.types, strict=True)], schema=RECORD_SCHEMA)
        for at, raw, reason in elements(Growing(f, 0, min(BLOCK, r.size), r.size), Entry(), r.size, self.first_field, self.max_bytes):
            rows.append((0, at, None if reason else raw.decode(), reason, True))
            held += len(raw)
            if held > BLOCK:
                yield batch()
                rows, held = [], 0
        yield batch()

    def text(self, f, r: Range) -> Iterator[pa.RecordBatch]:
        limit = OVERLAP * self.max_bytes
        start, stop = line_start(f, r.start, r.size, limit), line_start(f, r.end + 1, r.size, limit) if r.end + 1 < r.size else r.size
        for at, data in blocks_of_lines(f, start, stop):
            yield text_records(data, base=at, max_bytes=self.max_bytes, strict_end=self.strict, at_end=at + len(data) == r.size)

    def grouped(self, f, r: Range) -> Iterator[pa.RecordBatch]:
        """From the first break that starts in the range to the first one after it."""
        start, stop = self.next_break(f, line_start(f, r.start, r.size), r.size), r.size
        if r.end + 1 < r.size:
            stop = self.next_break(f, line_start(f, r.end + 1, r.size), r.size)
        if start < stop:
            f.seek(start)
            out = framed(f.read(stop - start), "multi-line", layout=self.layout, max_bytes=self.max_bytes)
            yield out.set_column(1, "byte_offset", pa.array(out.column(1).to_numpy() + start))

    def next_break(self, f, at: int, size: int) -> int:
        limit = OVERLAP * self.max_bytes
        for base, data in blocks_of_lines(f, at, size):
            starts, ends, _ = line_bounds(np.frombuffer(data, np.uint8))
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                if limit and base + a - at > limit:
                    raise BorderError(at, limit)
                if matches(data[a:b], self.layout.breaks):
                    return base + a
        return size


class FramedStreamReader(FramedReader, DataSourceStreamReader):
    """Files that were not there at the last trigger, whatever their names.

    An offset holds the newest time of change and the files (name and time) of the ``maxFileAge``
    seconds before it, a week unless set; older ones are taken to be seen, but for the first trigger,
    which reads all. A file that changes is a new one. So the offset grows with the files of that
    time only, and one that comes late is read as long as it is not older."""

    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.age = int(float(options.get("maxfileage", options.get("maxFileAge", 7 * 86_400))) * 1e9)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"newest": None, "seen": []}

    def latestOffset(self) -> dict:  # noqa: N802
        files = listed(self.path)
        newest = max((int(p.version) for p in files), default=None)
        return {"newest": newest, "seen": sorted(_name(p) for p in files if int(p.version) >= newest - self.age)}

    def partitions(self, start: dict, end: dict) -> list[Range] | list[Ranges]:
        before, after = set(start["seen"]), set(end["seen"])
        old = lambda p, offset: offset["newest"] is not None and int(p.version) < offset["newest"] - self.age
        new = [p for p in listed(self.path) if not (old(p, start) or _name(p) in before) and (old(p, end) or _name(p) in after)]
        if missing := after - before - {_name(p) for p in new}:
            raise ValueError(f"files have gone or changed since they were planned: {sorted(missing)[:3]}")
        return self.planned(new)

    def commit(self, end: dict) -> None:
        pass


def _name(file: Pinned) -> str:
    return f"{file.path}@{file.version}"


class FramedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "framed_file"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FramedReader:
        return FramedReader(self.options)

    def streamReader(self, schema) -> FramedStreamReader:  # noqa: N802
        return FramedStreamReader(self.options)
