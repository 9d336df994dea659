"""JSON arrays cut anywhere: what every block needs to know of the bytes before it.

A block of bytes is a function on the lexer's state: for each state it may be entered in (outside
strings, in a string, after a backslash) where it leaves it, how far the depth of brackets moves, and
how low it comes on the way. Blocks are scanned in parallel, wherever they are; their functions, a few
numbers each, are then composed in order of a file. So every range knows the state it starts in, and
no text that looks like the start of an element can mislead it.

The elements are those of the file's top-level array, each from its first character to the comma or
closing bracket behind it, by brackets and strings alone. What is no JSON between these borders is
one malformed element, the same for every tiling.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators.framing import utf8_ok
from recordmill.sources.ranges import Pinned, listed, opened

OUT, STRING, ESCAPE = 0, 1, 2
BEFORE, INSIDE, AFTER, NO_ARRAY = "before", "inside", "after", "no array"
#: No bracket in a block: it comes nowhere lower.
NEVER = 2**62
BLANK = b" \t\r\n"

#: A string, or what there is of it: group 1 is set (to a last backslash or to nothing) if it stays open.
_string = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|(\\?)\Z)', re.DOTALL)
_rest = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+', re.DOTALL)
_token = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"|["\[\]{},]', re.DOTALL)
_no_bracket = bytes(b for b in range(256) if b not in b"[]{}")
_move = np.zeros(256, np.int8)
_move[[ord("["), ord("{")]], _move[[ord("]"), ord("}")]] = 1, -1


def scanned(data: bytes) -> tuple[int, int, int]:
    """Entered outside strings: the state at the end, the depth's move, and the lowest on the way."""
    parts = _string.split(data)
    last = parts[-2] if len(parts) > 1 else None
    end = OUT if last is None else ESCAPE if last else STRING
    brackets = b"".join(parts[::2]).translate(None, _no_bracket)
    moves = _move[np.frombuffer(brackets, np.uint8)].cumsum(dtype=np.int64)
    return (end, int(moves[-1]), int(moves.min())) if len(moves) else (end, 0, NEVER)


def block_function(data: bytes) -> list[tuple[int, int, int]]:
    """For each state that the block may be entered in: (state at the end, move, lowest)."""
    out = [scanned(data)]
    for skip in (0, 1):  # in a string, and there behind a backslash
        at = _rest.match(data, skip).end()
        out.append(scanned(data[at + 1 :]) if data[at : at + 1] == b'"' else (STRING if at == len(data) else ESCAPE, 0, NEVER))
    return out


@dataclass
class Entry:
    """The state in which a block is entered."""

    phase: str = BEFORE
    lexer: int = OUT
    depth: int = 0

    def after(self, function: list[tuple[int, int, int]], first: str | None) -> Entry:
        """``first``: the block's first character that is no white space, null if it has none."""
        if self.phase in (AFTER, NO_ARRAY) or (self.phase == BEFORE and first is None):
            return self
        if self.phase == BEFORE and first != "[":
            return Entry(NO_ARRAY)
        lexer, move, low = function[self.lexer]
        return Entry(AFTER) if self.depth + low <= 0 else Entry(INSIDE, lexer, self.depth + move)


def first_character(data: bytes) -> str | None:
    rest = data.lstrip(BLANK)
    return rest[:1].decode("latin-1") if rest else None


class Growing:
    """Bytes from a place on, more of them when they are asked for, up to the file's end."""

    def __init__(self, f, at: int, stop: int, size: int) -> None:
        self.f, self.base, self.size, self.step = f, at, size, 1 << 16
        f.seek(at)
        self.data = f.read(max(stop - at, 0))

    def more(self) -> bool:
        """Twice as many each time, so that a long string is not looked through too often."""
        got = self.f.read(min(self.step, self.size - self.base - len(self.data)))
        self.data += got
        self.step *= 2
        return bool(got)

    def drop(self, n: int) -> None:
        self.data, self.base = self.data[n:], self.base + n

    def last_before(self) -> bytes:
        """The last character before the place that is no white space."""
        here, at, out = self.f.tell(), self.base, b""
        while at and not out:
            n = min(4096, at)
            self.f.seek(at - n)
            out = self.f.read(n).rstrip(BLANK)[-1:]
            at -= n
        self.f.seek(here)
        return out


def skipped(g: Growing, at: int, lexer: int, depth: int, limit: int = 0, drop: bool = False) -> tuple[int, int, bool]:
    """From ``at``, in that state: where the array's own comma or closing bracket is, the depth there
    (0 where the array closes) and whether it was found. It is given up more than ``limit`` bytes on, at
    a place outside strings from where it can be taken up; ``drop`` forgets what was passed."""
    start = at
    while lexer != OUT:
        skip = at + (lexer == ESCAPE)
        end = _rest.match(g.data, skip).end() if skip <= len(g.data) else at
        if skip <= len(g.data) and g.data[end : end + 1] == b'"':
            at, lexer = end + 1, OUT
        elif not g.more():
            return len(g.data), depth, False
    while True:
        stuck = len(g.data)
        for m in _token.finditer(g.data, at):
            t = m[0]
            if t == b'"':
                stuck = m.start()
                break
            at = m.end()
            if t == b"{" or t == b"[":
                depth += 1
            elif t == b"}" or t == b"]":
                depth -= 1
                if depth <= 0:
                    return m.start(), 0, True
            elif t == b"," and depth == 1:
                return m.start(), 1, True
            if limit and at - start > limit:
                return at, depth, False
        at = stuck
        if limit and len(g.data) - start > limit:
            return at, depth, False
        if drop:
            g.drop(at)
            at = 0
        if not g.more():
            return at, depth, False


def elements(g: Growing, entry: Entry, end: int, first_field: str | None, max_bytes: int) -> Iterator[tuple[int, bytes, str | None]]:
    """Offset in the file, bytes and reason (or None) of the elements that start before ``end``, for a
    block that begins at ``g.base`` and is entered as ``entry`` says.

    Elements that are no object, or whose first key is another, are passed over. Longer ones than
    ``max_bytes`` are OVERSIZED_RECORD, whatever is in them; others that do not parse MALFORMED_JSON or
    INVALID_UTF8."""
    if entry.phase in (AFTER, NO_ARRAY):
        return
    at = 0
    if entry.phase == BEFORE:
        while (at := len(g.data) - len(g.data.lstrip(BLANK))) == len(g.data):
            if g.base + at >= end or not g.more():
                return
        if g.data[at : at + 1] != b"[":
            yield g.base + at, b"", "MALFORMED_JSON"
            return
        at += 1
    elif entry.depth > 1 or entry.lexer != OUT or g.last_before() not in (b"[", b","):
        # an element began before: to its end
        at, depth, found = skipped(g, at, entry.lexer, entry.depth, drop=True)
        if not found or depth == 0:
            return
        at += 1
    decode = json.JSONDecoder(object_pairs_hook=lambda pairs: [k for k, _ in pairs]).decode
    while True:
        while (c := g.data[at : at + 1]) in (b" ", b"\t", b"\r", b"\n", b",", b""):
            if c:
                at += 1
            elif g.base + at >= end or not g.more():
                return
        start = at
        if g.base + start >= end or c in (b"]", b"}"):
            return
        place = g.base + start
        stop, depth, found = skipped(g, start, OUT, 1, max_bytes + 1 if max_bytes else 0)
        raw = g.data[start : stop if found else None].rstrip(BLANK)
        over = bool(max_bytes) and len(raw) > max_bytes
        if not found:
            stop, depth, found = skipped(g, stop, OUT, depth, drop=over)
            raw = raw if over else g.data[start:stop].rstrip(BLANK) if found else g.data[start:].rstrip(BLANK)
        if over:
            yield place, b"", "OVERSIZED_RECORD"
        elif not utf8_ok(raw):
            yield place, b"", "INVALID_UTF8"
        else:
            try:
                keys = decode(raw.decode())
                if raw[:1] == b"{" and (first_field is None or (keys and keys[0] == first_field)):
                    yield place, raw, None
            except (json.JSONDecodeError, RecursionError):
                yield place, b"", "MALFORMED_JSON"
        if not found or depth == 0:
            return
        at = stop + 1
        if at > 4_000_000:
            g.drop(at)
            at = 0


FUNCTIONS = "path string, size long, version string, block long, start_byte long, end_byte long, first string, ends array<int>, moves array<long>, lows array<long>"
ENTRIES = "path string, size long, version string, block long, start_byte long, end_byte long, phase string, lexer int, depth long"
#: Rows are handed on so many at a time: a batch for each small block would take longer than the block.
ROWS = 10_000
RECORDS = "path string, file_size long, chunk_id string, byte_offset long, raw string, reason string"


def file_blocks(spark: SparkSession, path: str, target: int) -> DataFrame:
    """path, size, version, block (from 0), start_byte, end_byte: balanced ranges of about ``target``
    bytes of every file; empty files have none."""
    files = [(p.path, p.size, p.version) for p in listed(path) if p.size]
    cut = spark.createDataFrame(files, "path string, size long, version string").withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("size") / target)).cast("long"))
    rows = cut.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return rows.select("path", "size", "version", "block", F.expr("size * block div n").alias("start_byte"), F.expr("size * (block + 1) div n - 1").alias("end_byte"))


#: Small blocks of a file go together, so many bytes of them: a task opens their file once.
RUN_BYTES = 256 * 1024


def dealt(rows: DataFrame) -> DataFrame:
    """Blocks in as many partitions as the session has, a large file's apart, those of a run in order."""
    return rows.repartition("path", F.floor(F.col("start_byte") / RUN_BYTES)).sortWithinPartitions("path", "block")


def with_files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, BinaryIO]]:
    """The blocks, each with its file, which stays open while they are of the same."""
    rows = (r for batch in batches for r in batch.to_pylist())
    for file, blocks in groupby(rows, key=lambda r: Pinned(r["path"], r["size"], r["version"])):
        with opened(file) as f:
            for r in blocks:
                yield r, f


def block_functions(blocks: DataFrame) -> DataFrame:
    """The blocks with what each does to the lexer's state. A task holds one block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out = _arrow(FUNCTIONS), []
        for r, f in with_files(batches):
            f.seek(r["start_byte"])
            data = f.read(r["end_byte"] - r["start_byte"] + 1)
            ends, moves, lows = zip(*block_function(data), strict=True)
            out.append({**r, "first": first_character(data), "ends": ends, "moves": moves, "lows": lows})
            if len(out) == ROWS:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return dealt(blocks).mapInArrow(run, FUNCTIONS)


def entries(functions: DataFrame) -> DataFrame:
    """The state that each block is entered in: the functions before it, composed. Files are streamed
    in order within partitions, a task keeps one state; a block is one row, whatever its bytes."""
    rows = functions.repartition("path").sortWithinPartitions("path", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, now = None, Entry()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["path"] != path:
                    path, now = r["path"], Entry()
                out.append({**{k: r[k] for k in ("path", "size", "version", "block", "start_byte", "end_byte")}, "phase": now.phase, "lexer": now.lexer, "depth": now.depth})
                now = now.after(list(zip(r["ends"], r["moves"], r["lows"], strict=True)), r["first"])
            yield pa.RecordBatch.from_pylist(out, schema=_arrow(ENTRIES))

    return rows.mapInArrow(run, ENTRIES)


def json_records(spark: SparkSession, path: str, *, first_field: str | None = None, max_bytes: int = 0, target: int = 16 * 1024 * 1024) -> DataFrame:
    """path, file_size, chunk_id, byte_offset, raw and reason of the elements of the JSON arrays in the
    files of a folder or pattern, read in ranges of about ``target`` bytes.

    Exact for every tiling and any text. Files are read twice: once for the states, once for the
    elements; an element belongs to the range of its first byte, and its task reads on until it ends,
    or ``max_bytes`` on. A task holds a range and one element. A file that has changed since it was
    listed ends the read; one that holds no array gives one row, MALFORMED_JSON; an empty one none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, held = _arrow(RECORDS), [], 0
        for r, f in with_files(batches):
            entry, chunk = Entry(r["phase"], r["lexer"], r["depth"]), f"{r['block'] + 1:08d}"
            g = Growing(f, r["start_byte"], r["end_byte"] + 1, r["size"])
            for at, raw, reason in elements(g, entry, r["end_byte"] + 1, first_field, max_bytes):
                out.append({"path": r["path"], "file_size": r["size"], "chunk_id": chunk, "byte_offset": at, "raw": None if reason else raw.decode(), "reason": reason})
                held += len(raw)
                if held > 4_000_000 or len(out) == ROWS:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return dealt(entries(block_functions(file_blocks(spark, path, target)))).mapInArrow(run, RECORDS)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])
