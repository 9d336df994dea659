"""Framing: bytes to logical records with true byte offsets.

The framers are functions on bytes, shared by ``frame`` (contents in a column) and the framed file
source (ranges of large files). They look for terminators in whole arrays and hand Arrow the bytes
between them, so there is no loop over records for text.
"""

from __future__ import annotations

import json
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CR, LF = 13, 10
DEFAULT_SEPARATOR = "\x1c"
RECORD = "ordinal long, byte_offset long, raw string, reason string, terminated boolean"
RECORD_SCHEMA = pa.schema([("ordinal", pa.int64()), ("byte_offset", pa.int64()), ("raw", pa.string()), ("reason", pa.string()), ("terminated", pa.bool_())])


@dataclass
class Layout:
    """Fixed positions that mark the lines of multi-line records: (start byte, length, value)."""

    breaks: list[tuple[int, int, str]]
    includes: list[tuple[int, int, str]] = field(default_factory=list)
    ignores: list[tuple[int, int, str]] = field(default_factory=list)
    separator: str = DEFAULT_SEPARATOR


def line_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and the start of the next. CR, LF and CRLF each end one line."""
    _, starts, ends, after = lines_of(data, np.array([0, len(data)]))
    return starts, ends, after


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of contents that lie one after another: the content, start and end of every line, and where
    the next one starts. No line, and no CRLF, goes over the end of a content."""
    at = np.flatnonzero((data == LF) | (data == CR))
    owner = np.searchsorted(offsets, at, "right") - 1
    pair = np.zeros(len(at), bool)
    pair[:-1] = (data[at[:-1]] == CR) & (data[at[1:]] == LF) & (np.diff(at) == 1) & (np.diff(owner) == 0)
    first = ~np.concatenate([[False], pair])[: len(at)]
    at, owner, after = at[first], owner[first], (at + 1 + pair)[first]
    starts = np.concatenate([offsets[:-1], after])
    of = np.concatenate([np.arange(len(offsets) - 1), owner])
    some = starts < offsets[of + 1]
    starts, of = starts[some], of[some]
    order = np.argsort(starts, kind="stable")
    starts, of = starts[order], of[order]
    k = np.searchsorted(at, starts)
    ended = np.zeros(len(starts), bool)
    inside = k < len(at)
    ended[inside] = owner[k[inside]] == of[inside]
    ends, nexts = offsets[of + 1].copy(), offsets[of + 1].copy()
    ends[ended], nexts[ended] = at[k[ended]], after[k[ended]]
    return of, starts, ends, nexts


def utf8_ok(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


def text_records(data: bytes, first_ordinal: int = 0, base: int = 0, max_bytes: int = 0, strict_end: bool = False, at_end: bool = True) -> pa.RecordBatch:
    """Lines as records. Longer ones than ``max_bytes``, invalid UTF-8 and, if ``strict_end``, an
    unterminated last line keep their place with a reason and no content."""
    _, out = text_batch(data, np.array([0, len(data)]), max_bytes, strict_end and at_end)
    ordinal, offset = (pa.array(out.column(i).to_numpy() + x) for i, x in ((0, first_ordinal), (1, base)))
    return pa.RecordBatch.from_arrays([ordinal, offset, *out.columns[2:]], schema=RECORD_SCHEMA)


def text_batch(data: bytes, offsets: np.ndarray, max_bytes: int = 0, strict_end: bool = False) -> tuple[np.ndarray, pa.RecordBatch]:
    """The lines of all contents in one pass: the content of each, and the records, numbered and
    placed within their content."""
    array = np.frombuffer(data, np.uint8)
    of, starts, ends, after = lines_of(array, offsets)
    n = len(starts)
    sizes = ends - starts
    reasons = np.full(n, None, object)
    terminated = after > ends
    valid = np.ones(n, bool)
    if max_bytes:
        valid &= sizes <= max_bytes
        reasons[sizes > max_bytes] = "OVERSIZED_RECORD"
    # a character may be cut in two by the end of a content, and so look whole
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    if not utf8_ok(data) or (array[begin] & 0xC0 == 0x80).any():
        for i in np.flatnonzero(valid):
            if not utf8_ok(data[starts[i] : ends[i]]):
                valid[i], reasons[i] = False, "INVALID_UTF8"
    if strict_end:
        open_ = ~terminated
        valid[open_], reasons[open_] = False, "UNTERMINATED_RECORD"
    keep = np.repeat(valid, sizes)
    inside = np.zeros(len(array) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    text = array[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)][keep]
    places = np.concatenate([[0], np.cumsum(np.where(valid, sizes, 0))])
    raw = pa.LargeStringArray.from_buffers(n, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(text.tobytes()), None if valid.all() else pa.array(valid).buffers()[1]).cast(pa.string())
    ordinal = np.arange(n) - np.searchsorted(of, of)
    return of, pa.RecordBatch.from_arrays([pa.array(ordinal), pa.array(starts - offsets[of]), raw, pa.array(reasons, pa.string()), pa.array(terminated)], schema=RECORD_SCHEMA)


def matches(line: bytes, fields: list[tuple[int, int, str]]) -> bool:
    """All fields equal at their byte positions; a line that is too short, or no field, is no match."""
    return bool(fields) and all(line[s : s + n] == v.encode() and len(line) >= s + n for s, n, v in fields)


@dataclass
class Grouped:
    records: list[tuple[int, int, bytes]]  # line ordinal, offset, joined bytes
    headers: int
    trailers: int


def multiline_records(data: bytes, layout: Layout) -> Grouped:
    """Break starts a record, include appends to an open one, ignore and the rest are dropped and
    counted: before the first break as header, after it as trailer."""
    array = np.frombuffer(data, np.uint8)
    starts, ends, _ = line_bounds(array)
    out, open_, headers, trailers = [], None, 0, 0
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        line = data[a:b]
        if matches(line, layout.breaks):
            if open_:
                out.append(open_)
            open_ = (i, a, [line])
        elif open_ and matches(line, layout.includes):
            open_[2].append(line)
        elif open_:
            trailers += 1
        else:
            headers += 1
    if open_:
        out.append(open_)
    sep = layout.separator.encode()
    return Grouped([(i, a, sep.join(lines)) for i, a, lines in out], headers, trailers)


def json_elements(data: bytes, first_field: str | None, max_bytes: int = 0) -> Generator[tuple[int, bytes, str | None], None, int]:
    """Offset, bytes and reason (or None) of the elements of a top-level array.

    Elements that are no object, or whose first key is another, are passed over; what does not parse
    comes with a reason, and so does a document that is no array. Returns where it stopped."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        yield 0, b"", "INVALID_UTF8"
        return len(data)
    plain = len(text) == len(data)
    space = " \t\r\n"
    at, n = 0, len(text)
    while at < n and text[at] in space:
        at += 1
    if at == n:
        return len(data)
    if text[at] != "[":
        yield 0, b"", "MALFORMED_JSON"
        return len(data)
    at += 1
    offset_at = [0, 0]  # characters and bytes so far

    def offset(i: int) -> int:
        if plain:
            return i
        offset_at[1] += len(text[offset_at[0] : i].encode())
        offset_at[0] = i
        return offset_at[1]

    decode = json.JSONDecoder(object_pairs_hook=lambda pairs: [k for k, _ in pairs]).raw_decode
    while at < n:
        while at < n and text[at] in space + ",":
            at += 1
        if at >= n or text[at] == "]":
            return offset(at)
        start = at
        try:
            keys, at = decode(text, at)
            after = at
            while after < n and text[after] in space:
                after += 1
            if after < n and text[after] not in ",]":
                raise json.JSONDecodeError("", text, at)
            if text[start] != "{" or (first_field is not None and (not keys or keys[0] != first_field)):
                continue
            raw = text[start:at].encode()
            yield (offset(start), b"", "OVERSIZED_RECORD") if max_bytes and len(raw) > max_bytes else (offset(start), raw, None)
        except json.JSONDecodeError:
            at = resume(text, start)
            yield offset(start), b"", "MALFORMED_JSON"
    return len(data)


def resume(text: str, at: int) -> int:
    """The next comma or closing bracket outside strings at the array's own level, or the end.
    Brackets that close nothing, or close what another kind opened, are passed over."""
    opened: list[str] = []
    quoted, n = False, len(text)
    while at < n:
        c = text[at]
        if quoted:
            if c == "\\":
                at += 1
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
        elif c in "[{":
            opened.append("]" if c == "[" else "}")
        elif c in "]}":
            if opened and opened[-1] == c:
                opened.pop()
            elif not opened and c == "]":
                return at
        elif c == "," and not opened:
            return at
        at += 1
    return n


def framed(data: bytes, mode: str, *, layout: Layout | None = None, first_field: str | None = None, max_bytes: int = 0, strict_end: bool = False) -> pa.RecordBatch:
    """All records of a whole content."""
    if mode == "text":
        return text_records(data, max_bytes=max_bytes, strict_end=strict_end)
    if mode == "json":
        rows = list(json_elements(data, first_field, max_bytes))
        raw = [None if r else x.decode() for _, x, r in rows]
        return pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array(raw, pa.string()), pa.array([r[2] for r in rows], pa.string()), pa.array([True] * len(rows), pa.bool_())], schema=RECORD_SCHEMA)
    if mode == "multi-line" and layout:
        rows, out = multiline_records(data, layout).records, []
        for k, (_, at, raw) in enumerate(rows):
            reason = "OVERSIZED_RECORD" if max_bytes and len(raw) > max_bytes else None if utf8_ok(raw) else "INVALID_UTF8"
            out.append((k, at, None if reason else raw.decode(), reason, True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, RECORD_SCHEMA.types, strict=True)], schema=RECORD_SCHEMA)
    raise ValueError(f"no such mode: {mode}")


#: Contents are framed together up to so many bytes.
BATCH_BYTES = 8_000_000


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows up to about BATCH_BYTES of contents (the last column), one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(sizes) - 1) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):  # noqa: B905
        if b > a:
            yield batch.slice(a, b - a)


def frame(files: DataFrame, content: Column, keep: list[str], mode: str = "text", **options) -> DataFrame:
    """The columns of ``keep`` and ordinal, byte_offset, raw, reason, terminated of every record.

    A projection: contents are framed where they are, without a shuffle; lines of many contents in
    one pass. Null contents have none.
    """
    rows = files.select(*keep, content.cast("binary").alias("__content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data = part.column(part.num_columns - 1)
                if mode == "text":
                    whole = pc.fill_null(data, b"")
                    ends = np.cumsum(pc.binary_length(whole).to_numpy().astype(np.int64))
                    which, out = text_batch(b"".join(whole.to_pylist()), np.concatenate([[0], ends]), options.get("max_bytes", 0), options.get("strict_end", False))
                    found = [(which, out)]
                else:
                    found = ((np.full(out.num_rows, i), out) for i, x in enumerate(data.to_pylist()) if x for out in [framed(x, mode, **options)])
                for which, out in found:
                    yield pa.RecordBatch.from_arrays([*[c.take(pa.array(which)) for c in part.columns[:-1]], *out.columns], names=[*keep, *RECORD_SCHEMA.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}, {RECORD}")


def frame_lines(files: DataFrame, content: Column, keep: list[str]) -> DataFrame:
    """Lines and their ordinals with Spark's own functions, where offsets aren't asked for."""
    lines = F.filter(F.regexp_extract_all(content, F.lit("[^\\r\\n]*(?:\\r\\n|\\r|\\n)|[^\\r\\n]+"), F.lit(0)), lambda x: x != "")
    rows = files.select(*keep, F.posexplode(lines).alias("ordinal", "line"))
    return rows.select(*keep, F.col("ordinal").cast("long"), F.regexp_replace("line", "[\\r\\n]+$", "").alias("raw"))


def owned(records: DataFrame, start: Column, end: Column, padding: Column | int = 0) -> DataFrame:
    """Records whose first byte lies in the range that a chunk owns."""
    pad = padding if isinstance(padding, Column) else F.lit(padding)
    return records.where(F.col("byte_offset").between(start, end - pad))


def match_at(line: Column, fields: list[tuple[int, int, str]]) -> Column:
    """``matches`` as an expression on bytes."""
    data, out = F.encode(line, "UTF-8"), F.lit(bool(fields))
    for start, n, value in fields:
        out = out & (F.octet_length(line) >= start + n) & (F.substring(data, start + 1, n) == F.encode(F.lit(value), "UTF-8"))
    return out
