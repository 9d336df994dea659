"""Removal of strings of a given length that occur more than once in a corpus, by suffix arrays.

A rule names the symbols, bytes or words, and how many make a string. Every window of that many
symbols picks one anchor: the k-gram in it with the least hash. Equal windows pick equal anchors at
the same distance, so what repeats meets under the anchor's hash. The windows of one anchor are
neighbours and form a context, the symbols that they cover.

* Contexts that occur twice as a whole repeat in all their windows: the anchor's hash and a digest,
  128 bits together, tell.
* Different contexts with the same anchor are cut to what they share around it; what does not lie
  in another is laid one after another and sorted by suffix; windows that are equal stand side by
  side in the suffix array and are compared symbol by symbol.
* Should very many different contexts share an anchor, their windows are told apart by 128-bit
  digests instead, dealt to buckets, so no group is ever in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import arrow_map, set_aside, small, text_of, written
from recordmill.llm.suffix_array import suffix_array

#: Symbols of an anchor.
ANCHOR = {"bytes": 64, "words": 8}
#: An anchor with more different contexts is not sorted in one task.
MOST_CONTEXTS = 1000
#: Texts are looked through in pieces of so many symbols.
SEGMENT = 3_000_000
#: Windows of hot anchors that one task tells apart, on average.
BUCKET_WINDOWS = 500_000
_BASE = 0x9E3779B97F4A7C15 | 1
_table = np.random.default_rng(20240608).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_gap = re.compile(rb"[\x20\x09-\x0D]")
_is_gap = np.zeros(256, bool)
_is_gap[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Rule:
    """Strings of ``length`` symbols. Words are runs of other than ASCII white space; what stands
    between two words is not compared."""

    length: int
    unit: str = "bytes"

    def __post_init__(self) -> None:
        if self.unit not in ANCHOR or self.length < ANCHOR[self.unit]:
            raise ValueError(f"{self}: unit must be one of {list(ANCHOR)}, length at least {ANCHOR}")


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2^64, kept for the longest text so far."""
    if not _powers or len(_powers[0][0]) < n:
        out = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[0] = tuple(out)
    return _powers[0][0][:n], _powers[0][1][:n]


def sums(values: np.ndarray) -> np.ndarray:
    """Running sums of the symbols times the powers of the base: what a hash of any stretch is made of."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(len(values))[0], dtype=np.uint64)])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k symbols."""
    total = sums(values)
    return mixed((total[k:] - total[:-k]) * powers(len(values))[1][: len(values) - k + 1])


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word, looked for in pieces that end at white space."""
    found, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))], 0
    while at < len(text):
        gap = _gap.search(text, at + SEGMENT)
        end = gap.start() if gap else len(text)
        data = np.frombuffer(text, np.uint8, end - at, at)
        out = np.concatenate([[True], _is_gap[data], [True]])
        edge = np.flatnonzero(out[1:] != out[:-1])
        a, b = edge[::2], edge[1::2]
        total = sums(_table[data])
        found.append((a + at, b + at, mixed((total[b] - total[a]) * powers(len(data))[1][a])))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def symbols(text: bytes, rule: Rule) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """The text in pieces such that each window is in one: first symbol, the symbols' hashes, and
    bytes that are equal for equal symbols, as many for each."""
    hashes = words_of(text)[2] if rule.unit == "words" else None
    for at in range(0, max(1, (len(text) if hashes is None else len(hashes)) - rule.length + 1), SEGMENT):
        end = at + SEGMENT + rule.length - 1
        if hashes is None:
            yield at, _table[np.frombuffer(text[at:end], np.uint8)], text[at:end]
        else:
            yield at, hashes[at:end], hashes[at:end].tobytes()


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i : i + w]) of every i that has w values."""
    n = -(-len(x) // w) * w
    y = np.concatenate([x, np.full(n - len(x), np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(y, 1).reshape(-1)
    behind = np.minimum.accumulate(y[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: len(x) - w + 1], ahead[w - 1 : len(x)])


def contexts(parts: list[np.ndarray], rule: Rule) -> tuple[np.ndarray, ...]:
    """Part, first and last window start, the anchor's place after the first, and its hash, for each run of windows with one anchor."""
    length, k = rule.length, ANCHOR[rule.unit]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    values = np.concatenate([*parts, np.zeros(0, np.uint64)])
    none = np.zeros(0, np.int64)
    if len(values) < length:
        return none, none, none, none, none
    h = gram_hashes(values, k)
    # the least hash, of equal ones the last: both follow from the window's symbols alone
    key = (h >> np.uint64(32) << np.uint64(32)) | (np.uint64(2**32 - 1) - np.arange(len(h), dtype=np.uint64))
    least = sliding_min(key, length - k + 1)
    begin = np.cumsum(sizes) - sizes
    part = np.repeat(np.arange(len(parts)), sizes)[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + length <= (begin + sizes)[part])
    if not len(at):
        return none, none, none, none, none
    pick, part = least[at], part[at]
    new = np.flatnonzero(np.diff(pick, prepend=pick[:1] + np.uint64(1)).astype(bool) | np.diff(part, prepend=-1).astype(bool))
    last = np.append(new[1:], len(at)) - 1
    anchor = (np.uint64(2**32 - 1) - (pick[new] & np.uint64(2**32 - 1))).astype(np.int64)
    return part[new], at[new] - begin[part[new]], at[last] - begin[part[new]], anchor - at[new], h[anchor].view(np.int64)


def find_contexts(rules: Sequence[Rule]):
    """Rows uid, text -> the contexts of the text, in segments of bounded size, however long it is."""

    def grouped(texts: list[bytes], rule: Rule) -> Iterator[list[tuple[int, int, np.ndarray, bytes]]]:
        out, size = [], 0
        for i, text in enumerate(texts):
            for at, values, raw in symbols(text, rule):
                if out and size + len(values) > SEGMENT:
                    yield out
                    out, size = [], 0
                out.append((i, at, values, raw))
                size += len(values)
        if out:
            yield out

    def make():
        def step(batch: pa.RecordBatch) -> pa.Table:
            parts = [[np.zeros(0, np.int64)] * 7]
            texts = [unzip(t) for t in batch.column(1).to_pylist()]
            for number, rule in enumerate(rules):
                for pieces in grouped(texts, rule):
                    part, first, last, anchor, gram = contexts([p[2] for p in pieces], rule)
                    wide = 8 if rule.unit == "words" else 1
                    raw = [memoryview(p[3]) for p in pieces]
                    digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[t][a * wide : b * wide]) for t, a, b in zip(part.tolist(), first.tolist(), (last + rule.length).tolist(), strict=True)), np.uint64, len(part))
                    row, at = np.array([p[0] for p in pieces], np.int64)[part], np.array([p[1] for p in pieces], np.int64)[part]
                    parts.append([np.full(len(row), number), row, first + at, last + at, anchor, gram, digest.view(np.int64)])
            number, row, first, last, anchor, gram, digest = (np.concatenate(c) for c in zip(*parts, strict=True))
            return pa.table({"uid": batch.column(0).take(pa.array(row)), "rule": pa.array(number.astype(np.int8)), "first": pa.array(first), "last": pa.array(last), "anchor": pa.array(anchor.astype(np.int32)), "gram": pa.array(gram), "digest": pa.array(digest)})

        return step

    return make


def common(a: Sequence, b: Sequence) -> int:
    """How many first symbols are equal."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def most_in_common(parts: list[Sequence]) -> list[int]:
    """The longest beginning that each shares with another."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for a, b in zip(order, order[1:]):  # noqa: B905
        n = common(parts[a], parts[b])
        out[a], out[b] = max(out[a], n), max(out[b], n)
    return out


def repeated_windows(parts: list[Sequence], anchors: list[int], length: int) -> list[np.ndarray]:
    """For different contexts with one anchor: which of the windows of each also occur elsewhere in them.

    Equal windows have the anchor at the same place, so symbols that no other context has on that
    side of the anchor are in none, and no window occurs twice in one context. What is left of a
    context after cutting these off is a stretch. One that several contexts have, or that lies in
    another at the same place, repeats as a whole; the others are sorted by suffix."""
    right = most_in_common([p[a:] for p, a in zip(parts, anchors, strict=True)])
    left = most_in_common([p[:a][::-1] for p, a in zip(parts, anchors, strict=True)])
    out = [np.zeros(len(p) - length + 1, bool) for p in parts]
    stretches: dict[Sequence, list[int]] = {}
    for i, (p, a) in enumerate(zip(parts, anchors, strict=True)):
        if left[i] + right[i] >= length:
            stretches.setdefault(p[a - left[i] : a + right[i]], []).append(i)
    again = {x: np.full(len(x) - length + 1, len(members) > 1) for x, members in stretches.items()}
    outer: list[tuple[Sequence, int]] = []
    for x in sorted(stretches, key=len, reverse=True):
        at = left[stretches[x][0]]
        for y, place in outer:
            if place >= at and y[place - at : place - at + len(x)] == x:
                again[x][:] = True
                again[y][place - at : place - at + len(again[x])] = True
                break
        else:
            outer.append((x, at))
    if len(outer) > 1:
        ids = {c: i + 2 for i, c in enumerate(dict.fromkeys(c for x, _ in outer for c in x))}
        text = [n for x, _ in outer for n in (*map(ids.__getitem__, x), 1)]
        begin = np.cumsum([0, *(len(x) + 1 for x, _ in outer)]).tolist()
        data, starts = np.array(text, np.int32), np.zeros(len(text), bool)
        for b, (x, _) in zip(begin, outer):  # noqa: B905
            starts[b : b + len(again[x])] = True
        order = np.array(suffix_array([*text, 0]))[1:]
        order = order[starts[order]]
        view, equal = np.lib.stride_tricks.sliding_window_view(data, length), np.zeros(len(order), bool)
        for k in range(0, len(order) - 1, 4096):
            a, b = order[k : k + 4096], order[k + 1 : k + 4097]
            equal[k + 1 : k + 1 + len(b)] = (view[a[: len(b)]] == view[b]).all(1)
        twice = np.zeros(len(data), bool)
        twice[order[equal | np.append(equal[1:], False)]] = True
        for b, (x, _) in zip(begin, outer):  # noqa: B905
            again[x] |= twice[b : b + len(again[x])]
    for x, members in stretches.items():
        for i in members:
            out[i][anchors[i] - left[i] : anchors[i] - left[i] + len(again[x])] = again[x]
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of every run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


RUN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
KEY = ["rule", "gram", "digest"]
FOUND = "rule byte, gram long, digest long, runs array<struct<first:int,last:int>>"


def found_rows(keys: list[tuple[int, int, int]], found: list[list[tuple[int, int]]]) -> pa.Table:
    return pa.table({"rule": pa.array([k[0] for k in keys], pa.int8()), "gram": pa.array([k[1] for k in keys], pa.int64()), "digest": pa.array([k[2] for k in keys], pa.int64()), "runs": pa.array([[{"first": a, "last": b} for a, b in x] for x in found], RUN)})


def symbols_of(cut: bytes, rule: Rule) -> Sequence:
    return tuple(cut.split()) if rule.unit == "words" else cut


def sort_contexts(rules: Sequence[Rule]):
    """Rows rule, gram, digest, anchor, bytes in order of rule and gram -> runs of repeated windows of each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            rule = rules[rows[0][0]]
            again = repeated_windows([symbols_of(r[4], rule) for r in rows], [r[3] for r in rows], rule.length)
            yield from found_rows([r[:3] for r in rows], [runs(x) for x in again]).to_batches()

        for batch in batches:
            for part in small(batch):
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if rows and rows[0][:2] != row[:2]:
                        yield from flush()
                        rows = []
                    rows.append(row)
        if rows:
            yield from flush()

    return run


def windows_of(cuts: list[bytes], rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests of all windows of the contexts, and how many each context has."""
    parts = [symbols_of(c, rule) for c in cuts]
    piece = (lambda p, i: b" ".join(p[i : i + rule.length])) if rule.unit == "words" else (lambda p, i: p[i : i + rule.length])
    digests = [xxhash.xxh3_128_digest(piece(p, i)) for p in (parts if rule.unit == "words" else map(memoryview, parts)) for i in range(len(p) - rule.length + 1)]
    return np.frombuffer(b"".join(digests), [("a", np.uint64), ("b", np.uint64)]), np.array([len(p) - rule.length + 1 for p in parts])


def by_digest(hot: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same for anchors with very many contexts. hot: rule, gram, digest, n (windows), bytes, part
    (a bounded share of the contexts of a gram). A part sends its distinct windows, packed, to
    buckets of their digests, and gets back which of them occur twice. There are as many buckets as
    the windows need."""
    hot = written(hot, "hot-contexts")
    buckets = int(hot.agg(F.ceil(F.sum("n") / BUCKET_WINDOWS)).first()[0])

    def keyed(group: pa.Table):
        group = group.sort_by([("digest", "ascending")])
        keys, sizes = windows_of(group["bytes"].to_pylist(), rules[group["rule"][0].as_py()])
        some, at, n = np.unique(keys, return_inverse=True, return_counts=True)
        return group, sizes, some, at, np.where(n > 1, 2, 1), (some["a"] % np.uint64(buckets)).astype(np.int64)

    def send(group: pa.Table) -> pa.Table:
        group, _, some, _, n, bucket = keyed(group)
        used = np.unique(bucket)
        same = {k: pa.array([group[k][0].as_py()] * len(used), kind) for k, kind in (("rule", pa.int8()), ("gram", pa.int64()), ("part", pa.int64()))}
        return pa.table({"bucket": pa.array(used, pa.int64())} | same | {"keys": pa.array([some[bucket == b].tobytes() for b in used], pa.binary()), "n": pa.array([n[bucket == b].astype(np.uint8).tobytes() for b in used], pa.binary())})

    def meet(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, [("a", np.uint64), ("b", np.uint64)]) for x in group["keys"].to_pylist()]
        some, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(at, np.concatenate([np.frombuffer(x, np.uint8) for x in group["n"].to_pylist()]), len(some))
        cuts = np.cumsum([len(x) for x in keys])[:-1]
        return pa.table({k: group[k] for k in ("bucket", "rule", "gram", "part")} | {"again": pa.array([x.tobytes() for x in np.split(n[at] > 1, cuts)], pa.binary())})

    def give(group: pa.Table, answers: pa.Table) -> pa.Table:
        group, sizes, some, at, _, bucket = keyed(group)
        again = np.zeros(len(some), bool)
        for b, x in zip(answers["bucket"].to_pylist(), answers["again"].to_pylist(), strict=True):
            again[bucket == b] = np.frombuffer(x, bool)
        keys = list(zip(*(group[k].to_pylist() for k in KEY), strict=True))
        return found_rows(keys, [runs(x) for x in np.split(again[at], np.cumsum(sizes)[:-1])])

    sent = hot.groupBy("rule", "gram", "part").applyInArrow(send, "bucket long, rule byte, gram long, part long, keys binary, n binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "bucket long, rule byte, gram long, part long, again binary")
    return hot.groupBy("rule", "gram", "part").cogroup(met.groupBy("rule", "gram", "part")).applyInArrow(give, FOUND)


def cut_contexts(rules: Sequence[Rule]):
    """Rows wanted (list of contexts), text -> rule, gram, digest, contexts of the gram, windows, bytes."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.Table:
            out: dict[str, list] = {k: [] for k in ("rule", "gram", "digest", "c", "anchor", "n", "bytes")}
            for wanted, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = unzip(text)
                words = words_of(data) if any(rules[w["rule"]].unit == "words" for w in wanted) else None
                for w in wanted:
                    rule = rules[w["rule"]]
                    a, b = w["first"], w["last"] + rule.length
                    for k in ("rule", "gram", "digest", "c", "anchor"):
                        out[k].append(w[k])
                    out["n"].append(w["last"] - a + 1)
                    out["bytes"].append(data[a:b] if rule.unit == "bytes" else data[words[0][a] : words[1][b - 1]])
            return pa.table(out, schema=pa.schema([("rule", pa.int8())] + [(k, pa.int64()) for k in ("gram", "digest", "c", "anchor", "n")] + [("bytes", pa.binary())]))

        return step

    return make


def unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def zipped():
    """Replaces the last column, a text, by its compressed bytes: texts are shuffled twice."""

    def make():
        press = zstandard.ZstdCompressor(level=3)

        def step(batch: pa.RecordBatch) -> pa.Table:
            t = pa.Table.from_batches([batch])
            return t.drop_columns([t.column_names[-1]]).append_column("__text", pa.array([press.compress(x.encode()) for x in t.column(t.num_columns - 1).to_pylist()], pa.binary()))

        return step

    return make


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs [start, end) that the spans cover."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame, rules: Sequence[Rule], *, keep: tuple[str | Column, ...] = ("doc_id",), text_col: str = "text", most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """The columns of ``keep``, then __text and __spans: for each row of ``docs`` its text (null as
    empty), as compressed bytes, and the ranges (rule, start, end, in the rule's symbols; may
    overlap; null if none) that strings of a rule's length cover which start at another place too,
    in this text or any other."""
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("__uid"), text_of(text_col).alias("__text"))
    names = rows.columns[:-2]
    texts = written(arrow_map(rows, zipped(), "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1]) + "__text binary"), "texts")
    slim = texts.select(F.col("__uid").alias("uid"), F.col("__text").alias("text"))
    all_ = written(arrow_map(slim, find_contexts(rules), "uid long, rule byte, first long, last long, anchor int, gram long, digest long"), "contexts")
    # most anchors occur once; what has none that comes again is done with
    again = written(all_.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "repeated-anchors")
    all_ = written(all_.join(again.hint("merge"), "gram", "left_semi"), "contexts-that-meet")
    # tables, so that their join may split an anchor with very many different contexts
    different = written(all_.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("uid").alias("uid"), F.first("first").alias("first"), F.first("last").alias("last"), F.first("anchor").alias("anchor")), "different-contexts")
    shared = different.groupBy("rule", "gram").agg(F.count("*").alias("c"), F.min("n").alias("least")).where("c > 1 and least = 1").select("rule", "gram", "c")
    shared = written(shared, "shared-anchors")
    some = written(different.join(shared, ["rule", "gram"], "left").where("n > 1 or c is not null"), "shared-contexts")
    wanted = some.where("c is not null").groupBy("uid").agg(F.collect_list(F.struct(*KEY, "c", "first", "last", "anchor")).alias("wanted"))
    cut = arrow_map(wanted.join(slim, "uid").select("wanted", "text"), cut_contexts(rules), "rule byte, gram long, digest long, c long, anchor long, n long, bytes binary")
    usual = cut.where(F.col("c") <= most_contexts).select(*KEY, "anchor", "bytes").repartition("rule", "gram").sortWithinPartitions("rule", "gram")
    found = usual.mapInArrow(sort_contexts(rules), FOUND)
    if not some.where(F.col("c") > most_contexts).isEmpty():
        hot = cut.where(F.col("c") > most_contexts).select(*KEY, "n", "bytes", F.pmod("digest", F.ceil(F.col("c") / most_contexts)).alias("part"))
        found = found.union(by_digest(hot, rules))
    whole = some.where("n > 1").select(*KEY, F.array(F.struct(F.lit(0).alias("first"), (F.col("last") - F.col("first")).cast("int").alias("last"))).alias("runs"))
    parts = found.where(F.size("runs") > 0).join(some.where("n = 1").select(*KEY), KEY)
    known = written(whole.union(parts.select(*KEY, "runs")), "repeated")
    length = F.element_at(F.array(*[F.lit(r.length) for r in rules]), F.col("rule") + 1)
    spans = all_.select("uid", "first", *KEY).join(known.select(*KEY, F.explode("runs").alias("run")), KEY).select("uid", "rule", (F.col("first") + F.col("run.first")).alias("start"), (F.col("first") + F.col("run.last") + length).alias("end"))
    of_text = spans.groupBy("uid").agg(F.collect_list(F.struct("rule", "start", "end")).alias("__spans"))
    return texts.join(of_text.withColumnRenamed("uid", "__uid"), "__uid", "left").select(*[F.col(f"`{c}`") for c in names], "__text", "__spans")


RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "clean_text", "spans", "n_passages", "n_passage_words")


def remove_repeats(docs: DataFrame, *, rule: Rule = Rule(400), passages: Rule | None = None, keep: tuple[str | Column, ...] = ("doc_id",), text_col: str = "text", most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """The columns of ``keep``, then n_bytes, n_removed, n_spans, kept_sha256, clean_text, spans,
    n_passages and n_passage_words.

    spans: maximal removed byte ranges (start, end). kept_sha256: of the remaining bytes, which may
    cut a character in two; clean_text leaves such halves out. n_passages, n_passage_words: how many
    runs of words repeat under the rule ``passages``, which removes nothing, and their words; null
    without such a rule. Null texts are empty, texts shorter than the rule's length stay whole,
    repeated rows remove each other's text, ids may be null or repeat, an empty table gives no row,
    other columns are ignored. A kept column named like a result comes back as input_<name>.
    """
    if passages and passages.unit != "words":
        raise ValueError("passages are told in words")
    aside, back = set_aside(docs, keep, RESULTS)
    source = repeated_spans(docs, [rule, *([passages] if passages else [])], keep=aside, text_col=text_col, most_contexts=most_contexts)

    def make():
        def step(batch: pa.RecordBatch) -> pa.Table:
            out: dict[str, list] = {k: [] for k in RESULTS}
            n = batch.num_columns
            for text, spans in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist(), strict=True):
                data = unzip(text)
                gone = merged([(s["start"], s["end"]) for s in spans or [] if s["rule"] == 0])
                if gone and rule.unit == "words":
                    start, end, _ = words_of(data)
                    gone = [(int(start[a]), int(end[b - 1])) for a, b in gone]
                found = merged([(s["start"], s["end"]) for s in spans or [] if s["rule"] == 1])
                rest, at = [], 0
                for a, b in gone:
                    rest.append(data[at:a])
                    at = b
                left = b"".join([*rest, data[at:]])
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(left))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["clean_text"].append(data.decode() if not gone else "".join(x.decode("utf-8", "ignore") for x in [*rest, data[at:]]))
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
                out["n_passages"].append(len(found) if passages else None)
                out["n_passage_words"].append(sum(b - a for a, b in found) if passages else None)
            t = pa.Table.from_batches([batch]).drop_columns(["__text", "__spans"])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = {"kept_sha256": pa.string(), "clean_text": pa.string(), "spans": span}
            for k in RESULTS:
                t = t.append_column(k, pa.array(out[k], kinds.get(k, pa.int64())))
            return t

        return step

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-2])
    kinds = {"kept_sha256": "string", "clean_text": "string", "spans": "array<struct<start:bigint,end:bigint>>"}
    return back(arrow_map(source, make, fields + ", ".join(f"{k} {kinds.get(k, 'long')}" for k in RESULTS)))


#: The query's rows: windows of 400 bytes and of 50 words by their digests, and the runs that they cover.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), bytes AS (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM (SELECT r, i, md5(array_slice(b, i, i + 399)) AS h FROM (SELECT r, b, unnest(generate_series(1, octet_length(b) - 399)) AS i FROM d WHERE octet_length(b) >= 400))
), words AS (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM (SELECT r, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT r, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50))
), runs AS (
  SELECT r, min(i) AS a, max(i) + 400 AS z FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM bytes WHERE n > 1)) GROUP BY r, g
), passages AS (
  SELECT r, min(i) AS a, max(i) + 50 AS z FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM words WHERE n > 1)) GROUP BY r, g
), before AS (SELECT r, a, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS p, z FROM runs
), gone AS (SELECT d.r, sum(z - a) AS n_removed, count(*) AS n_spans, string_agg(hex(array_slice(b, p, a - 1)), '' ORDER BY a) || hex(any_value(array_slice(b, last, octet_length(b)))) AS kept
  FROM before JOIN d USING (r) JOIN (SELECT r, max(z) AS last FROM runs GROUP BY r) USING (r) GROUP BY d.r
), found AS (SELECT r, count(*) AS n_passages, sum(z - a) AS n_passage_words FROM passages GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, CASE WHEN kept IS NULL THEN sha256(b) ELSE sha256(unhex(kept)) END AS kept_sha256,
  CAST(coalesce(n_passages, 0) AS BIGINT) AS n_passages, CAST(coalesce(n_passage_words, 0) AS BIGINT) AS n_passage_words
FROM d LEFT JOIN gone USING (r) LEFT JOIN found USING (r)
"""
