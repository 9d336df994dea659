"""Best-fit packing of documents into sequences after dominance reduction.

Lengths are whole numbers up to the capacity, so the packing problem is a histogram of at most
``capacity`` rows however large the corpus is. The driver solves that histogram: pairs that
dominate every other way to place their larger member are fixed for good, and best-fit decreasing
packs the rest, whole runs of equal bins at a time. The answer is a list of patterns; Spark deals
the pieces of each length to the places that the patterns have for it, by their rank.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm.bpe import WORD_LEVEL, Cache, PrefixEncoder, Vocabulary
from recordmill.llm.common import arrow_map, quoted, text_of, written

#: Python's split() cuts at these, the tokenizer's pattern keeps them as text.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORD_LINES = regex.compile(f"\n|{WORD_LEVEL.pattern}")


class WordEncoder:
    """Ids as the tokenizers library gives them for a file whose pre-tokenizer drops white space and
    lower-cases: a text is then the concatenation of its words, and each is encoded once while
    cached. Words with a special string in them go to the library itself."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        self.tk.no_padding()
        self.tk.no_truncation()
        vocabulary = Vocabulary(path)
        self.special = re.compile("|".join(map(re.escape, vocabulary.special)) or "(?!)")
        self.encoder = PrefixEncoder(vocabulary)
        self.parts = Cache(self.encode_parts, 300_000)
        self.words = Cache(self.encode_words)

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, x in enumerate(parts) if self.special.search(x)] if self.special.search("\n".join(parts)) else []
        ids, sizes = self.encoder.encode([b"" if x == "\n" else x.encode() for x in parts] if not odd else [b"" if x == "\n" or self.special.search(x) else x.encode() for x in parts])
        for i in odd:
            own = self.tk.encode(parts[i], add_special_tokens=False).ids
            ids = np.insert(ids, int(sizes[:i].sum()), own)
            sizes[i] = len(own)
        return ids, sizes

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the library lower-cases each character alone, so a capital sigma never becomes a final one
        text = "\n".join(words)
        if not self.special.search(text) and not SEPARATORS.search(text):
            # all words at once, a line each; the ends of lines are parts without ids
            parts = WORD_LINES.findall(normalize("NFC", text).replace("\u03a3", "\u03c3").lower() + "\n")
            ids, sizes = self.parts.ids(parts)
            ends = np.cumsum(sizes)[[i for i, x in enumerate(parts) if x == "\n"]]
            return ids, np.diff(ends, prepend=0)
        return self.parts.of_lists([[x] if self.special.search(x) else WORD_LEVEL.findall(normalize("NFC", x).replace("\u03a3", "\u03c3").lower()) for x in words])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.words.of_lists([[x] if SEPARATORS.search(x) else x.split() for x in texts])


_encoders: dict[str, WordEncoder] = {}


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id, piece, start, length, ids_crc32: documents with their end token, cut to capacity."""

    def make():
        if tokenizer not in _encoders:
            _encoders[tokenizer] = WordEncoder(tokenizer)
        enc = _encoders[tokenizer]

        def step(batch: pa.RecordBatch) -> pa.Table:
            ids, sizes = enc.encode(batch.column(2).to_pylist())
            ids, ends = ids.astype("<u4"), np.cumsum(sizes)
            which, piece, start, length, crc = [], [], [], [], []
            tail = np.array([end_id], "<u4").tobytes()
            for i, (a, n) in enumerate(zip((ends - sizes).tolist(), sizes.tolist(), strict=True)):
                data = ids[a : a + n].tobytes() + tail
                for k, s in enumerate(range(0, n + 1, capacity)):
                    which.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(min(capacity, n + 1 - s))
                    crc.append(zlib.crc32(data[4 * s : 4 * (s + capacity)]))
            at = pa.array(which, pa.int64())
            return pa.table({"row": batch.column(0).take(at), "doc_id": batch.column(1).take(at), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

        return step

    rows = docs.select(F.monotonically_increasing_id().alias("row"), quoted(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return arrow_map(rows, make, f"row long, doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


@dataclass
class Pattern:
    """``bins`` sequences that hold these lengths, in this order."""

    lengths: list[int]
    bins: int


def shortest(left: dict[int, int], sizes: list[int], j: int) -> list[int]:
    """The three shortest, or all if they are fewer, beside one ``j``."""
    out: list[int] = []
    for x in sizes:
        out += [x] * min(3 - len(out), left[x] - (x == j))
        if len(out) == 3:
            break
    return out


def longest_pair(left: dict[int, int], sizes: list[int], j: int, room: int) -> tuple[int, int]:
    """Of the pairs beside one ``j`` that fit in the room the longest, and of those that are as long
    the one with the longest member; that member first. (0, 0) if none fits."""
    best, low = (0, 0), 0
    for x in reversed(sizes[: bisect_left(sizes, room + 1)]):
        n = left[x] - (x == j)
        while low < len(sizes) and sizes[low] <= room - x:
            low += 1
        at = low - 1  # the longest that fits beside x
        if at >= 0 and sizes[at] >= x:
            at = bisect_left(sizes, x) - (n < 2)
        if at >= 0 and sizes[at] == j != x and left[j] == 1:
            at -= 1
        if n and at >= 0 and x + sizes[at] > sum(best):
            best = (x, sizes[at])
    return best


def fits_above(left: dict[int, int], sizes: list[int], j: int, least: int, room: int) -> bool:
    """Two that are both longer than ``least`` fit in the room beside one ``j``."""
    two = shortest(left, sizes[bisect_left(sizes, least + 1) :], j)[:2]
    return len(two) == 2 and sum(two) <= room


def dominant_sets(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fixes, from the largest length down, sets that dominate every set with that length:
    the length alone if nothing fits beside it; with the complement that fills the sequence; or
    with the largest that fits beside it, if no two (hence no more) of the rest fit together there,
    or no three do and the longest two that do are no longer than it; with the longest two, if no
    three fit, one of them is the largest and no two longer than the other fit. The rest is the
    reduced instance."""
    left = {k: n for k, n in counts.items() if n > 0}
    sizes = sorted(left)
    fixed: list[Pattern] = []

    def take(lengths: list[int], n: int) -> None:
        fixed.append(Pattern(lengths, n))
        for x in set(lengths):
            left[x] -= n * lengths.count(x)
            if not left[x]:
                del left[x]
                sizes.pop(bisect_left(sizes, x))

    for j in sorted(left, reverse=True):
        while j in left:
            room = capacity - j
            if sizes[0] > room:
                take([j], left[j])
                continue
            k = sizes[bisect_left(sizes, room + 1) - 1]
            if k == j and left[j] == 1:  # beside itself there is no second one
                below = bisect_left(sizes, j) - 1
                if below < 0:
                    take([j], 1)
                    continue
                k = sizes[below]
            few = shortest(left, sizes, j)
            if k == room or len(few) < 2 or few[0] + few[1] > room:
                take([j, k], left[j] // 2 if k == j else min(left[j], left[k]))
                continue
            if len(few) > 2 and sum(few) <= room:
                break  # three fit: not fixed
            x, y = longest_pair(left, sizes, j, room)
            if x + y <= k:
                take([j, k], left[j] // 2 if k == j else min(left[j], left[k]))
                continue
            if x == k and not fits_above(left, sizes, j, y, room):
                take([j, x, y], min(left[z] // [j, x, y].count(z) for z in (j, x, y)))
                continue
            break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing: each length goes to the fullest bin that has room. Bins that are alike
    are kept as one entry, so the work follows the number of different lengths."""
    bins: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # room -> (nested lengths, bins)
    rooms: list[int] = []
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                full, rest = divmod(left, each)
                made = [(each, full)] * bool(full) + [(rest, 1)] * bool(rest)
                left, parent = 0, ()
            else:
                room = rooms[at]
                each, (parent, n) = room // size, bins[room].pop()
                full, rest = divmod(left, each)
                used = min(n, full)
                made, left = [(each, used)] * bool(used), left - each * used
                if used < n and left:  # less than a bin takes is left
                    made.append((left, 1))
                    used, left = used + 1, 0
                if used < n:
                    bins[room].append((parent, n - used))
                if not bins[room]:
                    del bins[room]
                    rooms.pop(at)
            for items, n in made:
                to = (capacity if parent == () else room) - items * size
                if to not in bins:
                    insort(rooms, to)
                bins[to].append(((parent, size, items), n))
    out = []
    for entries in bins.values():
        for node, n in entries:
            lengths: list[int] = []
            while node:
                node, size, items = node
                lengths[:0] = [size] * items
            out.append(Pattern(lengths, n))
    return out


def solve(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, rest = dominant_sets(counts, capacity)
    return fixed + best_fit(rest, capacity)


def places(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of each run of its places."""
    runs, base = defaultdict(list), 0
    for p in patterns:
        at = 0
        for x in p.lengths:
            runs[x].append((p.bins, base, at))
            at += x
        base += p.bins
    out = {}
    for x, rows in runs.items():
        n, seq, at = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        out[x] = (np.cumsum(n) - n, seq, at)
    return out


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, row.

    ``row`` tells documents with the same doc_id apart. A null or empty text is the end token
    alone; a document longer than ``capacity`` is cut into full pieces and a rest; ties between
    pieces of the same length are broken by (row, piece); an empty table gives no row; other
    columns are ignored. What the driver gets is one count per length: ``capacity`` rows at most.
    """
    # ranks within a length in two steps, so that a length which a third of the pieces have is not one
    # group; the salt is written with the pieces, since it says where they once were
    salted = written(cut_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn("salt", F.spark_partition_id()), "pieces")
    per_task = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = places(solve(counts, capacity))
    before = per_task.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("row", "piece")) - 1)
    ranked = ranked.join(before, ["length", "salt"])

    def make():
        def step(batch: pa.RecordBatch) -> pa.Table:
            t = pa.Table.from_batches([batch])
            length, rank = t["length"].to_numpy(), t["rank"].to_numpy() + t["before"].to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length).tolist():
                mine = np.flatnonzero(length == x)
                first, base, at = where[x]
                run = np.searchsorted(first, rank[mine], "right") - 1
                seq[mine], off[mine] = base[run] + rank[mine] - first[run], at[run]
            return t.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off)).append_column("row", t["row"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(ranked, make, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, row long")
