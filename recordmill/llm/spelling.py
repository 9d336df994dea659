"""Spelling variants: words that differ by one inserted, deleted or replaced character, without pairs.

A word of length L belongs to L wildcard groups, (position, prefix, suffix) with that position left
open; words of one group differ in that character alone. A group keeps its size and its two best
words, so that each member finds the best of the others there. Insertions and deletions meet by
joining each word's deletions with the vocabulary. What a word finds in its groups and its deletions is
combined; no pair of words of a group is made.

Words are numbered by (most occurrences, then code points), so the better of two words is the one
with the smaller number. Prefixes and suffixes are compared by polynomial fingerprints modulo three
primes of 31 bits (93 bits together), which take a word's length in time and memory, not its square.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import arrow_map, text_of, written

PRIMES = np.array([2147483647, 2147483629, 2147483587], np.uint64)
BASES = np.array([1103515245, 1566083941, 692893783], np.uint64)
INVERSE = np.array([pow(int(b), -1, int(p)) for b, p in zip(BASES, PRIMES, strict=True)], np.uint64)


def noisy(run: str, doc_id: str, modulus: int) -> str:
    """The run without one character if the modulus divides the crc32 of id:run."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, *, id_col: str, text_col: str, pattern: str, min_chars: int, modulus: int | None) -> DataFrame:
    """word, n: runs of the pattern (A-Z in lower case) of all texts, added up per batch of some MB
    before they are shuffled."""
    rows = docs.select(text_of(id_col).alias("id"), text_of(text_col).alias("text"))

    def make():
        runs = re.compile(pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            total: Counter = Counter()
            for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # of bytes, lower() changes A-Z only
                found = Counter(runs.findall(text.encode().lower().decode()))
                if modulus:
                    for run, n in found.items():
                        total[noisy(run, i, modulus)] += n
                else:
                    total.update(found)
            words = [w for w in total if len(w) >= min_chars]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())], names=["word", "n"])

        return step

    return arrow_map(rows, make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def powers(most: int) -> np.ndarray:
    """powers[k, i] = base_k^i, for i below ``most`` at least."""
    out = np.ones((len(PRIMES), 1), np.uint64)
    step = BASES.copy()
    while out.shape[1] < most:
        out = np.concatenate([out, out * step[:, None] % PRIMES[:, None]], 1)
        step = step * step % PRIMES
    return out


def packed(parts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Three residues as two longs: 62 bits and 31 bits."""
    return pa.array(((parts[0] << np.uint64(31)) | parts[1]).astype(np.int64)), pa.array(parts[2].astype(np.int64))


def fingerprints():
    """id, word -> id, at, a, b (the word without its character at ``at``, left open; -1 for the whole word)
    and da, db (the word with it deleted; null where the character before is the same, whose deletion
    gives the same)."""
    held = powers(1 << 12)

    def step(batch: pa.RecordBatch) -> pa.Table:
        nonlocal held
        words = batch.column(1).to_pylist()
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if sizes.max(initial=0) > held.shape[1]:
            held = powers(int(sizes.max()))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        first = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(codes)) - first[of]
        totals, opened, deleted = [], [], []
        for k, p in enumerate(PRIMES):
            term = codes * held[k, place] % p
            upto = np.concatenate([[0], np.cumsum(term)]).astype(np.uint64)  # 2^31 x characters of a batch at most
            total = (upto[first + sizes] - upto[first]) % p
            before = (upto[:-1] - upto[first][of]) % p
            rest = (total[of] + p - term) % p
            totals.append(total)
            opened.append(rest)
            deleted.append((before + (rest + p - before) % p * INVERSE[k]) % p)
        same = np.zeros(len(codes), bool)
        same[1:] = (codes[1:] == codes[:-1]) & (place[1:] > 0)
        ids = batch.column(0).to_numpy()
        a, b = packed(np.stack(opened))
        whole = packed(np.stack(totals))
        da, db = (pa.array(x.to_numpy(), mask=same) for x in packed(np.stack(deleted)))
        parts = [pa.table({"id": ids[of], "at": pa.array(place, pa.int32()), "a": a, "b": b, "da": da, "db": db}), pa.table({"id": ids, "at": pa.array(np.full(len(ids), -1), pa.int32()), "a": whole[0], "b": whole[1], "da": pa.nulls(len(ids), pa.int64()), "db": pa.nulls(len(ids), pa.int64())})]
        return pa.concat_tables(parts)

    return step


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", pattern: str = "[A-Za-zÀ-ÿ]+", min_chars: int = 6, min_count: int = 5, ratio: int = 5, modulus: int | None = 199) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row for each word of the corpus.

    Runs of the pattern, with A-Z in lower case, of ``min_chars`` characters and ``min_count``
    occurrences. With a ``modulus`` one character is taken out of the runs of some documents, as
    typing errors. n_near: words at one inserted, deleted or replaced character; form: the most
    frequent of them (ties: least in code-point order) if it occurs ``ratio`` times as often, else
    null; root: where the forms lead to in the end, the word itself if it has none.

    A wildcard group holds at most as many words as the pattern has characters. Null texts have no
    word, a null id counts as the empty one, repeated rows count again; an empty table gives no row.
    Other columns are ignored. Words of any length will do: a word takes rows in proportion to it.
    """
    words = counted(docs, id_col=id_col, text_col=text_col, pattern=pattern, min_chars=min_chars, modulus=modulus).where(F.col("n") >= min_count)
    # sorted partitions come in order, so these numbers are in order of (n, word) as well
    words = written(words.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()), "words")
    marks = written(arrow_map(words.select("id", "word").repartition("id"), fingerprints, "id long, at int, a long, b long, da long, db long", 1_000_000), "fingerprints")
    open_ = marks.where("at >= 0")
    # two best words of a group: its size is bounded by the alphabet
    groups = open_.groupBy("at", "a", "b").agg(F.count("*").alias("size"), F.slice(F.sort_array(F.collect_list("id")), 1, 2).alias("best")).where("size > 1")
    others = open_.select("id", "at", "a", "b").join(groups, ["at", "a", "b"]).select("id", (F.col("size") - 1).alias("near"), F.when(F.col("best")[0] == F.col("id"), F.col("best")[1]).otherwise(F.col("best")[0]).alias("best"))
    shorter = open_.where("da is not null").select("id", F.col("da").alias("a"), F.col("db").alias("b"))
    whole = marks.where("at < 0").select(F.col("id").alias("short"), "a", "b")
    longer = shorter.groupBy("a", "b").agg(F.count("*").alias("near"), F.min("id").alias("best")).join(whole, ["a", "b"]).select(F.col("short").alias("id"), "near", "best")
    cut = shorter.join(whole, ["a", "b"]).select("id", F.lit(1).cast("long").alias("near"), F.col("short").alias("best"))
    found = others.unionByName(longer).unionByName(cut).groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    best = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    rows = words.join(found, "id", "left").join(best, "best", "left").withColumn("is_form", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
    rows = written(rows.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(F.col("is_form"), F.col(c)).alias(c) for c in ("form", "form_n", "best")]), "forms")
    roots = followed(rows.where("best is not null").select("id", F.col("best").alias("to")))
    top = words.select(F.col("id").alias("to"), F.col("word").alias("root"))
    out = rows.join(roots.join(top, "to").select("id", "root"), "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def followed(steps: DataFrame) -> DataFrame:
    """id, to: where each id's steps end. Each round doubles the steps; a form occurs several times as
    often as its word, so paths are as short as the logarithm of the counts."""
    now = written(steps, "roots")
    while True:
        on = now.select(F.col("id").alias("to"), F.col("to").alias("next"))
        if now.join(on, "to", "left_semi").isEmpty():
            return now
        now = written(now.join(on, "to", "left").select("id", F.coalesce("next", "to").alias("to")), "roots")
