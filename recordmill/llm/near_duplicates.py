"""Join of documents whose word n-grams have a Jaccard similarity of at least a threshold.

Equal n-gram sets are one text, with its copies counted. Texts that share a MinHash band are linked
to the first of the band, and the components of these links bound what can be similar. Within a
component MinHash values are compared some at a time; a pair is dropped as soon as the posterior
probability that it reaches the threshold falls below a tolerance, and what is left is verified on
the n-gram sets themselves. A component of many texts is dealt in pairs of blocks, so no task holds
it whole and no pair ever becomes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import arrow_map, quoted, set_aside, small, text_of, written
from recordmill.llm.components import components

#: 24 bands of 4 values: a pair at 0.8 shares none with a probability of 3e-6.
BANDS, PER_BAND = 24, 4
HASHES = BANDS * PER_BAND
STEP = 16
#: A block of a component holds about so many texts and bytes at most.
BLOCK_TEXTS, BLOCK_BYTES = 1000, 8_000_000

_rng = np.random.default_rng(20240607)
A = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def ngram_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a text of fewer words is one n-gram, without a word none."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return np.unique(out)


def signature(grams: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(grams), 8192):
        part = (A[:, None] * grams[None, at : at + 8192] + B[:, None]) >> np.uint64(32)
        out = np.minimum(out, part.min(1).astype(np.uint32))
    return out


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """After n values: the fewest matches at which P(similarity >= threshold) is not below the
    tolerance. With a uniform prior that is the chance of at most m successes in n + 1 trials."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
        out[n] = m
    return out


def similar(sigs: np.ndarray, grams: list[np.ndarray], side: np.ndarray, threshold: float, tolerance: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each text the later texts that are similar. side: -1 for all pairs, else pairs across 0 and 1 only."""
    need = least_matches(threshold, tolerance)
    sizes = np.fromiter(map(len, grams), np.int64, len(grams))
    _, ids = np.unique(np.concatenate(grams), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    for a in range(len(grams) - 1):
        left = np.arange(a + 1, len(grams))
        if side[a] >= 0:
            left = left[side[left] != side[a]]
        least = np.minimum(sizes[left], sizes[a])
        left = left[least >= threshold * np.maximum(sizes[left], sizes[a]) - 1e-9]
        matches = np.zeros(len(left), np.int64)
        for n in range(0, HASHES, STEP):
            matches += (sigs[left, n : n + STEP] == sigs[a, n : n + STEP]).sum(1)
            on = matches >= need[n + STEP]
            left, matches = left[on], matches[on]
            if not len(left):
                break
        if not len(left):
            continue
        own = ids[starts[a] : starts[a] + sizes[a]]
        mark[own] = 1
        for k in range(0, len(left), 500):
            some = left[k : k + 500]
            n = sizes[some]
            at = np.cumsum(n) - n
            common = np.add.reduceat(mark[ids[np.repeat(starts[some] - at, n) + np.arange(int(n.sum()))]], at)
            hit = some[common >= threshold * (sizes[a] + n - common) - 1e-9]
            if len(hit):
                yield a, hit
        mark[own] = 0


def verify(ngram: int, threshold: float, tolerance: float):
    """Rows comp, i, j, block, uid, copies, sig, text, in order of (comp, i, j) -> links of each text
    within its group and the least text it is connected to there."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        comp, i, j = rows[0][:3]
        uid = np.array([r[4] for r in rows])
        order = np.argsort(uid)
        uid = uid[order]
        copies = np.array([rows[k][5] for k in order])
        sigs = np.stack([np.frombuffer(rows[k][6], np.uint32) for k in order])
        grams = [ngram_set(rows[k][7].encode(), ngram) for k in order]
        side = np.array([-1 if i == j else int(rows[k][3] == j) for k in order])
        links, docs, root = np.zeros(len(uid), np.int64), np.zeros(len(uid), np.int64), np.arange(len(uid))
        for a, hit in similar(sigs, grams, side, threshold, tolerance):
            links[a] += len(hit)
            docs[a] += copies[hit].sum()
            links[hit] += 1
            docs[hit] += copies[a]
            joined = np.unique(np.append(root[hit], root[a]))
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
        n = len(uid)
        return pa.RecordBatch.from_pydict({"comp": pa.array([comp] * n, pa.int64()), "uid": uid, "links": links, "linked_docs": docs, "root": uid[root]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for part in small(batch):
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if rows and rows[0][:3] != row[:3]:
                        yield flush(rows)
                        rows = []
                    rows.append(row)
        if rows:
            yield flush(rows)

    return run


def near_duplicates(docs: DataFrame, *, keep: tuple[str | Column, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text", ngram: int = 5, threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """The columns of ``keep``, then class_id, n_links, n_linked_texts and kept; a row for each row of ``docs``.

    n_links: other rows that are similar, copies included; n_linked_texts: different similar texts.
    class_id: the least id of the rows that are connected by such links; kept: true for one row of
    each class, the one with the least id (the first of those with the same id). Null or empty
    texts, and texts without a word, have no n-gram and so are alone; texts shorter than an n-gram
    are similar to equal ones. Null ids come first; repeated rows are copies; an empty table gives none.
    Other columns are ignored; a kept one named like a result comes back as input_<name>.
    """
    aside, back = set_aside(docs, keep, ("class_id", "n_links", "n_linked_texts", "kept"))
    spark = docs.sparkSession
    # a kept text is written once, not beside itself
    place = [i for i, c in enumerate(keep) if c == text_col] if all(isinstance(c, str) for c in keep) and dict(docs.dtypes).get(text_col) == "string" else []
    text = f"__keep{place[0]}" if place else "__text"
    rows = docs.select(*aside, quoted(id_col).alias("__id"), *([] if place else [text_of(text_col).alias("__text")]), F.monotonically_increasing_id().alias("__uid"))
    names = [c for c in rows.columns if c.startswith("__keep")]

    def make():
        def step(batch: pa.RecordBatch) -> pa.Table:
            digests, sizes, sigs = [], [], []
            for x in batch.column(batch.schema.get_field_index(text)).to_pylist():
                grams = ngram_set((x or "").encode(), ngram)
                digests.append(hashlib.md5(grams.tobytes(), usedforsecurity=False).digest() if len(grams) else None)
                sizes.append(len(grams))
                sigs.append(signature(grams).tobytes() if len(grams) else None)
            t = pa.Table.from_batches([batch])
            for name, values, kind in (("__digest", digests, pa.binary()), ("__sig", sigs, pa.binary())):
                t = t.append_column(name, pa.array(values, kind))
            return t

        return step

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", __digest binary, __sig binary"
    signed = written(arrow_map(rows, make, schema), "signatures")
    texts = signed.where("__digest is not null").groupBy("__digest").agg(F.min("__uid").alias("uid"), F.count("*").alias("copies")).select("uid", "copies", F.col("__digest").alias("digest"))
    texts = written(texts.join(signed.select(F.col("__uid").alias("uid"), F.col("__sig").alias("sig"), F.octet_length(text).alias("bytes")), "uid"), "texts")
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.substring("sig", i * (4 * PER_BAND) + 1, F.lit(4 * PER_BAND)), i))
    bands = texts.select("uid", F.explode(band).alias("key"))
    heads = bands.groupBy("key").agg(F.min("uid").alias("head"), F.max("uid").alias("last")).where("head <> last")
    roots = written(components(bands.join(heads, "key").where("uid <> head").select(F.col("uid").alias("u"), F.col("head").alias("v"))), "candidates")
    weighed = roots.join(texts.select(F.col("uid").alias("node"), "bytes"), "node")
    sizes = written(weighed.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")), "component-sizes")
    dealt = roots.join(sizes, "root").select(F.col("root").alias("comp"), F.col("node").alias("uid"), "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    full = dealt.join(texts.select("uid", "copies", "sig"), "uid").join(signed.select(F.col("__uid").alias("uid"), F.coalesce(F.col(text), F.lit("")).alias("text")), "uid")
    pairs = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "uid", "copies", "sig", "text")
    found = written(pairs.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(verify(ngram, threshold, tolerance), "comp long, uid long, links long, linked_docs long, root long"), "links")
    linked = found.groupBy("uid").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"), F.min("root").alias("root"), F.max("root").alias("other"), F.first("comp").alias("comp"))
    if not (several := found.join(sizes.where("blocks > 1").select(F.col("root").alias("comp")), "comp", "left_semi")).isEmpty():
        # what is connected through several blocks is joined once more
        whole = components(several.select(F.col("uid").alias("u"), F.col("root").alias("v")).where("u <> v"))
        linked = linked.join(whole.select(F.col("node").alias("uid"), F.col("root").alias("whole")), "uid", "left").withColumn("root", F.coalesce("whole", "root"))
    groups = texts.join(linked.select("uid", "links", "linked_docs", "root"), "uid", "left").select("digest", (F.coalesce("linked_docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_linked_texts"), F.coalesce("root", "uid").alias("class"))
    slim = signed.select("__uid", "__id", "__digest").join(groups, F.col("__digest") == F.col("digest"), "left").select("__uid", "__id", F.coalesce("class", "__uid").alias("__class"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_linked_texts", F.lit(0)).alias("n_linked_texts"))
    # as tables, so that a join may split a class or digest with very many rows
    slim = written(slim, "classes")
    first = written(slim.groupBy("__class").agg(F.min(F.struct("__id", "__uid")).alias("first"), F.count("*").alias("n")).where("n > 1").select("__class", "first"), "first-of-class")
    alone = F.col("first").isNull()
    decided = slim.join(first, "__class", "left").select("__uid", F.when(alone, F.col("__id")).otherwise(F.col("first.__id")).alias("class_id"), "n_links", "n_linked_texts", (alone | (F.col("first.__uid") == F.col("__uid"))).alias("kept"))
    return back(signed.select(*[F.col(f"`{c}`") for c in names], "__uid").join(decided, "__uid").drop("__uid"))


#: The query's rows: exact similarities of all texts that share a 5-gram, and what they connect.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN NULL WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM w
), k AS (SELECT doc_id, s, CASE WHEN s IS NOT NULL THEN md5(array_to_string(s, chr(10))) END AS k FROM s
), t AS (SELECT k, count(*) AS copies, any_value(len(s)) AS n, any_value(s) AS s FROM k WHERE k IS NOT NULL GROUP BY k
), g AS (SELECT k, n, unnest(s) AS gram FROM t
), pair AS (SELECT a.k AS u, b.k AS v FROM g a JOIN g b ON a.gram = b.gram AND a.k <> b.k GROUP BY a.k, b.k, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
), reach AS (SELECT k AS u, k AS v FROM t UNION SELECT reach.u, pair.v FROM reach JOIN pair ON reach.v = pair.u
), linked AS (SELECT u, count(*) AS texts, sum(copies) AS docs FROM pair JOIN t ON pair.v = t.k GROUP BY u
), class AS (SELECT u, min(doc_id) AS class_id FROM reach JOIN k ON reach.v = k.k GROUP BY u)
SELECT k.doc_id, coalesce(class_id, k.doc_id) AS class_id, CAST(coalesce(docs, 0) + coalesce(copies, 1) - 1 AS BIGINT) AS n_links, CAST(coalesce(texts, 0) AS BIGINT) AS n_linked_texts, coalesce(class_id, k.doc_id) = k.doc_id AS kept
FROM k LEFT JOIN t ON k.k = t.k LEFT JOIN linked ON k.k = linked.u LEFT JOIN class ON k.k = class.u
"""
