"""Near duplicates by one-permutation MinHash.

One hash of each shingle gives both its bin and its value; a bin keeps its least value, and an empty
one borrows from the bin that a hash of (bin, attempt) names first among those that are not empty
(optimal densification). Equal shingle sets are one text. Texts whose bins of a band are equal share a
bucket, and each is linked to the least text of its bucket only: a star, so candidates are no more
than bands x texts. They are confirmed on the full sets.

What a star's centre does not settle has an exact way. After the components of the confirmed links,
only buckets that still hold several components are looked through: their texts are dealt in blocks,
pairs of blocks compare the signatures (a byte a bin, so equal bins are never missed) of texts of
different components, and drop a pair once it is improbable that it reaches the threshold. Texts with a
pair left are fetched, dealt in blocks of bounded bytes and confirmed on the sets. A pair is looked at
in the first bucket that it shares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import arrow_map, quoted, set_aside, small, text_of, written
from recordmill.llm.components import components

#: 28 bands of 6 bins: a pair at 0.85 shares none with a probability of 2e-6.
BANDS, PER_BAND = 28, 6
BINS = BANDS * PER_BAND
#: Texts of a bucket are dealt in blocks of about so many bytes, signatures and stars of so many rows.
BLOCK_BYTES, BLOCK_ROWS = 4_000_000, 4000
TOLERANCE = 1e-6
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text (A-Z in lower case); a text of fewer
    words is one shingle, without a word none."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = mixed((out ^ h[i : len(h) - k + 1 + i]) * ODD)
    return np.unique(out)


@cache
def probes(attempt: int) -> np.ndarray:
    """The bin that each bin borrows from at its so-manieth attempt."""
    x = mixed(mixed(np.arange(BINS, dtype=np.uint64) + np.uint64(1) << np.uint64(32)) + np.uint64(attempt))
    return ((x >> np.uint64(32)) % np.uint64(BINS)).astype(np.int64)


def signature(grams: np.ndarray) -> np.ndarray:
    """The least value of each bin, empty bins filled by probing."""
    bins = ((grams >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    out = np.full(BINS, 2**32 - 1, np.uint32)
    np.minimum.at(out, bins, (mixed(grams) >> np.uint64(32)).astype(np.uint32))
    filled = np.zeros(BINS, bool)
    filled[bins] = True
    source, attempt = np.arange(BINS), 0
    empty = np.flatnonzero(~filled)
    while len(empty):
        source[empty] = probes(attempt)[empty]
        empty = empty[~filled[source[empty]]]
        attempt += 1
    return out[source]


@cache
def least_matches(threshold: float, tolerance: float, at: tuple[int, ...]) -> dict[int, int]:
    """After n bins: the fewest matches of which the chance at the threshold is not below the tolerance."""
    out = {}
    for n in at:
        total = 0.0
        for m in range(n + 1):
            total += comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
            if total >= tolerance:
                break
        out[n] = m
    return out


def band_keys(sig: np.ndarray) -> list[int]:
    return [xxhash.xxh64_intdigest(part.tobytes(), seed=i) - 2**63 for i, part in enumerate(sig.reshape(BANDS, PER_BAND))]


def confirm(ngram: int, percent: int):
    """Rows head, part, uid, text, in order of (head, part), a head's own text first -> u, v of the texts
    that are linked to their head. A task holds the head's set and one text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centre = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in small(batch):
                u, v = [], []
                for head, _, uid, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    grams = shingle_set(text.encode(), ngram)
                    if uid == head:
                        now, centre = head, grams
                    elif head == now and 100 * min(len(grams), len(centre)) >= percent * max(len(grams), len(centre)):
                        common = len(np.intersect1d(grams, centre, assume_unique=True))
                        if 100 * common >= percent * (len(grams) + len(centre) - common):
                            u.append(uid)
                            v.append(head)
                yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def confirmed(edges: DataFrame, texts: DataFrame, ngram: int, percent: int) -> DataFrame:
    """edges: uid, head; texts: uid, text -> the edges u, v whose texts are similar enough. A text goes
    to its heads, and a head to each part of its star; a part has about BLOCK_ROWS texts, which are
    streamed."""
    parts = written(edges.groupBy("head").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts")), "star-parts")
    members = edges.join(parts, "head").select("head", F.pmod(F.xxhash64("uid"), "parts").cast("int").alias("part"), "uid")
    heads = parts.select("head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("head").alias("uid"))
    # the same plan at every size: a broadcast of small stars would hide what texts cost
    rows = written(members.union(heads), "star-members").hint("merge").join(texts, "uid").select("head", "part", "uid", "text")
    dealt = rows.repartition("head", "part").sortWithinPartitions("head", "part", (F.col("uid") == F.col("head")).desc())
    return dealt.mapInArrow(confirm(ngram, percent), "u long, v long")


def likely(sigs: np.ndarray, keys: np.ndarray, comp: np.ndarray, side: np.ndarray, band: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text the later ones of another component (and of the other side, where there are two)
    that may be similar to it, without those that share a bucket of an earlier band."""
    need = least_matches(percent / 100, TOLERANCE, tuple(range(PER_BAND * 4, BINS + 1, PER_BAND * 4)))
    two = side.any() and not side.all()
    for a in range(len(sigs) - 1):
        left = np.arange(a + 1, len(sigs))
        left = left[(comp[left] != comp[a]) & ((side[left] != side[a]) if two else True)]
        matches, done = np.zeros(len(left), np.int64), 0
        for upto, least in need.items():
            matches = matches + (sigs[left, done:upto] == sigs[a, done:upto]).sum(1)
            on = matches >= least
            left, matches, done = left[on], matches[on], upto
            if not len(left):
                break
        if band and len(left):
            left = left[~(keys[left, :band] == keys[a, :band]).any(1)]
        if len(left):
            yield a, left


def compared(ngram: int, percent: int, with_text: bool):
    """Rows key, i, j, band, block, uid, root, sig, keys (and text), in order of (key, i, j): pairs of
    blocks of a bucket. Without texts -> key, uid of those that may be similar to one of another
    component; with texts -> u, v of those that are, a forest of these links."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        key, i, j, band = rows[0][:4]
        n = len(rows)
        uid, comp = np.array([r[5] for r in rows]), np.array([r[6] for r in rows])
        side = np.array([int(i != j and r[4] == j) for r in rows])
        sigs, keys = np.stack([np.frombuffer(r[7], np.uint8) for r in rows]), np.array([r[8] for r in rows])
        pairs = likely(sigs, keys, comp, side, band, percent)
        if not with_text:
            hit = np.zeros(n, bool)
            for a, left in pairs:
                hit[a] = True
                hit[left] = True
            return pa.RecordBatch.from_pydict({"key": pa.array([key] * int(hit.sum()), pa.int64()), "uid": pa.array(uid[hit], pa.int64())})
        sets: dict[int, np.ndarray] = {}
        _, root = np.unique(comp, return_inverse=True)

        def grams(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingle_set(rows[k][9].encode(), ngram)
            return sets[k]

        u, v = [], []
        for a, left in pairs:
            for b in left.tolist():
                if root[a] == root[b]:
                    continue
                s, t = grams(a), grams(b)
                common = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * common >= percent * (len(s) + len(t) - common):
                    u.append(uid[a])
                    v.append(uid[b])
                    root[root == root[b]] = root[a]
        return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

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


def in_blocks(rows: DataFrame, sizes: DataFrame, *more: str) -> DataFrame:
    """Rows of a bucket, each in all pairs of its block with another; sizes: key, blocks."""
    dealt = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block", "uid", "root", "sig", "keys", *more)
    return pairs.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "uid")


def unsettled(bands: DataFrame, signs: DataFrame, texts: DataFrame, comps: DataFrame, ngram: int, percent: int) -> DataFrame:
    """Links between texts of different components that share a bucket. bands: uid, band, key;
    signs: uid, sig, keys; texts: uid, text; comps: node, root."""
    rooted = bands.join(comps.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    open_ = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    rows = written(rooted.join(open_, "key", "left_semi").hint("merge").join(signs, "uid"), "open-buckets")
    # as tables, so that the joins may split a bucket with very many texts
    sizes = written(rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")), "open-sizes")
    flagged = written(in_blocks(rows, sizes).mapInArrow(compared(ngram, percent, False), "key long, uid long"), "open-pairs")
    if flagged.isEmpty():
        return flagged.select(F.col("uid").alias("u"), F.col("uid").alias("v"))
    full = written(rows.join(flagged.distinct(), ["key", "uid"], "left_semi").join(texts, "uid").withColumn("bytes", F.octet_length("text") + F.lit(12 * BINS)), "open-texts")
    sizes = written(full.groupBy("key").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks")), "text-sizes")
    return in_blocks(full, sizes, "text").mapInArrow(compared(ngram, percent, True), "u long, v long")


def minhash_components(docs: DataFrame, *, keep: tuple[str | Column, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text", ngram: int = 3, percent: int = 85) -> DataFrame:
    """The columns of ``keep``, then n_shingles, component_id and kept; a row for each row of ``docs``.

    Two rows are linked if 100 x common >= percent x united shingles (of ``ngram`` words, A-Z in lower
    case). component_id: the least id that links lead to, its own included; kept: whether that is its
    own, so rows that repeat an id are all kept or none is. Null or empty texts, and texts without a
    word, have no shingle and are linked with nothing, not even each other; texts of fewer words are
    one shingle and linked to equal ones. A null id is never the least; where a component has no
    other, its component_id is null and its rows are kept. An empty table gives no row. Other columns
    are ignored; a kept one named like a result comes back as input_<name>.
    """
    aside, back = set_aside(docs, keep, ("n_shingles", "component_id", "kept"))
    rows = docs.select(*aside, quoted(id_col).alias("__id"), text_of(text_col).alias("__text"), F.monotonically_increasing_id().alias("__uid"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.Table:
            digests, sizes, keys, sigs = [], [], [], []
            for x in batch.column(batch.schema.get_field_index("__text")).to_pylist():
                grams = shingle_set(x.encode(), ngram)
                digests.append(hashlib.md5(grams.tobytes(), usedforsecurity=False).digest() if len(grams) else None)
                sizes.append(len(grams))
                sig = signature(grams) if len(grams) else None
                keys.append(None if sig is None else band_keys(sig))
                sigs.append(None if sig is None else sig.astype(np.uint8).tobytes())
            t = pa.Table.from_batches([batch])
            for name, values, kind in (("__digest", digests, pa.binary()), ("n_shingles", sizes, pa.int64()), ("__keys", keys, pa.list_(pa.int64())), ("__sig", sigs, pa.binary())):
                t = t.append_column(name, pa.array(values, kind))
            return t

        return step

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", __digest binary, n_shingles long, __keys array<long>, __sig binary"
    signed = written(arrow_map(rows, make, schema), "signed")
    equal = signed.where("__digest is not null").groupBy(F.col("__digest").alias("digest")).agg(F.min("__uid").alias("uid"), F.min("__id").alias("least"))
    equal = written(equal, "equal-sets")
    texts = signed.select(F.col("__uid").alias("uid"), F.col("__text").alias("text"))
    one = signed.select(F.col("__uid").alias("uid"), "__keys").join(equal.select("uid"), "uid", "left_semi")
    bands = one.select("uid", F.posexplode("__keys").alias("band", "key"))
    # as tables, so that the joins may split a bucket with very many texts
    heads = written(bands.groupBy("key").agg(F.min("uid").alias("head"), F.max("uid").alias("last")).where("head <> last").select("key", "head"), "centres")
    shared = written(bands.join(heads, "key").select("uid", "band", "key", "head"), "shared-buckets")
    edges = written(shared.where("uid <> head").select("uid", "head").distinct(), "stars")
    links = written(confirmed(edges, texts, ngram, percent), "links")
    comps = written(components(links), "star-components")
    signs = signed.select(F.col("__uid").alias("uid"), F.col("__sig").alias("sig"), F.col("__keys").alias("keys"))
    more = written(unsettled(shared.select("uid", "band", "key"), signs, texts, comps, ngram, percent), "more-links")
    if not more.isEmpty():
        comps = written(components(links.union(more)), "components")
    rooted = equal.join(comps.select(F.col("node").alias("uid"), "root"), "uid", "left").select("digest", "least", F.coalesce("root", "uid").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(rooted.join(least, "root").select("digest", "component_id"), "component-ids")
    # a table, so that the join may split a set with very many copies
    slim = written(signed.select("__uid", "__id", "__digest"), "documents").join(groups, F.col("__digest") == F.col("digest"), "left")
    found = F.when(F.col("__digest").isNull(), F.col("__id")).otherwise(F.col("component_id"))
    decided = slim.select("__uid", found.alias("component_id"), F.coalesce(F.col("__id") == found, found.isNull()).alias("kept"))
    names = [c for c in rows.columns if c.startswith("__keep")]
    return back(signed.select(*[F.col(f"`{c}`") for c in names], "__uid", "n_shingles").join(decided, "__uid").drop("__uid"))


#: The query's rows: exact similarities of all texts that share a shingle, and what they connect.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN NULL WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) END AS s FROM w
), k AS (SELECT doc_id, s, CASE WHEN s IS NOT NULL THEN md5(array_to_string(s, chr(10))) END AS k FROM s
), t AS (SELECT k, any_value(len(s)) AS n, any_value(s) AS s FROM k WHERE k IS NOT NULL GROUP BY k
), g AS (SELECT k, n, unnest(s) AS gram FROM t
), pair AS (SELECT a.k AS u, b.k AS v FROM g a JOIN g b ON a.gram = b.gram AND a.k <> b.k GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (SELECT k AS u, k AS v FROM t UNION SELECT reach.u, pair.v FROM reach JOIN pair ON reach.v = pair.u
), class AS (SELECT u, min(doc_id) AS component_id FROM reach JOIN k ON reach.v = k.k GROUP BY u)
SELECT k.doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_shingles, coalesce(component_id, k.doc_id) AS component_id, coalesce(component_id, k.doc_id) = k.doc_id AS kept
FROM k LEFT JOIN class ON k.k = class.u
"""
