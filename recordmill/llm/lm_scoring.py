"""Bigram language model with deleted interpolation, counted and scored on Spark.

p(w | h) = l2 c(h, w) / c(h) + l1 c(w) / N + l0 / (V + 1). The weights depend on how often the
context h was seen (a bucket per power of two) and are learned by expectation-maximisation on
held-out counts: a seventh of the training texts (the fold) is left out of the counts that give the
estimates, and the weights are those that make the fold most likely. All training texts are then
counted for scoring.

Texts are kept in batches of some MB. A batch sends each of its distinct n-grams once, as sorted
hashes with counts, to the bucket of the hash; the bucket adds up and sends the corpus counts back
to the batch in the same order. A frequent n-gram is therefore one entry per batch, and no vocabulary
is ever in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import crc32_of, small, text_of, written

END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # white space is in no word
BATCH = 4_000_000
CONTEXT_BUCKETS = 32
#: Probabilities are binned by tenths of a power of ten for the EM statistics.
BINS = 120


def packed(a: np.ndarray) -> bytes:
    """Integers, byte plane by byte plane, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) if len(a) else b""


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = zstandard.ZstdDecompressor().decompress(data) if data else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def batches_of(rows: DataFrame, batch_bytes: int) -> DataFrame:
    """rows: row (the id as text), text, train, fold -> one row per batch of texts; a batch is of the fold or not."""
    kind = pa.list_(pa.int64())

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = 0, {True: [[], [], 0], False: [[], [], 0]}
        part = TaskContext.get().partitionId()

        def flush(fold: bool) -> Iterator[pa.RecordBatch]:
            nonlocal n
            meta, texts, _ = held[fold]
            if meta:
                sizes = list(map(len, texts))
                blob = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
                yield pa.RecordBatch.from_pydict({"batch": pa.array([part << 32 | n], pa.int64()), "fold": [fold], "rows": pa.array([[m[0] for m in meta]], pa.list_(pa.string())), "train": pa.array([[m[1] for m in meta]], pa.list_(pa.bool_())), "sizes": pa.array([sizes], kind), "texts": pa.array([blob], pa.binary())})
                n += 1
            held[fold] = [[], [], 0]

        for whole in source:
            for batch in small(whole, batch_bytes):
                for row, text, train, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    now = held[fold]
                    now[0].append((row, train))
                    now[1].append(data := text.encode())
                    now[2] += len(data)
                    if now[2] >= batch_bytes:
                        yield from flush(fold)
        for fold in (False, True):
            yield from flush(fold)

    return rows.mapInArrow(run, "batch long, fold boolean, rows array<string>, train array<boolean>, sizes array<long>, texts binary")


class Tokens:
    """The tokens of a batch: hashes, contexts, distinct n-grams and each token's place among them."""

    def __init__(self, sizes: list[int], blob: bytes, buckets: int) -> None:
        data, words, counts, at = zstandard.ZstdDecompressor().decompress(blob), [], [], 0
        for size in sizes:
            own = data[at : at + size].lower().split()  # bytes: A-Z and ASCII white space only
            words += own
            counts.append(len(own))
            at += size
        n = np.array(counts, np.int64)
        self.ends = np.cumsum(n + 1)
        total = int(self.ends[-1]) if len(n) else 0
        h = np.full(total, END, np.uint64)
        is_word = np.ones(total, bool)
        is_word[self.ends - 1] = False
        h[is_word] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.first = self.ends - n - 1
        before = np.roll(h, 1)
        before[self.first] = END  # the start of a text is seen as often as its end
        pair = before * np.uint64(0x9E3779B97F4A7C15) ^ (h * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
        pair ^= pair >> np.uint64(29)
        pair *= np.uint64(0xBF58476D1CE4E5B9)
        pair ^= pair >> np.uint64(32)
        self.of_doc = np.repeat(np.arange(len(n)), n + 1)
        self.before = before
        self.words, self.word_at = self.distinct(h, h, buckets)
        # 40 bits within the bucket: with buckets in proportion to the corpus about one n-gram in a million meets another
        self.pairs, self.pair_at = self.distinct(pair, pair >> np.uint64(24), buckets)

    def distinct(self, h: np.ndarray, key: np.ndarray, buckets: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
        """(bucket, sorted keys) lists, and each token's place in their concatenation."""
        some, at = np.unique(h, return_inverse=True)
        b, k = some % np.uint64(buckets), some if key is h else some >> np.uint64(24)
        order = np.lexsort((k, b))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        b, k = b[order].astype(np.int64), k[order]
        cuts = np.flatnonzero(np.diff(b, prepend=-1))
        return [(int(b[i]), k[i:j]) for i, j in zip(cuts, [*cuts[1:], len(b)], strict=True)], rank[at]

    def parts(self) -> Iterator[tuple[str, int, np.ndarray, np.ndarray, int]]:
        """kind, bucket, keys, each token's place, place of the first key."""
        for kind, lists, at in (("word", self.words, self.word_at), ("pair", self.pairs, self.pair_at)):
            start = 0
            for bucket, keys in lists:
                yield kind, bucket, keys, at, start
                start += len(keys)


def send_counts(buckets: int):
    """A batch -> its distinct n-grams with their counts in training texts, by bucket."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for row in whole.to_pylist():
                t = Tokens(row["sizes"], row["texts"], buckets)
                train = np.repeat(np.array(row["train"], bool), np.diff(t.ends, prepend=0)) if row["sizes"] else np.zeros(0, bool)
                out: dict[str, list] = {k: [] for k in ("bucket", "kind", "batch", "fold", "keys", "n")}
                totals = {"word": np.bincount(t.word_at[train], minlength=int(t.word_at.max(initial=-1)) + 1), "pair": np.bincount(t.pair_at[train], minlength=int(t.pair_at.max(initial=-1)) + 1)}
                for kind, bucket, keys, _, start in t.parts():
                    for k, v in (("bucket", bucket), ("kind", kind), ("batch", row["batch"]), ("fold", row["fold"]), ("keys", packed(np.diff(keys, prepend=np.uint64(0)))), ("n", packed(totals[kind][start : start + len(keys)].astype(np.uint32)))):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("batch", pa.int64()), ("fold", pa.bool_()), ("keys", pa.binary()), ("n", pa.binary())]))

    return run


def add_up(group: pa.Table) -> pa.Table:
    """All entries of a bucket and kind -> for every batch the corpus counts of its n-grams, without and with the fold."""
    keys = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in group["keys"].to_pylist()]
    n = np.concatenate([unpacked(x, np.uint32) for x in group["n"].to_pylist()])
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    fold = np.repeat(group["fold"].to_numpy(), sizes)
    some, at = np.unique(np.concatenate(keys), return_inverse=True)
    rest, every = (np.bincount(at, w, len(some)) for w in (np.where(fold, 0, n), n))
    cuts = np.cumsum(sizes)[:-1]
    sums = np.zeros((group.num_rows, 4), np.int64)
    sums[0] = [(rest > 0).sum(), rest.sum(), (every > 0).sum(), every.sum()]
    return pa.table({"batch": group["batch"].cast(pa.int64()), "kind": group["kind"], "bucket": group["bucket"], "fold": group["fold"]} | {name: pa.array([packed(x) for x in np.split(c[at].astype(np.uint32), cuts)], pa.binary()) for name, c in (("rest", rest), ("every", every))} | {name: sums[:, i] for i, name in enumerate(("rest_types", "rest_tokens", "types", "tokens"))})


COUNTED = "batch long, kind string, bucket int, fold boolean, rest binary, every binary, rest_types long, rest_tokens long, types long, tokens long"


def looked_up(batch: dict, counts: pa.Table, buckets: int, which: str) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a batch with c(w), c(h), c(h, w)."""
    t = Tokens(batch["sizes"], batch["texts"], buckets)
    found = {(k, b): x for k, b, x in zip(counts["kind"].to_pylist(), counts["bucket"].to_pylist(), counts[which].to_pylist(), strict=True)}
    tables: dict[str, list] = {"word": [np.zeros(0, np.uint32)], "pair": [np.zeros(0, np.uint32)]}
    for kind, bucket, keys, _, _ in t.parts():
        own = unpacked(found[kind, bucket], np.uint32)
        if len(own) != len(keys):
            raise ValueError("counts of another batch")
        tables[kind].append(own)
    word, pair = (np.concatenate(tables[k]).astype(np.float64) for k in ("word", "pair"))
    c, both = word[t.word_at], pair[t.pair_at]
    before = np.roll(c, 1)
    before[t.first] = c[t.ends - 1]
    return t, c, before, both


def context_bucket(before: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(before + 1)).astype(np.int64), CONTEXT_BUCKETS - 1)


def em(cells: np.ndarray, uniform: float, rounds: int = 60) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of every context bucket from counts of held-out tokens by
    (context bucket, bin of the bigram estimate, bin of the unigram estimate)."""
    value = np.concatenate([[0.0], 10 ** -((np.arange(BINS) + 0.5) / 10)])
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    weights[0] = [0, 0.5, 0.5]  # a context that was never seen has no bigram estimate
    p2, p1 = value[None, :, None], value[None, None, :]
    for _ in range(rounds):
        l2, l1, l0 = (weights[:, i, None, None] for i in range(3))
        terms = [l2 * p2 + 0 * p1, l1 * p1 + 0 * p2, l0 * uniform + 0 * p1 + 0 * p2]
        total = np.maximum(sum(terms), 1e-300)
        mass = np.stack([(cells * x / total).sum((1, 2)) for x in terms], 1) + 1e-3 * weights  # keeps empty buckets
        weights = mass / mass.sum(1, keepdims=True)
    return np.maximum(weights, 1e-9) / np.maximum(weights, 1e-9).sum(1, keepdims=True) if len(weights) else weights


def bins(p: np.ndarray) -> np.ndarray:
    """0 for a probability of zero, else 1 + tenths of -log10."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.clip(np.floor(-10 * np.log10(np.maximum(p, 1e-300))), 0, BINS - 1), 0).astype(np.int64)


def held_out_cells(tokens: float, buckets: int):
    def fn(batch: pa.Table, counts: pa.Table) -> pa.Table:
        out: dict[tuple, int] = {}
        for row in batch.to_pylist():
            t, c, before, both = looked_up(row, counts, buckets, "rest")
            use = np.array(row["train"], bool)[t.of_doc]
            cell = (context_bucket(before) * (BINS + 1) + bins(both / np.maximum(before, 1))) * (BINS + 1) + bins(c / max(tokens, 1))
            for k, n in zip(*np.unique(cell[use], return_counts=True), strict=True):
                out[int(k)] = out.get(int(k), 0) + int(n)
        return pa.table({"cell": pa.array(list(out), pa.int64()), "n": pa.array(list(out.values()), pa.int64())})

    return fn


def score_batch(weights: np.ndarray, types: int, tokens: int, buckets: int):
    def fn(batch: pa.Table, counts: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("row", "n_tokens", "n_known", "base_score", "score")}
        for row in batch.to_pylist():
            t, c, before, both = looked_up(row, counts, buckets, "every")
            w = weights[context_bucket(before)]
            p = w[:, 0] * both / np.maximum(before, 1) + w[:, 1] * c / max(tokens, 1) + w[:, 2] / (types + 1)
            base = np.log10((c + 1) / (tokens + types + 1))
            docs = len(row["rows"])
            out["row"] += row["rows"]
            out["n_tokens"] += np.bincount(t.of_doc, minlength=docs).tolist()
            out["n_known"] += np.bincount(t.of_doc, c > 0, docs).astype(np.int64).tolist()
            out["base_score"] += np.bincount(t.of_doc, base, docs).tolist()
            out["score"] += np.bincount(t.of_doc, np.log10(p), docs).tolist()
        return pa.table(out, schema=pa.schema([("row", pa.string()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]))

    return fn


def score_documents(docs: DataFrame, *, modulus: int = 7, held_out: int = 2, fold: int = 3, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per row of ``docs``.

    Texts with crc32(doc_id) mod ``modulus`` = ``held_out`` teach nothing; those with = ``fold``
    are the fold. A null text is empty (its end token alone); a null id counts as the empty id; a
    table without training texts scores with the uniform distribution over V + 1 = 1 token; an
    empty table gives no row; repeated rows each count and each get a row; other columns are ignored.
    """
    spark = docs.sparkSession
    split = F.pmod(crc32_of(id_col), F.lit(modulus))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), (split != held_out).alias("train"), (split == fold).alias("fold"))
    # ids travel as text, so that any type of id will do
    ids = docs.schema[id_col].dataType.simpleString()
    as_text = rows.select(F.to_json(F.struct("doc_id")).alias("row"), "text", "train", "fold")
    batches = written(batches_of(as_text, batch_bytes), "lm-batches")
    total = batches.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / 16_000_000))
    sent = batches.select("batch", "fold", "train", "sizes", "texts").mapInArrow(send_counts(buckets), "bucket int, kind string, batch long, fold boolean, keys binary, n binary")
    counted = written(sent.groupBy("bucket", "kind").applyInArrow(add_up, COUNTED), "lm-counts")
    sums = counted.where(F.col("kind") == "word").select(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("rest_types", "rest_tokens", "types", "tokens"))).first()
    lists = counted.select("batch", "kind", "bucket", "fold", "rest", "every")
    cells = np.zeros(CONTEXT_BUCKETS * (BINS + 1) ** 2)
    learned = batches.where("fold").groupBy("batch").cogroup(lists.where("fold").groupBy("batch")).applyInArrow(held_out_cells(sums["rest_tokens"], buckets), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for r in learned.collect():  # at most one row per cell
        cells[r["cell"]] = r["n"]
    weights = em(cells.reshape(CONTEXT_BUCKETS, BINS + 1, BINS + 1), 1 / (sums["rest_types"] + 1))
    scored = batches.groupBy("batch").cogroup(lists.drop("rest").groupBy("batch")).applyInArrow(score_batch(weights, sums["types"], sums["tokens"], buckets), "row string, n_tokens long, n_known long, base_score double, score double")
    doc = F.from_json("row", f"doc_id {ids}")["doc_id"]
    return scored.select(doc.alias("doc_id"), (F.pmod(F.crc32(F.coalesce(doc.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == held_out).alias("held_out"), "n_tokens", "n_known", F.lit(sums["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
