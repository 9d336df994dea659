"""Token counts through a digest cache.

The cache is a Parquet table (content_digest, tokenizer_digest, n_tokens). A call joins the digests
of its texts to it, encodes each distinct missing text once, appends the new counts, and joins.
Texts move compressed; one that a task has seen already is dropped before the shuffle, so a text
that fills a third of the table sends one row per task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm.common import arrow_map, quoted, shared_folder, text_of, written

CACHE = "content_digest string, n_tokens long, tokenizer_digest string"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def first_seen(most: int = 500_000):
    """Drops texts whose digest this task has passed on and compresses the others; the set is
    bounded, a later step is exact."""

    def make():
        seen: set[str] = set()
        press = zstandard.ZstdCompressor(level=1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            if len(seen) > most:
                seen.clear()
            keep = []
            for d in batch.column(0).to_pylist():
                keep.append(d not in seen)
                seen.add(d)
            batch = batch.filter(pa.array(keep))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([press.compress(x.encode()) for x in batch.column(1).to_pylist()], pa.binary())], ["content_digest", "text"])

        return step

    return make


def encoder(path: str):
    """A function texts -> numbers of tokens, by the library that the file is for."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(path)
    tk.no_padding()
    tk.no_truncation()
    return lambda texts: [len(tk.encode(x, add_special_tokens=False)) for x in texts]


def encode_misses(path: str):
    def make():
        count, seen, press = encoder(path), set(), zstandard.ZstdDecompressor()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            todo = {d: t for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if d not in seen}
            seen.update(todo)
            return pa.RecordBatch.from_arrays([pa.array(list(todo), pa.string()), pa.array(count([press.decompress(t).decode() for t in todo.values()]), pa.int64())], ["content_digest", "n_tokens"])

        return step

    return make


def digested(docs: DataFrame, text_col: str, normalise: Column | None, *more: Column) -> DataFrame:
    text = text_of(text_col) if normalise is None else F.coalesce(normalise, F.lit(""))
    return docs.select(*more, text.alias("text")).withColumn("content_digest", F.sha2(F.col("text").cast("binary"), 256))


def known_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """One count per text, even if two runs have appended the same one."""
    return spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer_digest") == version).groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens"))


def store_counts(docs: DataFrame, tokenizer: str, cache: str, *, text_col: str = "text", normalise: Column | None = None) -> None:
    """Encodes the distinct texts of ``docs`` that the cache (a folder, made if absent) has no count
    of, and appends these."""
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer_digest").parquet(cache)
    # dealt by digest, so that copies meet in one task; the join keeps that, and holds if nothing is known
    seen_once = arrow_map(digested(docs, text_col, normalise).select("content_digest", "text"), first_seen(), "content_digest string, text binary")
    missing = seen_once.repartition("content_digest").join(known_counts(spark, cache, version).hint("merge"), "content_digest", "left_anti")
    new = arrow_map(missing, encode_misses(tokenizer), "content_digest string, n_tokens long")
    new.withColumn("tokenizer_digest", F.lit(version)).write.mode("append").partitionBy("tokenizer_digest").parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: str, *, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, normalise: Column | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``.

    cache: folder of the cache table, made if absent (default: a new one in the shared folder).
    normalise: the text to count as a column, by default the text itself with null as empty; it
    must not change the count. Nulls count as the empty text, repeated rows and ids each give a
    row, an empty table gives no row, other columns are ignored.
    """
    spark = docs.sparkSession
    cache = cache or shared_folder(spark, "token-counts")
    store_counts(docs, tokenizer, cache, text_col=text_col, normalise=normalise)
    sizes = digested(docs, text_col, normalise, quoted(id_col).alias("doc_id")).select("doc_id", "content_digest", F.octet_length("text").cast("long").alias("n_bytes"))
    # a table: else the join would take over the grouping's partitions and could not split a hot digest
    known = written(known_counts(spark, cache, tokenizer_digest(tokenizer)), "known-counts")
    return sizes.join(known, "content_digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
