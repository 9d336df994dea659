"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import fill_middle, license_scan, minhash_dedup, quality_rules, substring_dedup
from recordmill.llm import near_duplicates as near_duplicates_module
from recordmill.llm.bpe_codec import round_trip_digests
from recordmill.llm.common import crc32_of, shared_folder
from recordmill.llm.fill_middle import fill_in_middle, restored
from recordmill.llm.language_id import fit, identify
from recordmill.llm.license_scan import corpus_path, scan
from recordmill.llm.lm_scoring import score_documents
from recordmill.llm.minhash_dedup import minhash_components
from recordmill.llm.near_duplicates import near_duplicates
from recordmill.llm.neighbours import search
from recordmill.llm.packing import pack
from recordmill.llm.quality_rules import assess
from recordmill.llm.spelling import variants
from recordmill.llm.substring_dedup import Rule, remove_repeats
from recordmill.llm.token_counts import count_tokens, store_counts
from recordmill.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two calls with one cache: the second finds what the first has stored of half of the documents.
    That shows the cache at work and saves nothing here, as each run begins a new one."""
    docs, path, cache = table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), shared_folder(spark, "token-counts")
    store_counts(docs.where(F.pmod(crc32_of("doc_id"), F.lit(2)) == 0), path, cache)
    return count_tokens(docs, path, cache=cache, limit=4096)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), corpus_path())


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), ngram=5, threshold=0.8)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0).drop("row")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), rule=Rule(400), passages=Rule(50, "words")).drop("clean_text", "spans")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc32_of("doc_id"), F.lit(4)) == 2
    model = fit(docs.where(~held_out), sample_rows=20_000)
    return identify(docs, model, keep=(F.col("doc_id"), held_out.alias("held_out"))).select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), modulus=7, held_out=2, fold=3)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents"), keep=(F.col("doc_id"),)).drop("lost_share", "clean_text")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(table(spark, sf_dir, "documents"), ngram=3, percent=85)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"), min_chars=6, min_count=5, ratio=5, modulus=199)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restored(fill_in_middle(table(spark, sf_dir, "documents"), seed=42))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        *(op1_multiprobe_neighbours, op2_token_counts, op3_license_scan, op4_ngram_jaccard_join, op5_best_fit_packing, op6_bpe_codec, op7_suffix_array_dedup),
        *(op8_language_id, op9_lm_scoring, op10_quality_rules, op11_minhash_near_dedup, op12_spelling_variants, op13_fill_in_middle),
    )
}
ORACLES: dict[str, str] = {
    "op3_license_scan": license_scan.ORACLE,
    "op4_ngram_jaccard_join": near_duplicates_module.ORACLE,
    "op7_suffix_array_dedup": substring_dedup.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_minhash_near_dedup": minhash_dedup.ORACLE,
    "op13_fill_in_middle": fill_middle.ORACLE,
}
