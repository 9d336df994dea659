"""Documents to packed sequences: language, quality, near duplicates, repeated passages, packing.

STAGES are applied in order, each to all that the one before it kept; every stage but the last
returns the columns of its input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm.common import written
from recordmill.llm.language_id import fit, identify
from recordmill.llm.near_duplicates import near_duplicates
from recordmill.llm.packing import pack
from recordmill.llm.quality_rules import assess
from recordmill.llm.substring_dedup import Rule, remove_repeats
from recordmill.shipping import ship


class Numbered:
    """The documents under generated column names, so that no column of theirs, whatever it is called,
    meets one that an operator makes; and the way back to their own names."""

    def __init__(self, docs: DataFrame) -> None:
        self.names = docs.columns
        self.columns = [f"c{i}" for i in range(len(self.names))]
        self.docs = docs.toDF(*self.columns)

    def of(self, name: str) -> str:
        return self.columns[self.names.index(name)]

    def but_text(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c != self.of("text"))

    def back(self, found: DataFrame, text: str | None = None) -> DataFrame:
        """The documents' columns of ``found``; if a text is named it takes the place of theirs, and
        its length that of n_chars, where they have one."""
        new = {self.of("text"): F.col(text)} if text else {}
        if text and "n_chars" in self.names:
            new[self.of("n_chars")] = F.length(text).cast(self.docs.schema[self.of("n_chars")].dataType)
        return found.select(*[new.get(c, F.col(c)).alias(c) for c in self.columns]).toDF(*self.names)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of which one language has a third of the letters at least: texts with a quoted
    passage in another language stay. Null texts, and those without a letter, go; equal shares go to
    the language first in the alphabet; if no row has a language, none is learnt and all go; an empty
    table stays one."""
    rows = Numbered(docs)
    model = fit(rows.docs, text_col=rows.of("text"), lang_col=rows.of("lang"), id_col=rows.of("doc_id"), sample_rows=20_000)
    found = identify(rows.docs, model, text_col=rows.of("text"), keep=tuple(rows.columns))
    return rows.back(found.where("lang_pred <> 'und' and score >= 1 / 3"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the rules, without the lines that fail them. Null and empty texts go; repeated
    rows fare alike; an empty table stays one."""
    rows = Numbered(docs)
    return rows.back(assess(rows.docs, text_col=rows.of("text"), keep=rows.but_text()).where("kept"), text="clean_text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group with 5-gram Jaccard similarities of 0.8 or more: the one with the
    least id (null first), of several with that id any one. Texts without a word are alone and stay; an
    empty table stays one."""
    rows = Numbered(docs)
    found = near_duplicates(rows.docs, keep=tuple(rows.columns), id_col=rows.of("doc_id"), text_col=rows.of("text"), ngram=5, threshold=0.8)
    return rows.back(found.where("kept"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 50 words or more that occur twice, each time; documents stay, if need be
    empty, null texts as empty ones. Repeated rows are each other's repeats; an empty table stays one."""
    rows = Numbered(docs)
    found = remove_repeats(rows.docs, rule=Rule(50, "words"), keep=rows.but_text(), text_col=rows.of("text"))
    return rows.back(found, text="clean_text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the tokens of all documents to sequences of 2048. Null texts are empty, of one token; repeated
    ids have pieces of their own; longer texts are cut; an empty table gives no piece."""
    rows = Numbered(docs)
    return pack(rows.docs, public_tokenizers.path("word_bpe_49k.json"), id_col=rows.of("doc_id"), text_col=rows.of("text"), capacity=2048, end_id=0).drop("row")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeats),
    ("best-fit packing", packing),
]

#: Suffix sorting, Viterbi and packing have no SQL form: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
