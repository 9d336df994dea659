import os
from collections import Counter

import pytest

import corpus_pipeline
from recordmill.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not there")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.columns == columns and 0 < docs.count() <= n
        n = docs.count()
    # each stage finds nothing more in its own output, but for repeats, which only get fewer
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs.where("n_chars > 600"), SF).count() >= 0.9 * docs.where("n_chars > 600").count(), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == n
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, ""), name.replace(" ", "-"))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_columns_of_any_name(spark, docs):
    """Every stage and operator with columns that are called like its own, and one with a dot."""
    from pyspark.sql import functions as F

    names = ["score", "lang_pred", "spans", "kept", "clean_text", "class_id", "n_bytes", "n_links", "__text", "__uid", "__keep0", "a.b", "piece", "n_words"]
    rows = docs.select("doc_id", "text", "lang", "n_chars", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in names])
    columns, now = rows.columns, rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, ""), name.replace(" ", "-"))
        assert now.columns == columns and now.count() > 0, name
        for r in now.collect():
            assert all(r[n] == (None if r.doc_id is None else f"{n} of {r.doc_id}") for n in names), name
    packed = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert packed.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()


def test_kept_columns_called_like_results(spark, docs):
    from recordmill.llm.language_id import fit, identify
    from recordmill.llm.near_duplicates import near_duplicates
    from recordmill.llm.quality_rules import assess
    from recordmill.llm.substring_dedup import remove_repeats

    rows = docs.selectExpr("doc_id", "text", "lang", "'mine' as kept", "'mine' as score", "'mine' as n_bytes", "'mine' as `a.b`")
    for out, clash in ((identify(rows, fit(rows), keep=("doc_id", "score", "a.b")), "score"), (assess(rows, keep=("doc_id", "kept", "a.b")), "kept"), (near_duplicates(rows, keep=("doc_id", "kept", "a.b")), "kept"), (remove_repeats(rows, keep=("doc_id", "n_bytes", "a.b")), "n_bytes")):
        assert out.columns[:3] == ["doc_id", f"input_{clash}", "a.b"] and out.columns.count(clash) == 1
        assert {r[1] for r in out.collect()} == {"mine"}


def test_passages_of_fifty_words_go(spark):
    """What the stage of repeats leaves has no passage of 50 words twice, by sets of word tuples."""
    docs = spark.read.parquet(f"{SF}/documents.parquet") if os.path.isdir(SF) else None
    if docs is None:
        pytest.skip("the tables are not there")
    found = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, docs, SF).collect()}
    texts = [r.text for r in docs.collect()]
    seen = Counter(tuple(w[i : i + 50]) for w in ((t or "").split() for t in texts) for i in range(len(w) - 49))
    for r in docs.collect():
        words = (r.text or "").split()
        twice = any(seen[tuple(words[i : i + 50])] > 1 for i in range(len(words) - 49))
        assert twice == (found[r.doc_id] != (r.text or ""))
