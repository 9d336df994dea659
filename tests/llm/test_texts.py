import collections
import hashlib
import math
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recordmill.llm.common import crc32_of
from recordmill.llm.language_id import fit, identify, viterbi
from recordmill.llm.license_scan import ORACLE as LICENCE_SQL
from recordmill.llm.license_scan import corpus_path, scan
from recordmill.llm.lm_scoring import score_documents
from recordmill.llm.near_duplicates import ORACLE as NEAR_SQL
from recordmill.llm.near_duplicates import near_duplicates
from recordmill.llm.quality_rules import ORACLE as QUALITY_SQL
from recordmill.llm.quality_rules import assess
from recordmill.llm.substring_dedup import ORACLE as REPEATS_SQL
from recordmill.llm.substring_dedup import Rule, remove_repeats
from recordmill.llm.suffix_array import suffix_array

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not there")


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(held):
    sets = [shingles(t) for _, t in held]
    root, links = list(range(len(held))), [0] * len(held)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(held)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(held):
        ids[find(i)].append(d)
    first = {r: None if None in x else min(x) for r, x in ids.items()}
    return sorted([(d, first[find(i)], links[i]) for i, (d, _) in enumerate(held)], key=key), len(ids)


def test_near_duplicates_equal_brute_force(docs, empty, held):
    out = near_duplicates(docs).collect()
    want, classes = brute_classes(held)
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in out], key=key) == want
    assert sum(r.kept for r in out) == classes
    assert near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("limit", "value"), [("BLOCK_TEXTS", 40), ("BLOCK_BYTES", 30_000)])
def test_near_duplicates_of_a_large_group(spark, monkeypatch, limit, value):
    import recordmill.llm.near_duplicates as m

    monkeypatch.setattr(m, limit, value)
    common = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(["alone" + str(i) if k == 7 + i % 90 else w for k, w in enumerate(common)])) for i in range(150)]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want, _ = brute_classes(rows)
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in out], key=key) == want


def brute_repeats(held, length):
    data, seen = [(t or "").encode() for _, t in held], collections.Counter()
    for b in data:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(held, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, x in zip(b, gone, strict=True) if not x)).hexdigest()))
    return sorted(out, key=key)


def brute_passages(held, length):
    """(id, runs of repeated words, their words, the text without them) by sets of word tuples."""
    import re

    found = [list(re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for _, t in held]
    words = [[m[0] for m in f] for f in found]
    seen = collections.Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (d, t), w, f in zip(held, words, found, strict=True):
        gone = [any(seen[tuple(w[i : i + length])] > 1 for i in range(max(0, k - length + 1), min(k, len(w) - length) + 1)) for k in range(len(w))]
        starts = [k for k, x in enumerate(gone) if x and not (k and gone[k - 1])]
        rest, at, data = b"", 0, (t or "").encode()
        for k in starts:
            end = k
            while end < len(gone) and gone[end]:
                end += 1
            rest += data[at : f[k].start()]
            at = f[end - 1].end()
        out.append((d, len(starts), sum(gone), (rest + data[at:]).decode()))
    return sorted(out, key=key)


@pytest.mark.parametrize(("length", "most", "segment"), [(400, 1000, 3_000_000), (100, 1000, 700), (100, 1, 3_000_000)])
def test_repeats_equal_brute_force(docs, empty, held, monkeypatch, length, most, segment):
    import recordmill.llm.substring_dedup as m

    monkeypatch.setattr(m, "SEGMENT", segment)
    rows = docs.where(F.length("text") < 5000) if length < 400 else docs
    mine = [x for x in held if length == 400 or (x[1] is not None and len(x[1]) < 5000)]
    out = remove_repeats(rows, rule=Rule(length), passages=Rule(10, "words"), most_contexts=most).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out], key=key) == brute_repeats(mine, length)
    assert sorted([(r.doc_id, r.n_passages, r.n_passage_words) for r in out], key=key) == [x[:3] for x in brute_passages(mine, 10)]
    assert remove_repeats(empty).count() == 0


@pytest.mark.parametrize(("length", "most"), [(50, 1000), (12, 1)])
def test_repeated_words_equal_brute_force(docs, held, length, most):
    out = remove_repeats(docs, rule=Rule(length, "words"), most_contexts=most).collect()
    assert sorted([(r.doc_id, r.n_spans, r.clean_text) for r in out], key=key) == [(d, n, t) for d, n, _, t in brute_passages(held, length)]


def test_passages_of_fifty_words_between_other_white_space(spark):
    rng = np.random.default_rng(3)
    some = [f"w{i}" for i in rng.integers(0, 10**6, 700)]
    passage = some[:51]
    rows = [(k, " ".join(some[60 + 90 * k : 100 + 90 * k]) + "\n" + gap.join(passage) + "\t" + " ".join(some[100 + 90 * k : 150 + 90 * k])) for k, gap in enumerate((" ", "\n", "  "))]
    rows += [(9, " ".join(some[600:690])), (10, " ".join(passage[:49]))]
    out = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), rule=Rule(50, "words")).collect()}
    assert [out[k].n_spans for k in (0, 1, 2, 9, 10)] == [1, 1, 1, 0, 0]
    assert all(passage[0] not in out[k].clean_text.split() and some[60 + 90 * k] in out[k].clean_text for k in (0, 1, 2))


def test_rules_are_checked():
    for wrong in ((63, "bytes"), (7, "words"), (400, "lines")):
        with pytest.raises(ValueError, match="unit must be"):
            Rule(*wrong)


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 30, 200):
        for k in (1, 2, 4):
            s = [*(rng.integers(1, k + 1, n).tolist() * 2), 0]
            assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])  # noqa: B023


def test_language_model_against_plain_counts(docs, empty, held):
    out = score_documents(docs, batch_bytes=3000).collect()
    crc = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t in held]
    c = collections.Counter(w for (d, _), ts in zip(held, tokens, strict=True) if crc(d) != 2 for w in ts)
    n, v = sum(c.values()), len(c)
    want = sorted([(d, crc(d) == 2, len(ts), sum(c[w] > 0 for w in ts), n, f"{sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts):.4f}") for (d, _), ts in zip(held, tokens, strict=True)], key=key)
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.4f}") for r in out], key=key) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert score_documents(empty).count() == 0
    # batches of any size count the same
    again = score_documents(docs, batch_bytes=10**6).collect()
    for r, s in zip(sorted(out, key=key), sorted(again, key=key), strict=True):
        assert r.base_score == pytest.approx(s.base_score) and r.score == pytest.approx(s.score, rel=1e-6)


def interpolated_by_hand(held):
    """(id, score) by plain counts of words and pairs, and the same expectation-maximisation on a
    list of held-out tokens."""
    crc = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7
    texts = [(crc(d), [b"\n", *(t or "").encode().lower().split(), b"\n"]) for d, t in held]

    def counted(use):
        pairs = collections.Counter(p for c, w in texts if use(c) for p in zip(w, w[1:]))  # noqa: B905
        words = collections.Counter()
        for (_, b), n in pairs.items():
            words[b] += n
        return words, pairs, sum(words.values())

    bucket = lambda n: min(math.ceil(math.log2(n + 1)), 31)
    binned = lambda p: 10 ** -((min(max(math.floor(-10 * math.log10(p)), 0), 119) + 0.5) / 10) if p > 0 else 0.0
    words, pairs, n = counted(lambda c: c not in (2, 3))
    uniform = 1 / (len(words) + 1)
    cells = collections.Counter()
    for c, w in texts:
        if c == 3:
            for a, b in zip(w, w[1:]):  # noqa: B905
                cells[bucket(words[a]), binned(pairs[a, b] / max(words[a], 1)), binned(words[b] / max(n, 1))] += 1
    weights = {k: [1 / 3] * 3 for k in range(32)}
    weights[0] = [0, 0.5, 0.5]
    for _ in range(60):
        mass = {k: [1e-3 * x for x in weights[k]] for k in weights}
        for (k, p2, p1), m in cells.items():
            terms = [weights[k][0] * p2, weights[k][1] * p1, weights[k][2] * uniform]
            for i, x in enumerate(terms):
                mass[k][i] += m * x / max(sum(terms), 1e-300)
        weights = {k: [x / sum(m) for x in m] for k, m in mass.items()}
    weights = {k: [max(x, 1e-9) for x in w] for k, w in weights.items()}
    words, pairs, n = counted(lambda c: c != 2)
    out = []
    for (d, _), (_, w) in zip(held, texts, strict=True):
        score = 0.0
        for a, b in zip(w, w[1:]):  # noqa: B905
            l2, l1, l0 = (x / sum(weights[bucket(words[a])]) for x in weights[bucket(words[a])])
            score += math.log10(l2 * pairs[a, b] / max(words[a], 1) + l1 * words[b] / max(n, 1) + l0 / (len(words) + 1))
        out.append((d, score))
    return sorted(out, key=key)


def test_interpolated_scores_by_hand(docs, held):
    got = sorted([(r.doc_id, r.score) for r in score_documents(docs, batch_bytes=50_000).collect()], key=key)
    want = interpolated_by_hand(held)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-6)


@needs_tables
def test_language_model_is_better_than_its_base(spark):
    r = score_documents(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


@pytest.mark.parametrize("kinds", [3, 130, 200])
def test_viterbi_is_the_best_path(kinds):
    rng = np.random.default_rng(0)
    sizes = rng.integers(0, 200, 8)
    s = rng.normal(size=(sizes.sum(), kinds)).astype(np.float32)
    path, at = viterbi(s, sizes, 2.0), 0
    for n in sizes:
        v = s[at].astype(float) if n else 0
        for t in range(at + 1, at + n):
            v = np.maximum(v, v.max() - 2) + s[t]
        if n:
            p = path[at : at + n]
            assert s[np.arange(at, at + n), p].sum() - 2 * (np.diff(p) != 0).sum() == pytest.approx(v.max(), abs=1e-3)
        at += n


def language_by_hand(text, model, penalty=6.0):
    """Language and score by a loop over words and their n-grams, and a plain Viterbi."""
    from recordmill.llm.language_id import CELL_BITS, script

    letter_runs = lambda w: "".join(c if c.isalpha() else " " for c in w).split()
    words, letters = [letter_runs(w) for w in (text or "").lower().split()], []
    best, back = np.zeros(len(model.languages)), []
    for k, parts in enumerate(words):
        data = (" " + " ".join(parts) + " ").encode()
        grams = [data[i : i + n] for n in (1, 2, 3, 4) for i in range(len(data) - n + 1)]
        grams = [g for g in grams if b" " not in g[1:-1] and not (len(g) < 3 and g.strip() == b"")]
        letters.append(sum(map(len, parts)))
        own = np.zeros(len(model.languages))
        if grams:
            cells = []
            for g in grams:
                value = len(g)
                for byte in g:
                    value = value << 8 | byte
                cells.append((value * 0x9E3779B97F4A7C15 % 2**64) >> (64 - CELL_BITS))
            own = model.log_p[cells].astype(float).mean(0) * min(letters[-1], 12)
        if parts:
            own = own - np.where(model.allowed[script(parts[0])], 0, 100)
        came = [max(range(len(best)), key=lambda i: best[i] - penalty * (i != j)) for j in range(len(best))] if k else list(range(len(best)))  # noqa: B023
        best = np.array([best[i] - (penalty * (i != j) if k else 0) for j, i in enumerate(came)]) + own
        back.append(came)
    if not sum(letters):
        return "und", 0.0
    at, share = int(best.argmax()), collections.Counter()
    for k in range(len(words) - 1, -1, -1):
        share[at] += letters[k]
        at = back[k][at]
    top = max(range(len(best)), key=lambda i: (share[i], -i))
    return model.languages[top], share[top] / sum(letters)


@needs_tables
def test_language_id_by_hand(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150")
    model = fit(rows)
    odd = spark.createDataFrame([("\u00bd \u00b2 \u2167 \u2460 12 !?",), ("\u00bd cup of flour",), ("x",), ("\u65e5\u672c \u0442\u0435\u043a\u0441\u0442 the und der",), (None,), ("",)], "text string")
    texts = rows.select("text").union(odd)
    for r in identify(texts, model, keep=("text",)).collect():
        want = language_by_hand(r.text, model)
        assert (r.lang_pred, r.score) == (want[0], pytest.approx(want[1], abs=1e-9)), r.text
    only = identify(odd.limit(1), model).first()
    assert (only.lang_pred, only.score, only.spans) == ("und", 0.0, [])


def test_sample_holds_every_language(spark):
    rows = spark.range(4000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") < 3, "rare").otherwise("often").alias("lang"))
    model = fit(rows, sample_rows=100)
    assert model.languages == ["often", "rare"]


@needs_tables
def test_language_id_on_held_out_texts(spark, docs, empty):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    out = F.pmod(crc32_of("doc_id"), F.lit(4)) == 2
    model = fit(rows.where(~out))
    r = identify(rows, model, keep=(F.col("lang"), out.alias("held_out"))).where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert r >= 0.97
    odd = {(x.doc_id, x.text): x for x in identify(docs, model, keep=(F.col("doc_id"), F.col("text"))).collect()}
    assert len(odd) == docs.count() - 1
    for (_, text), x in odd.items():
        if not any(c.isalpha() for c in text or ""):
            assert (x.lang_pred, x.score, x.spans) == ("und", 0.0, [])
        else:
            assert x.lang_pred in model.languages and 0 < x.score <= 1 and x.spans[-1].last == len(text.split()) - 1
    assert identify(empty, model).count() == 0
    nothing = fit(rows.limit(0))
    assert {x.lang_pred for x in identify(docs, nothing).collect()} == {"und"}
    half = spark.createDataFrame([(" ".join(x.text for x in rows.where(f"lang = '{k}'").limit(3).collect()),) for k in ("de", "fr")], "text string")
    both = half.agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    assert {s.lang for s in identify(both, model).first().spans} >= {"de", "fr"}


def quality_by_hand(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, again = collections.defaultdict(list), set()
    for i in range(len(w) - 2):
        seen[tuple(w[i : i + 3])].append(i)
    for at in seen.values():
        if len(at) > 1:
            again.update(k for i in at for k in (i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)


def test_quality_by_hand(docs, empty, held):
    out = assess(docs, keep=(F.col("doc_id"), F.col("text"))).collect()
    assert len(out) == len(held)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == quality_by_hand(r.text)
        assert not (r.kept and r.base_failed) and (r.clean_text is not None) == r.kept
    lines = {"Datenschutzerkl\u00e4rung": False, "Cliquez ici pour la suite": False, "Todos los derechos reservados": False, "=== * ===": False, "Es war einmal ein K\u00f6nig.": True, "- - x - -": False}
    base = " ".join(f"w{i}" for i in range(60))
    got = {r.line: r.clean_text == base + "\n" + r.line for r in assess(docs.sparkSession.createDataFrame([(x, base + "\n" + x) for x in lines], "line string, text string"), keep=("line",)).collect()}
    assert got == lines
    assert not any(r.kept for r in out if "%%%" in (r.text or "") or "MENU" in (r.text or ""))
    assert assess(empty).count() == 0
    assert assess(docs, keep=(F.col("doc_id"),)).where("kept").count() == sum(r.kept for r in out)


@needs_tables
@pytest.mark.parametrize(("sql", "run"), [(NEAR_SQL, near_duplicates), (REPEATS_SQL, lambda d: remove_repeats(d, rule=Rule(400), passages=Rule(50, "words")).drop("clean_text", "spans")), (QUALITY_SQL, lambda d: assess(d, keep=(F.col("doc_id"),)).drop("lost_share", "clean_text")), (LICENCE_SQL, lambda d: scan(d, corpus_path()))])
def test_against_sql(spark, sql, run):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(sql).df()
    got = run(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    line = lambda df: sorted(tuple("" if v is None or v != v else f"{v:.5f}" if isinstance(v, float) else str(v) for v in r) for r in df[sorted(df.columns)].astype(object).values.tolist())
    assert line(got) == line(want)


def test_licences(spark, docs, empty):
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n\ncode"
    mit = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice'
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "code"), ("a/b/c/y.py", "Licensed under the Apache License, Version 2.0.\ncode"), ("z.py", "code"), (None, None), ("a/b/NOTICE.txt", "nothing here")]
    rows += [("g/wrapped.py", gpl), ("g/tag.c", "// SPDX-License-Identifier: MPL-2.0\nint x;"), ("g/inline.txt", "Some prose comes first. Then more of it! Released under the MIT License. And a last sentence."), ("m/COPYING", mit), ("m/deep/er/file", "text"), ("g/first.txt", "The MIT License (MIT)\nCopyright (c) somebody"), ("g/first.txt", "The MIT License (MIT)\nCopyright (c) somebody")]
    got = {r.path: (r.licence, r.origin) for r in scan(spark.createDataFrame(rows, "p string, text string"), F.col("p"), keep=("p",)).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "file"), "a/b/x.py": ("MIT", "inherited"), "a/b/c/y.py": ("Apache-2.0", "header"), "z.py": (None, "none"), "": (None, "none"), "a/b/NOTICE.txt": ("MIT", "inherited"),
        "g/wrapped.py": ("GPL-3.0", "header"), "g/tag.c": ("MPL-2.0", "header"), "g/inline.txt": ("MIT", "header"), "m/COPYING": ("MIT", "file"), "m/deep/er/file": ("MIT", "inherited"), "g/first.txt": ("MIT", "header"),
    }
    assert scan(docs, F.col("source")).count() == docs.count() and scan(empty, F.col("source")).count() == 0
    assert scan(docs.withColumn("score", F.lit("mine")), F.col("source"), keep=("score", "doc_id")).columns[:2] == ["input_score", "doc_id"]
