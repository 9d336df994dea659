"""Fill-in-middle, spelling variants and one-permutation MinHash against plain loops and SQL."""

import collections
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recordmill.llm import fill_middle, minhash_dedup, queries
from recordmill.llm.fill_middle import fill_in_middle, rebuilt, restored
from recordmill.llm.minhash_dedup import minhash_components, signature
from recordmill.llm.spelling import variants

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- fill in the middle


def middle_by_hand(text, doc_id):
    text, doc_id = text or "", "" if doc_id is None else str(doc_id)
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest, n = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest(), len(tokens)
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle_equals_a_plain_loop(docs, empty, held):
    out = restored(fill_in_middle(docs)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored")
    assert rows(out) == sorted([(d, *middle_by_hand(t, d), t or "") for d, t in held], key=str)
    assert restored(fill_in_middle(empty)).count() == 0


def test_fill_in_middle_of_odd_texts(spark):
    odd = ["a <M> b", "\t\t", " x", "x ", "x<", "<P", "<S<", "😀 é　z \x1c q", None, "", "a\r\n\r\nb " * 3, "w " * 200_000]
    made = [(i, t) for i in range(60) for t in odd[:-1]] + [(1, odd[-1]), (3, odd[-1])]
    df = spark.createDataFrame(made, "doc_id long, text string")
    out = restored(fill_in_middle(df)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored")
    assert rows(out) == sorted([(d, *middle_by_hand(t, d), t or "") for d, t in made], key=str)
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert rebuilt("as it is", "plain") == "as it is"


def test_fill_in_middle_keeps_columns_of_its_own_names(docs):
    out = restored(fill_in_middle(docs.withColumn("n", F.lit("mine")).withColumn("output", F.lit(1)), keep=("doc_id", "n", "output")))
    assert out.columns == ["doc_id", "input_n", "input_output", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert {r.input_n for r in out.collect()} == {"mine"}


# ---- spelling variants


def near_by_hand(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(held, min_count=5, min_chars=6, modulus=199):
    count = collections.Counter()
    for d, t in held:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % modulus == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if c >= min_count and len(w) >= min_chars}
    form, near = {}, {}
    for w in n:
        others = sorted((x for x in n if near_by_hand(w, x)), key=lambda x: (-n[x], x))
        near[w], form[w] = len(others), others[0] if others and n[others[0]] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted([(w, form[w], root(w), n[w], near[w], n[form[w]] if form[w] else None) for w in n], key=str)


def test_spelling_variants_equal_a_plain_loop(spark, docs, empty, held):
    assert rows(variants(docs, min_count=2, min_chars=2, modulus=7)) == variants_by_hand(held, 2, 2, 7)
    assert variants(empty).count() == 0
    # chains of forms, doubled letters, ties, letters beyond ASCII, and one very long word
    rng, made = random.Random(1), []
    base = ["letters", "balloon", "aaaaaaa", "mississippi", "élève-à-çÀÉ", "straße", "x" * 3000, "abababab"]
    for w in base:
        made += [w] * 700
        for _ in range(12):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abexé") + w[k:], w[:k] + rng.choice("abexé") + w[k + 1 :]])
            made += [v] * rng.choice([5, 5, 6, 30, 130])
            k = rng.randrange(len(v))
            made += [v[:k] + v[k + 1 :]] * rng.choice([1, 5, 20])
    rng.shuffle(made)
    lines = [(i, " ".join(made[i * 50 : i * 50 + 50]) + (" Upper ÉCOLE÷×" * 3 if i % 3 else "")) for i in range(len(made) // 50 + 1)]
    df = spark.createDataFrame(lines, "doc_id long, text string")
    want = variants_by_hand(lines)
    assert rows(variants(df)) == want
    assert any(r[1] and r[2] != r[1] for r in want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not there")
def test_spelling_variants_of_the_table(spark):
    held = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.op12_spelling_variants(spark, SF)) == variants_by_hand(held)


# ---- MinHash


def shingles(text, k=3):
    w = [re.sub(b"[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components_by_hand(held):
    sets, root = [shingles(t) for _, t in held], list(range(len(held)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(held)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(held):
        if d is not None:
            ids[find(i)].append(d)
    least = [min(ids[find(i)], default=None) for i in range(len(held))]
    return sorted([(d, len(sets[i]), least[i], least[i] is None or d == least[i]) for i, (d, _) in enumerate(held)], key=str)


def test_minhash_components_equal_brute_force(docs, empty, held):
    assert rows(minhash_components(docs)) == components_by_hand(held)
    assert minhash_components(empty).count() == 0


def edited(rng, words, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"w{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("block", [4_000_000, 20_000])
def test_minhash_components_near_the_threshold(spark, monkeypatch, block):
    """Copies of copies: links that no star of a bucket's least text would find."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", block // 4000)
    rng, made = random.Random(3), []
    for g in range(12):
        words = [f"g{g}w{k}" for k in range(rng.choice([8, 20, 60, 300]))]
        for _ in range(14):
            made.append(" ".join(words))
            words = edited(rng, words, max(1, len(words) // rng.choice([20, 40, 60])))
        hub = [f"h{g}w{k}" for k in range(100)]
        made += [" ".join(edited(rng, hub, rng.choice([1, 2, 3]))) for _ in range(8)] + [" ".join(hub)] * (g % 3)
    rng.shuffle(made)
    held = list(enumerate(made)) + [(None, made[0]), (3, made[3].upper()), (None, "only one"), (None, "Only  ONE")]
    df = spark.createDataFrame(held, "doc_id long, text string").repartition(5)
    assert rows(minhash_components(df)) == components_by_hand(held)


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(2)
    for n in (6, 40, 400, 4000):
        errors = []
        for _ in range(30):
            x = rng.integers(0, 2**63, n, dtype=np.uint64)
            y = x.copy()
            y[: max(1, n // 12)] = rng.integers(0, 2**63, max(1, n // 12), dtype=np.uint64)
            same = n - max(1, n // 12)
            errors.append((signature(np.unique(x)) == signature(np.unique(y))).mean() - same / (2 * n - same))
        assert abs(np.mean(errors)) < 0.03


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not there")
@pytest.mark.parametrize("name", ["op11_minhash_near_dedup", "op13_fill_in_middle"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    assert rows(got.select(names)) == sorted(map(tuple, con.sql(f"SELECT {', '.join(names)} FROM want").fetchall()), key=str)
