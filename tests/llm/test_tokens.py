import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from recordmill.llm.bpe_codec import decode_documents, encode_documents, round_trip_digests
from recordmill.llm.packing import best_fit, dominant_sets, pack, solve
from recordmill.llm.token_counts import count_tokens


def tokenizer(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_padding()
    t.no_truncation()
    return t


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def test_counts_equal_the_library(docs, empty, held, tmp_path):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted([(d, len((t or "").encode()), n := len(sp.encode(t or "")), n > 100) for d, t in held], key=key)
    cache = "file://" + str(tmp_path / "cache")
    for _ in range(2):  # the second time all counts come from the cache
        assert sorted(map(tuple, count_tokens(docs, path, cache=cache, limit=100).collect()), key=key) == want
    stored = docs.sparkSession.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in held})
    assert count_tokens(empty, path).count() == 0
    # another tokenizer has counts of its own in the same cache
    other = public_tokenizers.path("byte_bpe_50k.json")
    tk = tokenizer("byte_bpe_50k.json")
    got = {(r.doc_id, r.n_tokens) for r in count_tokens(docs, other, cache=cache).collect()}
    assert got == {(d, len(tk.encode(t or "", add_special_tokens=False))) for d, t in held}


def test_codec_equals_the_library(docs, empty, held):
    path, tk = public_tokenizers.path("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.json")
    extra = docs.sparkSession.createDataFrame([(900, "a<|endoftext|> b  <|endoftext|>"), (901, "it's  we'll \n\n x " + "q" * 300)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra)
    want = []
    for d, t in [*held, *[(r.doc_id, r.text) for r in extra.collect()]]:
        ids = tk.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, round_trip_digests(rows, path).collect()), key=key) == sorted(want, key=key)
    back = decode_documents(encode_documents(rows, path), path)
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=key) == sorted([(r.doc_id, r.text or "") for r in rows.collect()], key=key)
    assert round_trip_digests(empty, path).count() == 0


def test_packing(docs, empty, held):
    path, tk = public_tokenizers.path("word_bpe_49k.json"), tokenizer("word_bpe_49k.json")
    out = pack(docs, path, capacity=256, end_id=0).toPandas()
    want = {}
    for d, t in held:
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), 256)):
            one = (d, k, s, len(ids[s : s + 256]), zlib.crc32(ids[s : s + 256].tobytes()))
            want[one] = want.get(one, 0) + 1
    got = {}
    for r in out.itertuples():
        one = (None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
        got[one] = got.get(one, 0) + 1
    assert got == want
    total = 0
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.cumsum(g.length) - g.length).all() and g.length.sum() <= 256
        total += 1
    assert total <= -(-int(out.length.sum()) // 256) * 1.1 + 1
    assert pack(empty, path).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_solver_places_every_piece_and_fixes_only_dominant_sets(seed):
    import itertools
    import random

    rng = random.Random(seed)
    counts = {}
    for _ in range(rng.randrange(1, 9)):
        x = rng.randint(1, 12)
        counts[x] = counts.get(x, 0) + 1
    placed = {}
    patterns = solve(counts, 12)
    for p in patterns:
        assert sum(p.lengths) <= 12
        for x in p.lengths:
            placed[x] = placed.get(x, 0) + p.bins
    assert placed == counts

    def fewest(items, n):
        """Whether the items fit into n bins, by trying all ways."""
        def go(i, rooms):
            if i == len(items):
                return True
            return any(r >= items[i] and go(i + 1, sorted([*rooms[:k], r - items[i], *rooms[k + 1 :]])) for k, r in enumerate(rooms) if k == 0 or rooms[k - 1] != r)
        return go(0, [12] * n)

    items = sorted(itertools.chain.from_iterable([k] * n for k, n in counts.items()), reverse=True)
    best = next(n for n in range(1, len(items) + 1) if fewest(items, n))
    fixed, rest = dominant_sets(counts, 12)
    left = sorted(itertools.chain.from_iterable([k] * n for k, n in rest.items()), reverse=True)
    tail = next((n for n in range(1, len(left) + 1) if fewest(left, n)), 0) if left else 0
    assert sum(p.bins for p in fixed) + tail == best  # the reduction costs nothing
    assert sum(p.bins for p in patterns) <= best * 11 / 9 + 1
    assert sum(p.bins for p in best_fit(counts, 12)) >= best


def test_hot_length(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    out = pack(rows, public_tokenizers.path("word_bpe_49k.json"), capacity=9)
    assert out.select("sequence_id").distinct().count() == 1000 and out.groupBy("sequence_id", "offset").count().where("count > 1").isEmpty()


def test_two_beside_the_longest_are_fixed():
    kept = lambda counts: [(p.lengths, p.bins) for p in dominant_sets(counts, 100)[0]]
    assert kept({60: 1, 35: 1, 18: 1, 17: 1}) == [([60, 35], 1), ([18, 17], 1)]
    assert kept({55: 2, 21: 4}) == [([55, 21, 21], 2)]
    assert kept({60: 1, 22: 1, 20: 2, 15: 1})[:1] != [([60, 22, 15], 1)]  # 20 and 20 fit as well
