"""Language of documents and of spans in them.

The script of a word narrows the languages it can have; character n-grams give each of these a log
probability; Viterbi with a penalty for every switch labels the words of a text, so a text in two
languages comes out as spans. A text is of the language that most of its letters are labelled with.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.bpe import Numbered
from recordmill.llm.common import arrow_map, quoted, set_aside

#: First code points of ranges of letters and the script from there on.
SCRIPTS = [(0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"), (0x780, "Other"), (0x900, "Devanagari"), (0x980, "Indic"), (0xE00, "Thai"), (0xE80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x30000, "Other")]
FIRST = [x for x, _ in SCRIPTS]
NAMES = sorted({x for _, x in SCRIPTS})
#: What the word class of expressions has besides letters, digits and the underscore: fractions, Roman numerals and the like.
NUMBERS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
LETTERS, PLAIN_LETTERS = re.compile(rf"[^\W\d_{''.join(sorted(NUMBERS))}]+"), re.compile(r"[^\W\d_]+")
#: N-grams are counted in so many cells; bounds the model whatever it learns from.
CELL_BITS = 16
CELLS = 1 << CELL_BITS
BLOCK = 64


def letters_in(text: str) -> re.Pattern:
    """The expression for runs of letters in this text: the short one is faster, and right without such numbers."""
    return PLAIN_LETTERS if NUMBERS.isdisjoint(text) else LETTERS


def script(word: str) -> str:
    return SCRIPTS[bisect_right(FIRST, ord(word[0])) - 1][1]


def gram_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the n-grams of 1 to 4 bytes of all words, borders included, and each one's word.
    A word may be several parts with a space between; no n-gram goes over a space."""
    texts = [f" {w} ".encode("utf-8", "replace") for w in words]
    data = np.frombuffer(b"".join(texts) + b"    ", np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    n = len(word)
    space = data == 32
    cells, owners = [], []
    for k in (1, 2, 3, 4):
        value = np.full(n, k, np.uint64)
        inside = np.ones(n, bool)
        for i in range(k):
            value = value << np.uint64(8) | data[i : i + n]
            if 0 < i < k - 1:
                inside &= ~space[i : i + n]
        inside &= ~(space[:n] & space[k - 1 : k - 1 + n]) if k < 3 else True
        at = np.flatnonzero(inside[: n - k + 1])
        at = at[word[at] == word[at + k - 1]]
        cells.append((value[at] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - CELL_BITS)).astype(np.int64))
        owners.append(word[at])
    return np.concatenate(cells), np.concatenate(owners)


@dataclass
class Model:
    """log_p: a row per cell, a column per language. allowed: languages of each script."""

    languages: list[str]
    log_p: np.ndarray
    allowed: dict[str, np.ndarray]


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = 20_000, alpha: float = 0.5) -> Model:
    """Learns from a sample of about ``sample_rows`` rows (the bound of what is read into counts), as
    many of each language or all that it has, drawn by a hash of id and text. Rows without text or
    language teach nothing. The driver gets one number per language, then one row per language, cell
    and script: at most languages x (CELLS + scripts)."""
    rows = labelled.select(quoted(id_col).cast("string").alias("doc_id"), quoted(text_col).alias("text"), quoted(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    n_of = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if sum(n_of.values()) > sample_rows:
        rate = F.create_map(*[F.lit(x) for lang, n in n_of.items() for x in (lang, min(1.0, sample_rows / len(n_of) / n))])
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**30)) < F.ceil(rate[F.col("lang")] * 2**30))

    def make():
        def step(batch: pa.RecordBatch) -> pa.Table:
            words: dict[str, Counter] = {}
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(letters_in(text).findall(text.lower()))
            out: dict[str, list] = {"lang": [], "kind": [], "cell": [], "n": []}
            for lang, counts in words.items():
                scripts: Counter = Counter()
                for w, k in counts.items():
                    scripts[NAMES.index(script(w))] += k
                cell, word = gram_cells(list(counts))
                sums = np.bincount(cell, np.fromiter(counts.values(), np.float64, len(counts))[word], CELLS)
                cells = {int(g): int(sums[g]) for g in np.flatnonzero(sums)}
                for kind, found in (("gram", cells), ("script", scripts)):
                    out["lang"] += [lang] * len(found)
                    out["kind"] += [kind] * len(found)
                    out["cell"] += list(found)
                    out["n"] += list(found.values())
            return pa.table(out, schema=pa.schema([("lang", pa.string()), ("kind", pa.string()), ("cell", pa.int64()), ("n", pa.int64())]))

        return step

    counts = arrow_map(rows, make, "lang string, kind string, cell long, n long").groupBy("lang", "kind", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    table = np.full((CELLS, len(languages)), alpha)
    at = {x: i for i, x in enumerate(languages)}
    g = counts[counts["kind"] == "gram"]
    table[g["cell"].to_numpy(np.int64), g["lang"].map(at).to_numpy(np.int64)] += g["n"].to_numpy()
    scripts = counts[counts["kind"] == "script"].pivot_table(index="cell", columns="lang", values="n", fill_value=0).reindex(columns=languages, fill_value=0) if len(counts) else None
    allowed = {}
    for name in NAMES:
        share = scripts.loc[NAMES.index(name)].to_numpy() / np.maximum(1, scripts.sum().to_numpy()) if scripts is not None and NAMES.index(name) in scripts.index else np.zeros(len(languages))
        allowed[name] = share >= 0.01 if (share >= 0.01).any() else np.ones(len(languages), bool)
    return Model(languages, np.log(table / table.sum(0)).astype(np.float32) if languages else table, allowed)


class Scorer:
    """Scores of white-space words, cached up to a bound."""

    def __init__(self, model: Model, limit: int = 400_000) -> None:
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.index, self.scores, self.letters = Numbered(), np.zeros((1 << 12, len(self.model.languages)), np.float32), np.zeros(1 << 12, np.int32)

    def of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """For all words of all texts: a row of scores, and the number of letters."""
        if len(self.index) > self.limit:
            self.clear()
        n = len(self.index)
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64)
        while len(self.index) > len(self.letters):
            self.scores, self.letters = np.concatenate([self.scores, np.zeros_like(self.scores)]), np.concatenate([self.letters, np.zeros_like(self.letters)])
        for k in range(0, len(self.index.new), 20_000):
            self.add(n + k, self.index.new[k : k + 20_000])
        self.index.new = []
        return self.scores[at], self.letters[at]

    def add(self, n: int, words: list[str]) -> None:
        runs = letters_in(" ".join(words))
        parts = [runs.findall(w) for w in words]
        letters = np.fromiter((sum(map(len, p)) for p in parts), np.int32, len(parts))
        cells, owner = gram_cells([" ".join(p) for p in parts])
        found = np.maximum(1, np.bincount(owner, minlength=len(words)))
        self.letters[n : n + len(words)] = letters
        # n-grams of a word overlap: their mean, times the letters, is the word's weight
        weight = np.minimum(letters, 12) / found
        for k in range(len(self.model.languages)):
            self.scores[n : n + len(words), k] = np.bincount(owner, self.model.log_p[cells, k], len(words)) * weight
        for name, allowed in self.model.allowed.items():
            if not allowed.all():
                other = [i for i, p in enumerate(parts) if p and script(p[0]) == name]
                self.scores[np.array(other, np.int64) + n] -= np.where(allowed, 0, 100)


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word of texts of these sizes, given word scores.

    Blocks of words are solved side by side for every language that may precede them; chaining the
    blocks of a text and going back through them gives the exact best path.
    """
    kinds = scores.shape[1]
    label = np.min_scalar_type(-kinds)  # one byte up to 128 languages
    blocks = -(-sizes // BLOCK)
    first = np.cumsum(blocks) - blocks
    word = np.arange(len(scores)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    cell = np.repeat(first, sizes) * BLOCK + word
    s = np.zeros((int(blocks.sum()) * BLOCK, kinds), np.float32)
    s[cell] = scores
    s = s.reshape(-1, BLOCK, kinds)
    n = len(s)
    v = np.broadcast_to(np.where(np.eye(kinds, dtype=bool), 0, -penalty).astype(np.float32), (n, kinds, kinds))
    v = v + s[:, 0, None, :]
    jump, source = np.zeros((BLOCK, n, kinds, kinds), bool), np.zeros((BLOCK, n, kinds), label)
    for t in range(1, BLOCK):
        source[t] = v.argmax(2)
        top = v.max(2, keepdims=True) - penalty
        jump[t] = top > v
        v = np.maximum(v, top) + s[:, t, None, :]
    order = np.argsort(-blocks, kind="stable")
    order = order[blocks[order] > 0]
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    state = np.zeros((len(order), kinds), np.float64)
    came = []
    ranked = blocks[order]
    for k in range(int(ranked[0]) if len(order) else 0):
        live = int(np.searchsorted(-ranked, -k, "left"))
        through = state[:live, :, None] + v[first[order[:live]] + k]
        came.append(through.argmax(1))
        state[:live] = through.max(1)
    last = state.argmax(1)
    for k in range(len(came) - 1, -1, -1):
        live = len(came[k])
        at = first[order[:live]] + k
        after[at] = last[:live]
        before[at] = came[k][np.arange(live), last[:live]]
        last[:live] = before[at]
    out, now, rows = np.zeros((n, BLOCK), label), after.copy(), np.arange(n)
    for t in range(BLOCK - 1, 0, -1):
        out[:, t] = now
        now = np.where(jump[t, rows, before, now], source[t, rows, before], now)
    out[:, 0] = now
    return out.reshape(-1)[cell]


def identify(docs: DataFrame, model: Model, *, penalty: float = 6.0, text_col: str = "text", keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """The columns of ``keep``, then lang_pred, score and spans (array of first word, last word,
    language; words are cut at white space).

    score: the share of the letters that are labelled lang_pred; equal shares go to the language
    first in alphabetical order. A null text, a text without a letter, or a model that has learnt
    nothing gives ``und``, 0 and no spans. Each row is judged by its text alone; repeated rows give
    equal results, an empty table gives none. Other columns are ignored; a kept one named like a
    result comes back as input_<name>.
    """
    aside, back = set_aside(docs, keep, ("lang_pred", "score", "spans"))
    source = docs.select(*aside, quoted(text_col).cast("string").alias("__text"))
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))
    names = np.array(model.languages, object)

    def make():
        scorer = Scorer(model)

        def step(batch: pa.RecordBatch) -> pa.Table:
            texts = [(x or "").lower().split() for x in batch.column(batch.num_columns - 1).to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            pred, score, spans = ["und"] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
            if len(names) and sizes.sum():
                scores, letters = scorer.of(texts)
                path = viterbi(scores, sizes, penalty)
                doc = np.repeat(np.arange(len(texts)), sizes)
                share = np.bincount(doc * len(names) + path, letters, len(texts) * len(names)).reshape(-1, len(names))
                total = share.sum(1)
                best = share.argmax(1)
                new = np.flatnonzero(np.diff(doc, prepend=-1).astype(bool) | np.diff(path, prepend=-1).astype(bool))
                begin = np.cumsum(sizes) - sizes
                for a, b in zip(new.tolist(), [*new[1:].tolist(), len(path)], strict=True):
                    d = int(doc[a])
                    if total[d]:
                        spans[d].append({"first": a - int(begin[d]), "last": b - 1 - int(begin[d]), "lang": names[path[a]]})
                for d in np.flatnonzero(total):
                    pred[d], score[d] = names[best[d]], share[d, best[d]] / total[d]
            t = pa.Table.from_batches([batch]).drop_columns(["__text"])
            return t.append_column("lang_pred", pa.array(pred, pa.string())).append_column("score", pa.array(score)).append_column("spans", pa.array(spans, span))

        return step

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return back(arrow_map(source, make, f"{fields + ', ' if fields else ''}lang_pred string, score double, spans array<struct<first:int,last:int,lang:string>>"))
