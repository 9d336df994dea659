"""Byte-pair encoding by per-prefix dynamic programming, over batches of distinct words.

``PrefixEncoder`` stores for every prefix of a word the one token that ends its encoding: the
candidates are the vocabulary entries that a suffix-link automaton finds to end there, and a
candidate is taken if it is compatible with the last token of the prefix before it. Words come from
a pre-tokenizer and are cached, so the work of a task follows its distinct words.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import regex

NONE = np.int32(2**31 - 1)
#: Words of more bytes are encoded alone, in time linear (or n log n) in their length.
LONG_WORD = 64
#: Cells of the matrix that one pass over words fills.
CELLS = 1 << 19


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(spare)) for b in range(256)]


class PairMap:
    """(left id, right id) -> value for whole arrays; open addressing with a short probe chain."""

    BITS = 20

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> None:
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.values = np.full(1 << self.BITS, NONE, np.int32)
        todo = (left.astype(np.int64) << 20) | right.astype(np.int64)
        slot, value = self.slots(todo), value.astype(np.int32)
        while len(todo):
            free = self.keys[slot] == -1
            at, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[at >= 0]
            self.keys[slot[first]], self.values[slot[first]] = todo[first], value[first]
            rest = np.ones(len(todo), bool)
            rest[first] = False
            todo, value, slot = todo[rest], value[rest], slot[rest]
            slot = np.where(self.keys[slot] == -1, slot, (slot + 1) & ((1 << self.BITS) - 1))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 20) | right.astype(np.int64)
        slot = self.slots(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.BITS) - 1)
            seen = self.keys[slot[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return out


class Vocabulary:
    """A tokenizer file: tokens in merge order. Inner ids: single symbols first, then merges."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        shown = byte_symbols()
        singles = shown + ([c + self.end for c in shown] if self.end else [])
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        inner = {s: i for i, s in enumerate(singles)}
        left, right, made = [], [], []
        strings = list(singles)
        for a, b in merges:
            new = a + b
            if new not in inner:
                inner[new] = len(strings)
                strings.append(new)
            left.append(inner[a])
            right.append(inner[b])
            made.append(inner[new])
        self.n_single, self.strings, self.inner = len(singles), strings, inner
        self.outer = np.array([self.vocab.get(s, -1) for s in strings], np.int64)
        self.left, self.right = np.full(len(strings), -1, np.int32), np.full(len(strings), -1, np.int32)
        self.left[made], self.right[made] = left, right
        #: Value: the place of the merge in the list, and what it makes.
        self.rank = PairMap(np.array(left), np.array(right), np.arange(len(merges)))
        self.made = np.array(made, np.int32)
        back = {c: b for b, c in enumerate(shown)}
        self.bytes_of = [bytes(back[c] for c in (s.removesuffix(self.end) if self.end else s)) for s in strings]
        #: As bytes_of; the last byte of a word is a symbol of its own where words have an end mark.
        self.symbols_of = [[*b[:-1], b[-1] + 256] if self.end and s.endswith(self.end) else list(b) for s, b in zip(strings, self.bytes_of, strict=True)]


def by_length(words: list[bytes], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Groups of words as matrices of bytes (padded with -1), each with the words' places."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    order = order[(sizes[order] > 0) & (sizes[order] <= width)]
    flat = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
    out, at, k = [], 0, 0
    while k < len(order):
        rows = max(1, CELLS // int(sizes[order[k]]))
        part = order[k : k + rows]
        top = int(sizes[part[-1]])
        cells = np.full((len(part), top), -1, np.int32)
        n = int(sizes[part].sum())
        cells[np.arange(top)[None, :] < sizes[part][:, None]] = flat[at : at + n]
        out.append((part, cells))
        at, k = at + n, k + len(part)
    return out


class PrefixEncoder:
    """The last token of every prefix, by suffix-link matches and pair compatibility."""

    MEMO = 1 << 18

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        tokens = v.symbols_of
        edge: dict[int, int] = {}
        node_token, node_byte, node_up, depth = [-1], [0], [0], [0]
        for t, text in enumerate(tokens):
            at = 0
            for c in text:
                nxt = edge.get(at << 9 | c)
                if nxt is None:
                    nxt = edge[at << 9 | c] = len(node_token)
                    node_token.append(-1)
                    node_byte.append(c)
                    node_up.append(at)
                    depth.append(depth[at] + 1)
                at = nxt
            node_token[at] = t
        link = [0] * len(node_token)
        for node in sorted(range(1, len(node_token)), key=depth.__getitem__):
            if depth[node] > 1:
                at = link[node_up[node]]
                while at and (at << 9 | node_byte[node]) not in edge:
                    at = link[at]
                link[node] = edge.get(at << 9 | node_byte[node], 0)
        #: Longest vocabulary entry that ends at a state; next shorter entry that ends an entry.
        ends = [-1] * len(node_token)
        shorter = [-1] * len(tokens)
        for node in sorted(range(1, len(node_token)), key=depth.__getitem__):
            if node_token[node] >= 0:
                ends[node] = node_token[node]
                shorter[node_token[node]] = ends[link[node]]
            else:
                ends[node] = ends[link[node]]
        keys = np.fromiter(edge, np.int64, len(edge))
        self.edge = PairMap(keys >> 9, keys & 511, np.fromiter(edge.values(), np.int64, len(edge)))
        self.link, self.ends, self.shorter = np.array(link, np.int32), np.array(ends, np.int32), np.array(shorter, np.int32)
        self.size = np.fromiter(map(len, tokens), np.int32, len(tokens))
        #: Direct-mapped memo of compatibility: bounded, a clash is computed again.
        self.memo_key, self.memo = np.full(self.MEMO, -1, np.int64), np.zeros(self.MEMO, bool)

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the border between tokens x and y stands when both are encoded together."""
        key = (x.astype(np.int64) << 20) | y
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)
        out, new = self.memo[slot], np.flatnonzero(self.memo_key[slot] != key)
        if len(new):
            some, back = np.unique(key[new], return_inverse=True)
            held = self.border_stands((some >> 20).astype(np.int32), (some & ((1 << 20) - 1)).astype(np.int32))
            out[new] = held[back]
            self.memo_key[slot[new]], self.memo[slot[new]] = key[new], out[new]
        return out

    def border_stands(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Undo the latest merge on either side of the border again and again; the border falls if
        a merge across it came before the one undone. Of equal merges the left one is first."""
        out, live = np.ones(len(x), bool), np.arange(len(x))
        before = np.full(len(x), NONE, np.int32)
        while len(live):
            rank = self.v.rank(x, y)
            across = np.where(rank == NONE, NONE, self.v.made[np.where(rank == NONE, 0, rank)])
            falls = across < before
            out[live[falls]] = False
            on = ~falls & (np.maximum(x, y) >= self.v.n_single)
            x, y, live = x[on], y[on], live[on]
            left = x > y
            before = np.where(left, x, y + 1).astype(np.int32)
            x, y = np.where(left, self.v.right[x], x), np.where(left, y, self.v.left[y])
        return out

    def matrix(self, cells: np.ndarray) -> np.ndarray:
        """last[w, i]: the token that ends the encoding of the first i bytes of word w."""
        n, width = cells.shape
        last = np.full((n, width + 1), -1, np.int32)
        state = np.zeros(n, np.int32)
        for i in range(width):
            live = np.flatnonzero(cells[:, i] >= 0)
            c, at = cells[live, i], state[live]
            to = self.edge(at, c)
            while len(lost := np.flatnonzero(to == NONE)):
                at[lost] = self.link[at[lost]]
                to[lost] = self.edge(at[lost], c[lost])
            state[live] = to
            token = self.ends[to]
            while len(live):
                start = i + 1 - self.size[token]
                ok = start == 0
                rest = np.flatnonzero(~ok)
                ok[rest] = self.compatible(last[live[rest], start[rest]], token[rest])
                last[live[ok], i + 1] = token[ok]
                live, token = live[~ok], self.shorter[token[~ok]]
        return last

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and how many each word has."""
        long = [i for i, w in enumerate(words) if len(w) > LONG_WORD]
        alone = [self.one(words[i]) for i in long]
        places, flats, sizes = [np.array(long, np.int64)], alone, [np.fromiter(map(len, alone), np.int64, len(alone))]
        for at, cells in by_length(words, LONG_WORD):
            left = (cells >= 0).sum(1)
            if self.v.end:
                cells[np.arange(len(cells)), left - 1] += 256
            last = self.matrix(cells)
            path = np.full(cells.shape, -1, np.int32)
            live, k = np.arange(len(cells)), cells.shape[1]
            while len(live):
                k -= 1
                token = last[live, left[live]]
                path[live, k] = token
                left[live] -= self.size[token]
                live = live[left[live] > 0]
            places.append(at)
            flats.append(path[path >= 0])
            sizes.append((path >= 0).sum(1))
        place, size = np.concatenate(places), np.concatenate(sizes)
        full = np.zeros(len(words), np.int64)
        full[place] = size
        start = np.zeros(len(words), np.int64)
        start[place] = np.cumsum(size) - size
        flat = np.concatenate(flats) if flats else np.zeros(0, np.int64)
        return self.v.outer[spread(flat, start, full)], full

    def one(self, word: bytes) -> np.ndarray:
        """A single long word, byte by byte."""
        v, last, state = self.v, [-1], 0
        if not hasattr(self, "steps"):
            self.steps, self.stands = {}, {}
        symbols = [*word[:-1], word[-1] + 256] if v.end else list(word)
        for i, c in enumerate(symbols, 1):
            key = state << 9 | c
            if key not in self.steps:
                at, to = state, NONE
                while (to := int(self.edge(np.array([at]), np.array([c]))[0])) == NONE:
                    at = int(self.link[at])
                self.steps[key] = to
            state = self.steps[key]
            token = int(self.ends[state])
            while (start := i - int(self.size[token])) > 0:
                pair = last[start] << 20 | token
                if pair not in self.stands:
                    self.stands[pair] = bool(self.border_stands(np.array([last[start]]), np.array([token]))[0])
                if self.stands[pair]:
                    break
                token = int(self.shorter[token])
            last.append(token)
        path, at = [], len(word)
        while at:
            path.append(last[at])
            at -= int(self.size[last[at]])
        if len(self.steps) + len(self.stands) > 1_000_000:
            del self.steps, self.stands
        return np.array(path[::-1])


def spread(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start : start + size] of every row, one after another."""
    return flat[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


class Numbered(dict):
    """Numbers new keys as they are asked for, and notes them."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self.new.append(key)
        self[key] = n = len(self)
        return n


class Cache:
    """key -> ids, bounded: beyond ``limit`` keys it starts anew. Misses are encoded together."""

    def __init__(self, encode_new, limit: int = 600_000) -> None:
        self.encode_new, self.limit = encode_new, limit
        self.clear()

    def clear(self) -> None:
        self.index = Numbered()
        self.flat, self.starts, self.sizes, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), 0

    def ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all keys one after another, and how many each key has."""
        if len(self.index) > self.limit:
            self.clear()
        index, n = self.index, len(self.index)
        at = np.fromiter(map(index.__getitem__, keys), np.int64, len(keys))
        if new := index.new:
            ids, sizes = self.encode_new(new)
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while n + len(new) > len(self.starts):
                self.starts, self.sizes = np.concatenate([self.starts, np.zeros_like(self.starts)]), np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.flat[self.used : self.used + len(ids)] = ids
            self.starts[n : n + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.sizes[n : n + len(new)] = sizes
            self.used += len(ids)
            index.new = []
        sizes = self.sizes[at].astype(np.int64)
        return spread(self.flat, self.starts[at], sizes), sizes

    def of_lists(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """As ids(), for lists of keys: how many ids each list has."""
        ids, sizes = self.ids(list(chain.from_iterable(lists)))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))])]
        return ids, np.diff(ends)


#: Fixed pattern of the byte-level pre-tokenizer.
BYTE_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Fixed pattern of the word pre-tokenizer.
WORD_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
