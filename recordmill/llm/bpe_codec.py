"""Byte-level BPE of whole texts: ids by per-prefix dynamic programming, and back to text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.bpe import BYTE_LEVEL, Cache, PrefixEncoder, Vocabulary
from recordmill.llm.common import arrow_map, text_of

#: A cut before a space between two visible characters never falls inside a pre-token.
MIXED = re.compile(r"\s\s")
CUT = re.compile(r"(?<=\S)(?= \S)")


def chunks(text: str) -> list[str]:
    """The text cut before single spaces; joined, the chunks give the text again."""
    if MIXED.search(text) or text[:1] == " " or text[-1:] == " ":
        return CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]] if first or rest else []


class Codec:
    """Ids of texts as the tokenizer file's library gives them, without begin or end tokens."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.encoder = PrefixEncoder(self.vocabulary)
        self.words = Cache(self.encode_words, 300_000)
        self.chunks = Cache(self.encode_chunks)
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        token_bytes = dict(zip(self.vocabulary.outer.tolist(), self.vocabulary.bytes_of, strict=True))
        token_bytes |= {i: s.encode() for s, i in self.vocabulary.special.items()}
        self.token_bytes = [token_bytes.get(i, b"") for i in range(max(token_bytes) + 1)]

    def encode_chunks(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = self.vocabulary.special
        return self.words.of_lists([[x] if x in special else BYTE_LEVEL.findall(x) for x in some])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = self.vocabulary.special
        ids, sizes = self.encoder.encode([b"" if w in special else w.encode() for w in words])
        if found := [i for i, w in enumerate(words) if w in special]:
            ids = np.insert(ids, np.cumsum(sizes)[found], [special[words[i]] for i in found])
            sizes[found] = 1
        return ids, sizes

    def pieces(self, text: str) -> list[str]:
        if self.special and self.special.search(text):
            return [c for part in self.special.split(text) if part for c in ([part] if part in self.vocabulary.special else chunks(part))]
        return chunks(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, sizes = self.chunks.of_lists([self.pieces(x) for x in texts])
        return np.split(ids, np.cumsum(sizes)[:-1]) if texts else []

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each Python worker: building its automaton takes a second."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def map_ids(docs: DataFrame, tokenizer: str, fn: Callable[[Codec, list, list[str], list[np.ndarray]], dict[str, list]], schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """fn(codec, ids of documents, texts, token ids) -> columns, for batches of documents."""

    def make():
        c = codec(tokenizer)

        def step(batch: pa.RecordBatch) -> pa.Table:
            texts = batch.column(1).to_pylist()
            return pa.table({k: v for k, v in fn(c, batch.column(0), texts, c.encode(texts)).items()})

        return step

    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), make, schema)


def encode_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every text. Null texts count as empty; every row, also a
    repeated one or one with a null id, gives one row; an empty table gives none."""
    return map_ids(docs, tokenizer, lambda c, doc, _, ids: {"doc_id": doc, "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))}, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>", id_col, text_col)


def decode_documents(encoded: DataFrame, tokenizer: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the way back; null ids give a null text."""

    def make():
        c = codec(tokenizer)
        return lambda b: pa.table({"doc_id": b.column(0), "text": pa.array([None if x is None else c.decode(np.asarray(x, np.int64)) for x in b.column(1).to_pylist()], pa.string())})

    return arrow_map(encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")), make, f"doc_id {encoded.schema[id_col].dataType.simpleString()}, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass, so that
    neither ids nor decoded texts leave the task. Null texts are empty ones, of no token; repeated rows
    and null ids each give a row; an empty table gives none; other columns are ignored."""

    def digests(c: Codec, doc, _, ids: list[np.ndarray]) -> dict[str, list]:
        return {
            "doc_id": doc,
            "n_tokens": pa.array(map(len, ids), pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(c.decode(x).encode()).hexdigest() for x in ids], pa.string()),
        }

    return map_ids(docs, tokenizer, digests, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col)
