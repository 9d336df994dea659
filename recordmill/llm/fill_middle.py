"""Fill-in-middle: texts cut in three at token borders and put in another order.

A text is an array of code points. A token is a run of white space with the run of other characters
after it, so one begins at the text's start and wherever white space follows another character; the
borders come from comparing neighbouring classes, not from matching. Two of them, picked by a hash of
the id, cut the text into prefix, middle and suffix.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from recordmill.llm.common import arrow_map, quoted, set_aside, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Rates:
    """Of 100 texts so many are rearranged, and of 100 of these so many with the suffix first."""

    rearranged: int = 50
    suffix_first: int = 80


def borders(points: np.ndarray) -> np.ndarray:
    """Where tokens begin, and the end: n + 1 places for n tokens."""
    if not len(points):
        return np.zeros(1, np.int64)
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    starts = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    return np.concatenate([[0], starts, [len(points)]])


def draws(seed: int, doc_id: str) -> list[int]:
    """Four numbers of 32 bits from the SHA-256 of seed:id."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def rearranged(text: str, doc_id: str, seed: int, rates: Rates) -> tuple[int, str, int | None, int | None, str]:
    """n, form, characters of the prefix and the middle, and the output."""
    data = text.encode("utf-32-le")
    at = borders(np.frombuffer(data, np.uint32))
    n = len(at) - 1
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rates.rearranged:
        return n, "plain", None, None, text
    a, b = (int(at[k]) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = (data[4 * i : 4 * j].decode("utf-32-le") for i, j in ((0, a), (a, b), (b, len(text))))
    if h4 % 100 < rates.suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def rebuilt(output: str, form: str) -> str:
    """The text from its output. No mark is in it, and none can begin within another, so the first
    place of each is the one that was put there."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    i = output.index(second)
    j = output.index(MIDDLE, i)
    one, two, middle = output[len(first) : i], output[i + len(second) : j], output[j + len(MIDDLE) :]
    return (one + middle + two) if form == "psm" else (two + middle + one)


def fill_in_middle(docs: DataFrame, *, keep: tuple[str | Column, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rates: Rates = Rates()) -> DataFrame:  # noqa: B008
    """The columns of ``keep``, then n, form, prefix_chars, middle_chars and output; a row for each row.

    A projection without a shuffle; a task holds one text of a few MB of texts at a time. Null texts
    are empty, an empty text has no token and stays plain, as does one that holds a mark. A null id
    is drawn for as the empty one, so repeated rows have the same form. Very long texts take five
    bytes a character besides themselves. An empty table gives no row. Other columns are ignored; a
    kept one named like a result comes back as input_<name>.
    """
    aside, back = set_aside(docs, keep, RESULTS)
    rows = docs.select(*aside, text_of(id_col).alias("__id"), text_of(text_col).alias("__text"))
    kept = rows.columns[:-2]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, texts = batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()
            out = list(zip(*(rearranged(t, i, seed, rates) for i, t in zip(ids, texts, strict=True)), strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=[*kept, *RESULTS])

        return step

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(kept)])
    return back(arrow_map(rows, make, f"{fields}n long, form string, prefix_chars long, middle_chars long, output string"))


def restored(df: DataFrame, *, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``df`` with ``restored``: the texts from what ``fill_in_middle`` made of them. An output that is
    null has none; a form other than psm and spm is plain."""
    aside, back = set_aside(df, tuple(df.columns), ("restored",))
    rows = df.select(*aside, quoted(output_col).alias("__output"), quoted(form_col).alias("__form"))
    kept = rows.columns[:-2]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist(), strict=True)
            texts = pa.array([None if o is None else rebuilt(o, f if f in ("psm", "spm") else "plain") for o, f in pairs], pa.string())
            return pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], names=[*kept, "restored"])

        return step

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(kept)])
    return back(arrow_map(rows, make, f"{fields}restored string"))


#: The query's rows.
ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t
), f AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS pre, coalesce(array_to_string(w[a + 1:b], ''), '') AS mid, coalesce(array_to_string(w[b + 1:], ''), '') AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""
