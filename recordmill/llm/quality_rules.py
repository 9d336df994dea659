"""Quality rules, line first, with Spark's own functions only.

Each line is judged by punctuation, navigation and boilerplate rules; failed lines go; a document
that loses more than half of its characters so is rejected, as is one that fails the base rules.
Everything is a projection: no shuffle, one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import quoted, set_aside

#: White space between words, symbols, phrases of boilerplate lines.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
PHRASES = {
    "de": "datenschutzerklärung|cookies akzeptieren|alle rechte vorbehalten|nutzungsbedingungen|hier klicken|weiterlesen|mehr erfahren|jetzt anmelden|newsletter abonnieren|javascript aktivieren",
    "en": "cookie policy|accept (all )?cookies|enable javascript|privacy policy|terms of (use|service)|all rights reserved|click here|sign (in|up) (to|now)|log in to|subscribe (now|to our)|lorem ipsum|read more|share this",
    "es": "política de privacidad|aceptar (las |todas las )?cookies|todos los derechos reservados|términos (de uso|y condiciones)|aviso legal|haga clic aquí|leer más|iniciar sesión|suscríbete|active javascript",
    "fr": "politique de confidentialité|accepter (les |tous les )?cookies|tous droits réservés|conditions (générales|d.utilisation)|mentions légales|cliquez ici|lire la suite|en savoir plus|abonnez-vous|activez javascript",
}
BOILERPLATE = "|".join(PHRASES.values())
MARK = r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]"
#: A line fails beyond one symbol in so many characters, one run of marks, one separator.
CHARS_PER_SYMBOL, CHARS_PER_RUN, CHARS_PER_SEPARATOR = 20, 20, 30
BOILERPLATE_CHARS = 200


def line_fails(line: Column) -> Column:
    """punctuation: too many symbols or runs of marks, more marks than letters and digits, or all in
    capitals; navigation: items between
    separators; boilerplate: a short line with a stock phrase. A line without a word passes."""
    n = F.length(line)
    punctuation = (F.regexp_count(line, F.lit(SYMBOLS)) * CHARS_PER_SYMBOL > n) | (F.regexp_count(line, F.lit(r"[!?]{2,}")) * CHARS_PER_RUN > n) | ((n >= 40) & (F.upper(line) == line) & (F.lower(line) != line))
    punctuation |= F.regexp_count(line, F.lit(MARK)) * 2 > F.length(F.translate(line, " \t\n\x0b\x0c\r", ""))
    separators = F.regexp_count(line, F.lit(r"[\x20\x09][|»›•·>][\x20\x09]"))
    navigation = (separators >= 2) & (separators * CHARS_PER_SEPARATOR > n)
    boilerplate = (n <= BOILERPLATE_CHARS) & F.lower(line).rlike(BOILERPLATE)
    return punctuation | navigation | boilerplate


def held(c: Column) -> Column:
    """The column itself, but not to be merged into what uses it: within a lambda it would be worked
    out anew for every element."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_share", "kept", "clean_text")


def assess(docs: DataFrame, *, text_col: str = "text", keep: tuple[str | Column, ...] = (), min_words: int = 50, most_repeated: int = 50, most_lost: float = 0.5) -> DataFrame:
    """The columns of ``keep``, then n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, lost_share, kept and clean_text (null if rejected; the text itself if no line fails).

    A null text has no words, so it fails the base rules. Every row is judged alone: repeated rows
    give equal results and an empty table none. Other columns are ignored; a kept one named like a
    result comes back as input_<name>.
    """
    text = F.coalesce(F.col("__text"), F.lit(""))
    aside, back = set_aside(docs, keep, RESULTS)
    rows = docs.select(*aside, quoted(text_col).cast("string").alias("__text"))
    names = rows.columns[:-1]
    kept = [F.col(f"`{c}`") for c in names]
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    # each step materialises what later lambdas refer to
    rows = rows.select(*kept, "__text", held(F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))).alias("w"), F.split(text, "\n").alias("lines"))
    windows = F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    rows = rows.select(*kept, "__text", "lines", held(F.size("w").cast("long")).alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), windows.alias("h"))
    found = F.size("h") > F.size(F.array_distinct("h"))
    in_order = F.when(found, F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    full = F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(*kept, "__text", "lines", held(F.col("n_words")).alias("n_words"), "word_chars", in_order.alias("s"), full.alias("full"), F.transform("lines", line_fails).alias("fails"))
    twice = F.filter("s", lambda x, i: F.coalesce(F.get("s", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False)))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, x: F.struct((x + 3).alias("end"), (a["n"] + F.least(F.lit(3), x + 3 - a["end"])).alias("n")), lambda a: a["n"])
    good = F.filter("lines", lambda x, i: ~F.get("fails", i))
    rows = rows.select(
        *kept, "__text", held(F.col("n_words")).alias("n_words"), "word_chars", "full",
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array_join(good, "\n").alias("good"), F.exists("fails", lambda x: x).alias("any_fails"),
    )
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    lost = F.when(F.length(text) > 0, 1 - F.length("good") / F.length(text)).otherwise(0.0)
    rows = rows.select(*kept, "__text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), F.when(F.col("any_fails"), lost).otherwise(0.0).alias("lost_share"), "good", "any_fails")
    verdict = ~F.col("base_failed") & (F.col("lost_share") <= most_lost)
    return back(rows.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_share", verdict.alias("kept"), F.when(verdict, F.when(F.col("any_fails"), F.col("good")).otherwise(F.col("__text"))).alias("clean_text")))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS p FROM twice, (VALUES (0), (1), (2)) AS v(k)) GROUP BY doc_id
), line AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d
), judged AS (
  SELECT doc_id, l, regexp_matches(l, '[^\x20\x09-\x0D]') AS has_word,
    len(regexp_extract_all(l, '[#*$%&|<>]')) * 20 > length(l)
    OR len(regexp_extract_all(l, '[!?]{2,}')) * 20 > length(l)
    OR len(regexp_extract_all(l, '__MARK__')) * 2 > length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))
    OR (length(l) >= 40 AND upper(l) = l AND lower(l) <> l)
    OR (len(regexp_extract_all(l, '[\x20\x09][|»›•·>][\x20\x09]')) >= 2 AND len(regexp_extract_all(l, '[\x20\x09][|»›•·>][\x20\x09]')) * 30 > length(l))
    OR (length(l) <= 200 AND regexp_matches(lower(l), '__BOILERPLATE__')) AS fails
  FROM line
), per AS (
  SELECT doc_id, sum(CASE WHEN has_word THEN 1 ELSE 0 END) - count(DISTINCT CASE WHEN has_word THEN l END) AS n_dup_lines,
    bool_or(fails) AS any_fails,
    sum(CASE WHEN fails THEN 0 ELSE length(l) END) + greatest(sum(CASE WHEN fails THEN 0 ELSE 1 END) - 1, 0) AS good_chars
  FROM judged GROUP BY doc_id
), f AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(per.n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CASE WHEN any_fails AND length(t) > 0 THEN 1 - good_chars / CAST(length(t) AS DOUBLE) ELSE 0.0 END AS lost
  FROM d JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.5 AS kept
FROM f
""".replace("__BOILERPLATE__", BOILERPLATE).replace("__MARK__", MARK)
