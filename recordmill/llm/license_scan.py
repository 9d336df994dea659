"""Licences of files by TF-IDF cosine to templates, then by the nearest directory that has one.

With Spark's own functions only. The lines and sentences of a file (its headers) and the whole of a
licence file are compared with the sentences that licences are known by. Only what holds a heavy term
of some template can reach the threshold, so the rest never becomes rows; that filter is exact by
Cauchy and Schwarz.
A file without a licence of its own takes that of its nearest ancestor directory with a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import set_aside, text_of, written

#: Sentences that notices and licence texts are known by, for each licence. Tags are
#: added to them by ``TAG``.
TEMPLATES = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU Affero General Public License version 3",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Apache License Version 2.0, January 2004",
    ],
    "BSD-2-Clause": ["This software is licensed under the 2-clause BSD license.", "Simplified BSD License"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU General Public License version 2, June 1991",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "GNU General Public License version 3, 29 June 2007",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "ISC License"],
    "MIT": [
        "Released under the MIT License.",
        "The MIT License (MIT)",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
TAG = "SPDX-License-Identifier: {}"
TERM = "[a-z0-9]+"
LICENCE_FILE = "(?i)^(licen[sc]e|copying|notice)([.-].*)?$"


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def heavy_terms(weights: dict[str, float], threshold: float) -> list[str]:
    """The terms but for the lightest that together stay below the threshold times the norm."""
    norm, light, out = math.sqrt(sum(w * w for w in weights.values())), 0.0, []
    for term in sorted(weights, key=lambda t: (weights[t], t)):
        light += weights[term] ** 2
        if math.sqrt(light) >= threshold * norm - 1e-9:
            out.append(term)
    return out


def units(text: Column, whole: Column) -> Column:
    """What is compared with the templates: lines; sentences, which may go over several lines of a
    block; and, for a licence file, the whole text."""
    blocks = F.translate(F.regexp_replace(text, r"\n[ \t\r]*\n", "\f"), "\n", " ")
    sentences = F.split(F.regexp_replace(blocks, r"([.!?])[ \t\r\f]+", "$1\f"), "\f")
    both = F.concat(F.split(text, "\n"), sentences)
    return F.array_distinct(F.when(whole, F.array_append(both, text)).otherwise(both))


def scan(files: DataFrame, path: Column, *, keep: tuple[str | Column, ...] = ("doc_id",), text_col: str = "text", templates: dict[str, list[str]] | None = None, threshold: float = 0.6) -> DataFrame:
    """The columns of ``keep``, then path, licence, origin (header, file, inherited or none), score.

    score: the cosine that found the licence, rounded to 6 digits. Idf counts the files of ``files``
    that hold a term; terms outside the templates weigh as unseen ones. Of equal scores the licence
    first in alphabetical order holds; of licence files in one directory the one with the best score,
    then the least path. A file is a licence file by its name. Null or empty texts have no licence of
    their own but may inherit one; a null path is the root's empty name; rows of the same path are one
    file; repeated rows get equal results; an empty table gives none. Other columns are ignored; a
    kept one named like a result comes back as input_<name>. What reaches the driver is one row per
    term of the templates.
    """
    templates = {k: [*v, TAG.format(k)] for k, v in TEMPLATES.items()} if templates is None else templates
    bodies = [(k, n, x) for k, v in templates.items() for n, x in enumerate(v)]
    spark = files.sparkSession
    vocabulary = sorted({t for _, _, x in bodies for t in terms(x)})
    aside, back = set_aside(files, keep, ("path", "licence", "origin", "score"))
    rows = files.select(*aside, F.coalesce(path, F.lit("")).alias("path"), text_of(text_col).alias("__text"))
    names = rows.columns[:-2]
    own = [F.col(f"`{c}`") for c in names]
    name, folder = F.element_at(F.split("path", "/"), -1), F.regexp_replace("path", "/?[^/]*$", "")
    rows = rows.select(*own, "path", folder.alias("__dir"), name.rlike(LICENCE_FILE).alias("__is_file"), "__text")
    found = rows.select(F.explode(F.array_append(F.array_intersect(F.array_distinct(F.regexp_extract_all(F.lower("__text"), F.lit(TERM), F.lit(0))), F.array(*map(F.lit, vocabulary))), F.lit(""))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    df = {r["term"]: r["n"] for r in found.collect()}
    n_files = df.get("", 0)
    idf = {t: math.log((1 + n_files) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    unseen = math.log(1 + n_files) + 1
    vectors = {(k, n): {t: c * idf[t] for t, c in Counter(terms(x)).items()} for k, n, x in bodies}
    heavy = sorted({t for v in vectors.values() for t in heavy_terms(v, threshold)})
    holds = lambda x: F.lower(x).rlike(f"(?<![a-z0-9])({'|'.join(heavy)})(?![a-z0-9])") if heavy else F.lit(False)
    # texts without a heavy term are done with before they are cut up
    cut = rows.where(holds(F.col("__text"))).select("path", "__dir", "__is_file", F.explode(F.filter(units(F.col("__text"), F.col("__is_file")), holds)).alias("part"))
    # a unit is as long as its other terms, at least, and its part within the vocabulary at most as the
    # sum of its weights: if that is too little, it lies too far off any template
    weigh = F.create_map(*[F.lit(x) for tw in idf.items() for x in tw]) if idf else F.create_map().cast("map<string,double>")
    cut = cut.withColumn("terms", F.regexp_extract_all(F.lower("part"), F.lit(TERM), F.lit(0)))
    weights = F.transform("terms", lambda x: F.try_element_at(weigh, x))
    inside = F.aggregate(weights, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    outside = F.size(F.filter(weights, lambda x: x.isNull()))
    cut = cut.withColumn("most", inside).where(outside * unseen**2 <= (1 / threshold**2 - 1) * F.col("most") * F.col("most") + 1e-6)
    # the same unit of the same path again only makes its vector longer, which no cosine sees
    of_unit = ("unit", "path", "__dir", "__is_file")
    parts = cut.select(F.sha2(F.concat_ws("\n", "path", "part"), 256).alias("unit"), *of_unit[1:], F.explode("terms").alias("term"))
    of_term = spark.createDataFrame([(t, w) for t, w in idf.items()] or [("", 0.0)], "term string, idf double")
    of_template = spark.createDataFrame([(k, n, t, w / math.sqrt(sum(x * x for x in v.values()))) for (k, n), v in vectors.items() for t, w in v.items()] or [("", 0, "", 0.0)], "licence string, n int, term string, w double")
    tf = written(parts.groupBy(*of_unit, "term").agg(F.count("*").alias("tf")), "licence-terms")
    # both small tables are as large as the templates are, whatever the corpus
    weighed = tf.join(F.broadcast(of_term), "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    norms = weighed.groupBy(*of_unit).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighed.join(F.broadcast(of_template), "term").groupBy("unit", "licence", "n").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    scores = dots.join(norms, "unit").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= threshold)
    best = F.min(F.struct((-F.col("score")).alias("s"), "licence"))
    # tables, so that a join may split a path or folder that very many rows have
    hits = written(scores.groupBy(*of_unit[1:]).agg(best.alias("b")).select(*of_unit[1:], F.col("b.licence").alias("own"), (-F.col("b.s")).alias("own_score")), "licence-hits")
    of_folder = hits.where("__is_file").groupBy("__dir").agg(F.min(F.struct((-F.col("own_score")).alias("s"), "path", "own")).alias("b")).select(F.col("__dir").alias("up"), F.col("b.own").alias("up_licence"), (-F.col("b.s")).alias("up_score"))
    # folders, not files, look for their nearest ancestor
    steps = F.filter(F.split("__dir", "/"), lambda x: x != "")
    folders = rows.select("__dir").distinct().select("__dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(steps, F.lit(1), i), "/").alias("up")))).alias("a")).select("__dir", "a.depth", "a.up")
    nearest = written(folders.join(of_folder, "up").groupBy("__dir").agg(F.max(F.struct("depth", "up_licence", "up_score")).alias("b")).select("__dir", "b.up_licence", "b.up_score"), "nearest-licences")
    out = rows.drop("__text").join(hits.select("path", "own", "own_score"), "path", "left").join(nearest, "__dir", "left")
    origin = F.when(F.col("own").isNotNull(), F.when(F.col("__is_file"), "file").otherwise("header")).when(F.col("up_licence").isNotNull(), "inherited").otherwise("none")
    return back(out.select(*own, "path", F.coalesce("own", "up_licence").alias("licence"), origin.alias("origin"), F.coalesce("own_score", F.when(F.col("own").isNull(), F.col("up_score")), F.lit(0.0)).alias("score")))


def corpus_path() -> Column:
    """The tree that the corpus is read as: source/lang/hundred of ids. Each first document of
    ten is called a licence file of its folder; the first of a thousand lies in source/lang itself."""
    n = F.coalesce("doc_id", F.lit(0))
    top = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    folder = F.when(n % 1000 == 0, top).otherwise(F.concat_ws("/", top, F.floor(n / 100).cast("string")))
    name = F.when(n % 10 == 0, F.concat(F.lit("LICENSE."), n.cast("string"))).otherwise(F.concat(n.cast("string"), F.lit(".txt")))
    return F.concat_ws("/", folder, name)


_BODIES = [(k, n, x.replace("'", "''")) for k, v in TEMPLATES.items() for n, x in enumerate([*v, TAG.format(k)])]
_TEMPLATES_SQL = ", ".join(f"('{k}', {n}, '{x}')" for k, n, x in _BODIES)
ORACLE = rf"""
WITH f AS (
  SELECT doc_id, coalesce(text, '') AS t,
    CASE WHEN doc_id % 1000 = 0 THEN source || '/' || lang ELSE source || '/' || lang || '/' || CAST(doc_id // 100 AS VARCHAR) END AS dir,
    doc_id % 10 = 0 AS is_file,
    CASE WHEN doc_id % 1000 = 0 THEN source || '/' || lang ELSE source || '/' || lang || '/' || CAST(doc_id // 100 AS VARCHAR) END
      || CASE WHEN doc_id % 10 = 0 THEN '/LICENSE.' || CAST(doc_id AS VARCHAR) ELSE '/' || CAST(doc_id AS VARCHAR) || '.txt' END AS path
  FROM documents
), tpl AS (SELECT * FROM (VALUES {_TEMPLATES_SQL}) AS v(licence, n, body)
), tt AS (
  SELECT licence, n, term, count(*) AS tf FROM (SELECT licence, n, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term FROM tpl) GROUP BY 1, 2, 3
), df AS (
  SELECT term, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(t), '[a-z0-9]+')) AS term FROM f) GROUP BY 1
), idf AS (
  SELECT v.term, ln((1 + (SELECT count(*) FROM f)) / CAST(1 + coalesce(df.n, 0) AS DOUBLE)) + 1 AS idf FROM (SELECT DISTINCT term FROM tt) v LEFT JOIN df USING (term)
), tw AS (SELECT licence, n, term, tf * idf AS w FROM tt JOIN idf USING (term)
), tn AS (SELECT licence, n, sqrt(sum(w * w)) AS norm FROM tw GROUP BY 1, 2
), part AS (
  SELECT DISTINCT path, dir, is_file, part FROM (
    SELECT path, dir, is_file, unnest(string_split(t, chr(10))) AS part FROM f UNION ALL SELECT path, dir, is_file, t FROM f WHERE is_file
    UNION ALL SELECT path, dir, is_file, unnest(string_split(regexp_replace(replace(regexp_replace(t, '\n[ \t\r]*\n', chr(12), 'g'), chr(10), ' '), '([.!?])[ \t\r\f]+', '\1' || chr(12), 'g'), chr(12))) FROM f) u
), pt AS (
  SELECT path, part, term, count(*) AS tf FROM (SELECT path, part, unnest(regexp_extract_all(lower(part), '[a-z0-9]+')) AS term FROM part) GROUP BY 1, 2, 3
), px AS (
  SELECT path, part, term, tf * coalesce(idf, ln(1 + (SELECT count(*) FROM f)) + 1) AS x FROM pt LEFT JOIN idf USING (term)
), pn AS (SELECT path, part, sqrt(sum(x * x)) AS norm FROM px GROUP BY 1, 2
), score AS (
  SELECT path, part, licence, n, round(sum(x * w) / max(tn.norm) / max(pn.norm), 6) AS score
  FROM px JOIN tw USING (term) JOIN tn USING (licence, n) JOIN pn USING (path, part) GROUP BY 1, 2, 3, 4
), hit AS (
  SELECT path, licence AS own, score AS own_score FROM (
    SELECT path, licence, score, row_number() OVER (PARTITION BY path ORDER BY score DESC, licence) AS r FROM score WHERE score >= 0.6) WHERE r = 1
), folder AS (
  SELECT dir AS up, own AS up_licence, own_score AS up_score FROM (
    SELECT f.dir, own, own_score, row_number() OVER (PARTITION BY f.dir ORDER BY own_score DESC, f.path) AS r FROM hit JOIN f USING (path) WHERE is_file) WHERE r = 1
), near AS (
  SELECT dir, up_licence, up_score FROM (
    SELECT d.dir, up_licence, up_score, row_number() OVER (PARTITION BY d.dir ORDER BY length(up) DESC) AS r
    FROM (SELECT DISTINCT dir FROM f) d JOIN folder ON d.dir = up OR starts_with(d.dir, up || '/')) WHERE r = 1
)
SELECT doc_id, path, coalesce(own, up_licence) AS licence,
  CASE WHEN own IS NOT NULL THEN CASE WHEN is_file THEN 'file' ELSE 'header' END WHEN up_licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  coalesce(own_score, up_score, 0.0) AS score
FROM f LEFT JOIN hit USING (path) LEFT JOIN near USING (dir)
"""
