"""Licence scans by TF-IDF cosine to templates, with inheritance by directory (operator 5).

A text is cut into statements at line ends and sentence ends; the whole text is one more,
for files that are nothing but a licence. Statements and templates are sparse vectors of
term counts times inverse document frequency, the frequencies counted over all texts. A
file's own licence is that of the best template with a cosine of THRESHOLD or more. A
file without one takes the licence of the nearest ancestor directory that holds a licence
file with one.

Most statements need no vector. A statement without any anchor term of a template cannot
reach THRESHOLD with it: the template's other terms are too small a part of its length
(Cauchy-Schwarz). Anchors are each template's heaviest terms, as many as that takes. What
is left is scored once per distinct statement, however many files repeat it.

Terms outside the templates weigh the mean of the templates' terms. Defined results: a
null text is empty and has no licence; a row without a path is a file of its own, which
inherits nothing; rows of one path share its best licence; ties go to the smaller licence name; an empty table
gives an empty result. Other columns are not read. Everything is column expressions and
joins.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm.registry import query, table
from glimmerdex.plans.sizing import keyed_join, written

THRESHOLD = 0.75
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense)[^/]*$"

# Short grants and header lines of public licences, by their SPDX identifiers.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("ISC", "Released under the ISC License."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

CUT = r"\n+|[.!?;]\s+"
APART = r"[^\p{L}\p{N}]+"


def template_terms() -> list[Counter]:
    return [Counter(t for t in re.split(r"[\W_]+", text.lower()) if t) for _, text in TEMPLATES]


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), APART, -1), lambda t: t != "")


def inverse_frequencies(files: DataFrame) -> tuple[dict[str, float], float]:
    """The weight of every term of the templates, over all texts, and the weight of any other term."""
    vocabulary = sorted({t for counts in template_terms() for t in counts})
    known = F.array(*[F.lit(t) for t in vocabulary])
    held = F.array_intersect(F.array_distinct(terms(F.col("text"))), known)
    # one more entry per text counts the texts; at most one row per term comes back
    rows = files.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("term")).groupBy("term").count().collect()
    seen = {r["term"]: r["count"] for r in rows}
    total = seen.get("", 0)
    weights = {t: math.log((1 + total) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    return weights, sum(weights.values()) / len(weights)


def template_vectors(weights: dict[str, float]) -> list[dict[str, float]]:
    """Unit vectors of the templates."""
    out = []
    for counts in template_terms():
        vector = {t: n * weights[t] for t, n in counts.items()}
        length = math.sqrt(sum(w * w for w in vector.values()))
        out.append({t: w / length for t, w in vector.items()})
    return out


def anchors(vectors: list[dict[str, float]]) -> list[str]:
    """Terms of which a statement needs one to reach the threshold with any template."""
    needed = set()
    for vector in vectors:
        rest = 1.0
        for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < THRESHOLD**2 - 1e-9:
                break
            needed.add(term)
            rest -= weight * weight
    return sorted(needed)


def any_word(words: list[str]) -> str:
    """A pattern for any of the words, grouped by first letter so that few branches are tried at a place."""
    by_letter: dict[str, list[str]] = {}
    for word in words:
        by_letter.setdefault(word[0], []).append(word[1:])
    groups = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_letter.items())
    return rf"(?<![\p{{L}}\p{{N}}])(?:{groups})(?![\p{{L}}\p{{N}}])"


def declared(files: DataFrame) -> DataFrame:
    """(path, license, score) of the files with a licence of their own; files is (path, text)."""
    spark = files.sparkSession
    weights, other = inverse_frequencies(files)
    vectors = template_vectors(weights)
    wanted = any_word(anchors(vectors))
    low = F.lower("text")
    statements = F.filter(F.concat(F.split(low, CUT, -1), F.array(low)), lambda s: s.rlike(wanted))
    found = (
        files.filter(low.rlike(wanted))
        .select("path", F.explode(F.array_distinct(F.transform(statements, lambda s: F.array_join(terms(s), " ")))).alias("statement"))
    )
    texts = written(found.select("path", F.md5(F.col("statement").cast("binary")).alias("key"), "statement"), "statements")
    found = texts.select("path", F.col("key").alias("statement"))
    # statements are told apart by their digest from here on, so that no text travels with its terms
    counted = (
        texts.groupBy("key").agg(F.max("statement").alias("text"))
        .select(F.col("key").alias("statement"), F.explode(F.split("text", " ")).alias("term"))
        .groupBy("statement", "term").agg(F.count("*").alias("n"))
    )
    known = F.broadcast(spark.createDataFrame(sorted(weights.items()), "term string, idf double"))  # at most the templates' terms
    rows = [(i, TEMPLATES[i][0], t, w) for i, v in enumerate(vectors) for t, w in sorted(v.items())]
    shapes = F.broadcast(spark.createDataFrame(rows, "template int, license string, term string, weight double"))
    weighed = counted.join(known, "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(other)))
    length = weighed.groupBy("statement").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dot = weighed.join(shapes, "term").groupBy("statement", "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = (
        dot.join(length, "statement")
        .withColumn("score", F.round(F.col("dot") / F.col("length"), 6))
        .filter(F.col("score") >= THRESHOLD)
        .groupBy("statement")
        .agg(F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("best"))
    )
    return (
        keyed_join(found, written(scored, "scored-statements"), ["statement"], "path")
        .groupBy("path")
        .agg(F.min("best").alias("best"))
        .select("path", F.col("best.license").alias("license"), (-F.col("best.less")).alias("score"))
    )


def parent(path: Column) -> Column:
    """The directory of a path, the empty string at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(directory, license, score, from_directory): each directory with that of its nearest licensed ancestor or itself."""
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    lines = directories.select("directory", F.posexplode(F.array_distinct(above)).alias("steps", "from_directory"))
    met = keyed_join(lines, licensed, ["from_directory"], "directory")
    nearest = met.groupBy("directory").agg(F.min(F.struct("steps", "from_directory", "license", "score")).alias("n"))
    return nearest.select("directory", "n.license", "n.score", "n.from_directory")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", file_name: str = LICENCE_FILE) -> DataFrame:
    """(path, license, score, origin, from_directory) of every row; origin is own, inherited or null."""
    rows = files.select(F.col(f"`{path_col}`").alias("path"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # Rows without a path are told apart by their texts; no path begins with the mark.
    rows = rows.withColumn("file", F.coalesce("path", F.concat(F.lit("\0"), F.md5(F.col("text").cast("binary")))))
    own = written(declared(rows.select(F.col("file").alias("path"), "text")), "own-licences")
    licensed = (
        own.filter(F.col("path").rlike(file_name))
        .select(parent(F.col("path")).alias("from_directory"), "license", "score")
        .groupBy("from_directory")
        .agg(F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("best"))
        .select("from_directory", F.col("best.license").alias("license"), (-F.col("best.less")).alias("score"))
    )
    paths = rows.select("path", "file", parent(F.col("path")).alias("directory"))
    passed = inherited(paths.select("directory").filter("directory is not null").distinct(), licensed)
    passed = written(passed, "inherited").select(
        "directory", F.col("license").alias("theirs"), F.col("score").alias("their_score"), "from_directory"
    )
    marked = keyed_join(paths, own.withColumnRenamed("path", "file"), ["file"], "directory", "left")
    marked = keyed_join(marked, passed, ["directory"], "file", "left")
    has = F.col("license").isNotNull()
    return marked.select(
        "path",
        F.coalesce("license", "theirs").alias("license"),
        F.coalesce("score", "their_score").alias("score"),
        F.when(has, "own").when(F.col("theirs").isNotNull(), "inherited").alias("origin"),
        F.when(~has, F.col("from_directory")).alias("from_directory"),
    )


def document_path() -> Column:
    """The documents have no paths, and one without an id gets none. Source, thousand and hundred of the id stand for directories, and the first
    document of a hundred for its directory's licence file."""
    thousand, hundred = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100))
    name = F.when(F.col("doc_id") % 100 == 0, F.concat(F.lit("LICENSE-"), F.col("doc_id").cast("string"))).otherwise(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    return F.when(F.col("doc_id").isNotNull(), F.concat_ws("/", "source", thousand, hundred, name))


def _sql() -> str:
    """The same in SQL, every statement scored against every template."""
    words = lambda s: rf"list_filter(string_split_regex(lower({s}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"
    literal = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {literal(name)}, {literal(text)})" for i, (name, text) in enumerate(TEMPLATES))
    parent_ = lambda p: f"regexp_replace({p}, '/?[^/]*$', '')"
    return rf"""WITH t(template, license, text) AS (VALUES {values}),
tc AS (SELECT template, license, term, count(*) AS n FROM (SELECT template, license, unnest({words('text')}) AS term FROM t) GROUP BY ALL),
f AS (SELECT doc_id, concat_ws('/', source, CAST(floor(doc_id / 1000) AS BIGINT), CAST(floor(doc_id / 100) AS BIGINT),
  CASE WHEN doc_id % 100 = 0 THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END) AS path, lower(coalesce(text, '')) AS text FROM documents),
df AS (SELECT term, count(*) AS held FROM (SELECT unnest(list_distinct({words('text')})) AS term FROM f) WHERE term IN (SELECT term FROM tc) GROUP BY ALL),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM f)) / (1 + coalesce(held, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM tc) LEFT JOIN df USING (term)),
tw AS (SELECT template, license, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY template)) AS weight FROM tc JOIN idf USING (term)),
st AS (SELECT DISTINCT path, array_to_string({words('s')}, ' ') AS statement FROM (
  SELECT path, unnest(list_concat(string_split_regex(text, '\n+|[.!?;]\s+'), [text])) AS s FROM f)),
w AS (SELECT statement, term, count(*) * any_value(coalesce(idf, (SELECT avg(idf) FROM idf))) AS w FROM (
  SELECT statement, unnest(string_split(statement, ' ')) AS term FROM (SELECT DISTINCT statement FROM st WHERE statement <> '')) LEFT JOIN idf USING (term) GROUP BY ALL),
len AS (SELECT statement, sqrt(sum(w * w)) AS length FROM w GROUP BY ALL),
sc AS (SELECT statement, license, round(sum(w * weight) / any_value(length), 6) AS score FROM w JOIN tw USING (term) JOIN len USING (statement) GROUP BY statement, template, license),
own AS (SELECT path, license, score FROM (SELECT path, license, score, row_number() OVER (PARTITION BY path ORDER BY score DESC, license) AS k
  FROM st JOIN sc USING (statement) WHERE score >= {THRESHOLD}) WHERE k = 1),
ld AS (SELECT dir, license, score FROM (SELECT {parent_('path')} AS dir, license, score,
  row_number() OVER (PARTITION BY {parent_('path')} ORDER BY score DESC, license) AS k FROM own WHERE regexp_matches(path, '{LICENCE_FILE}')) WHERE k = 1),
near AS (SELECT path, license, score, dir FROM (SELECT f.path, ld.*, row_number() OVER (PARTITION BY f.path ORDER BY length(dir) DESC) AS k
  FROM (SELECT DISTINCT path FROM f) f JOIN ld ON starts_with(f.path, dir || '/') OR dir = '') WHERE k = 1)
SELECT doc_id, f.path, coalesce(own.license, near.license) AS license, coalesce(own.score, near.score) AS score,
  CASE WHEN own.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own.license IS NULL THEN near.dir END AS from_directory
FROM f LEFT JOIN own USING (path) LEFT JOIN near USING (path)"""


@query("op5_licenses", _sql())
def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(document_path().alias("path"), "text")
    found = scan(docs)
    number = F.regexp_extract("path", r"(\d+)(?:\.txt)?$", 1).cast("long")
    return found.select(number.alias("doc_id"), "path", "license", "score", "origin", "from_directory")
