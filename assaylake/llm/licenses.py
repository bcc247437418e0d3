"""License scan: TF-IDF cosine of header lines and licence files to templates, then inheritance down directories.

Everything is DataFrame expressions and joins.

* A passage is a line, anywhere in a text, that mentions a licence, a copyright or a permission. Equal passages
  are scored once. Terms are runs of ``[a-z0-9.+-]`` in lower case, trimmed of ``.`` and ``-``.
* A term weighs ``tf * (ln((1 + passages) / (1 + passages with it)) + 1)``; frequencies count every passage of every
  document. Only terms of templates can add to a product, so passages meet templates by a join on terms.
* A file's own licence is its closest template if the cosine reaches ``least``; ties go to the name first in
  the alphabet. A file is a licence file if at least ``file_share`` of its words stand in passages of its licence.
* A file without its own licence takes that of the nearest directory, its own or above, that holds a licence
  file; of several there the closest to its template counts, then the smallest id.

Null texts have no passage; a null path is the root directory. Rows come back once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.llm.shared import stored

LEAST = 0.5
FILE_SHARE = 0.1
TRIGGER = r"(?i)licen[cs]e|copyright|permission|warranty|redistribut|spdx"
_TERM = r"[a-z0-9.+-]+"
_WORD = r"[^\x20\x09-\x0D]+"

#: Public wordings of licence notices.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution License CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without permission."),
)


def _terms(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))
    return F.filter(F.transform(words, lambda w: F.regexp_replace(w, r"^[.-]+|[.-]+$", "")), lambda w: w != "")


def _counted(texts: DataFrame, name: str) -> DataFrame:
    """(name, term, tf)."""
    return texts.select(name, F.explode(_terms(F.col("text"))).alias("term")).groupBy(name, "term").agg(F.count("*").alias("tf"))


def closest(passages: DataFrame, templates: DataFrame) -> DataFrame:
    """(passage, license, score) for the closest template of each passage (passage, n) that shares a term with one."""
    terms = stored(_counted(passages.withColumn("text", F.col("passage")), "passage"), "terms")
    total = passages.agg(F.sum("n")).first()[0] or 0
    held = terms.join(passages, "passage").groupBy("term").agg(F.sum("n").alias("held"))
    names = stored(_counted(templates, "license"), "template-terms")
    vocabulary = terms.select("term").unionAll(names.select("term")).distinct()
    weight = F.log((F.lit(1.0) + F.lit(float(total))) / (F.lit(1.0) + F.coalesce("held", F.lit(0)))) + 1.0
    idf = stored(vocabulary.join(held, "term", "left").select("term", weight.alias("idf")), "idf")
    weighted = terms.join(idf, "term").select("passage", "term", (F.col("tf") * F.col("idf")).alias("w"))
    weighted = stored(weighted, "weights")
    marks = names.join(idf, "term").select("license", "term", (F.col("tf") * F.col("idf")).alias("v"))
    lengths = weighted.groupBy("passage").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("w_length"))
    spans = marks.groupBy("license").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("v_length"))
    dots = weighted.join(marks, "term").groupBy("passage", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    score = F.round(F.col("dot") / (F.col("w_length") * F.col("v_length")), 6)
    scored = dots.join(lengths, "passage").join(spans, "license").select("passage", "license", score.alias("score"))
    best = Window.partitionBy("passage").orderBy(F.desc("score"), "license")
    return scored.withColumn("at", F.row_number().over(best)).where("at = 1").drop("at")


def license_scan(files: DataFrame, templates=TEMPLATES, *, least: float = LEAST, file_share: float = FILE_SHARE) -> DataFrame:
    """(doc_id, path, own_license, score, license, origin) for every row of ``files`` (doc_id, path, text).

    ``origin`` is the path itself for a file's own licence, the directory it was inherited from, or null.
    """
    spark: SparkSession = files.sparkSession
    named = spark.createDataFrame(list(templates), "license string, text string")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(TRIGGER))
    passages = F.when(F.col("text").rlike(TRIGGER), lines).otherwise(F.array().cast("array<string>"))
    scanned = files.select("doc_id", F.coalesce("path", F.lit("")).alias("path"), F.coalesce(passages, F.array().cast("array<string>")).alias("passages"),
                           F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).alias("words"))
    # a row's own number tells equal rows apart; it is written, so it stays what it is
    scanned = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    lined = scanned.select("row", F.explode("passages").alias("passage"))
    found = stored(closest(lined.groupBy("passage").agg(F.count("*").alias("n")), named), "closest")
    hits = lined.join(found.where(F.col("score") >= least), "passage").groupBy("row", "license").agg(
        F.max("score").alias("score"), F.sum(F.regexp_count("passage", F.lit(_WORD))).alias("covered"))
    best = Window.partitionBy("row").orderBy(F.desc("score"), "license")
    own = hits.withColumn("at", F.row_number().over(best)).where("at = 1").select("row", F.col("license").alias("own_license"), "score", "covered")
    judged = scanned.select("row", "doc_id", "path", "words").join(own, "row", "left")
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    judged = stored(judged.withColumn("folder", folder), "judged")

    licence_files = judged.where(F.col("own_license").isNotNull() & (F.col("covered") >= file_share * F.col("words")))
    held = licence_files.groupBy("folder").agg(F.min(F.struct(
        F.negative("score").alias("minus"), F.col("doc_id").alias("doc_id"), F.col("own_license").alias("license"))).alias("top"))
    held = held.select(F.col("folder").alias("above"), F.col("top.license").alias("license"))
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    folders = judged.select("folder").distinct().select("folder", F.explode(F.array_distinct(above)).alias("above"))
    nearest = folders.join(held, "above").groupBy("folder").agg(
        F.max(F.struct(F.length("above").alias("depth"), F.col("above"), F.col("license"))).alias("near"))
    nearest = nearest.select("folder", F.col("near.above").alias("above"), F.col("near.license").alias("inherited"))
    out = judged.join(nearest, "folder", "left")
    has = F.col("own_license").isNotNull()
    return out.select("doc_id", "path", "own_license", "score", F.when(has, F.col("own_license")).otherwise(F.col("inherited")).alias("license"),
                      F.when(has, F.col("path")).otherwise(F.col("above")).alias("origin"))


# ---- the documents table as a tree of files

#: Directories by source and language; every tenth and hundredth document lies one or two levels higher.
PATH_SQL = ("concat_ws('/', coalesce(source, 'none'), CASE WHEN doc_id % 100 = 0 THEN NULL ELSE coalesce(lang, 'none') END, "
            "CASE WHEN doc_id % 10 = 0 THEN NULL ELSE 'd' || CAST(doc_id % 1000 AS STRING) END, CAST(doc_id AS STRING) || '.txt')")


def documents_as_files(docs: DataFrame) -> DataFrame:
    """(doc_id, path, text): a path for each document, made of its source, language and id."""
    return docs.select("doc_id", F.expr(PATH_SQL).alias("path"), "text")


def _sql() -> str:
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in TEMPLATES)
    terms = ("list_filter(list_transform(regexp_extract_all(lower({}), '" + _TERM + "'), lambda w: regexp_replace(w, '^[.-]+|[.-]+$', '', 'g')), lambda w: w <> '')")
    words = "coalesce(length(regexp_extract_all({}, '" + _WORD.replace("\\\\", "\\") + "')), 0)"
    return f"""WITH templates AS (SELECT * FROM (VALUES {values}) t(license, text)),
scanned AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {PATH_SQL} AS path, {words.format('text')} AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{TRIGGER}')) AS passages FROM documents),
lined AS MATERIALIZED (SELECT row, unnest(passages) AS passage FROM scanned),
passages AS MATERIALIZED (SELECT passage, count(*) AS n FROM lined GROUP BY passage),
terms AS MATERIALIZED (SELECT passage, n, term, count(*) AS tf FROM (SELECT passage, n, unnest({terms.format('passage')}) AS term FROM passages) GROUP BY ALL),
names AS MATERIALIZED (SELECT license, term, count(*) AS tf FROM (SELECT license, unnest({terms.format('text')}) AS term FROM templates) GROUP BY ALL),
held AS (SELECT term, sum(n) AS held FROM terms GROUP BY term),
idf AS MATERIALIZED (SELECT term, ln((1.0 + (SELECT coalesce(sum(n), 0) FROM passages)) / (1.0 + coalesce(held, 0))) + 1.0 AS idf
  FROM (SELECT term FROM terms UNION SELECT term FROM names) LEFT JOIN held USING (term)),
w AS MATERIALIZED (SELECT passage, term, tf * idf AS w FROM terms JOIN idf USING (term)),
v AS MATERIALIZED (SELECT license, term, tf * idf AS v FROM names JOIN idf USING (term)),
scored AS (SELECT passage, license, round(dot / (wl * vl), 6) AS score FROM (SELECT passage, license, sum(w * v) AS dot FROM w JOIN v USING (term) GROUP BY ALL)
  JOIN (SELECT passage, sqrt(sum(w * w)) AS wl FROM w GROUP BY ALL) USING (passage) JOIN (SELECT license, sqrt(sum(v * v)) AS vl FROM v GROUP BY ALL) USING (license)),
found AS MATERIALIZED (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY passage ORDER BY score DESC, license) = 1),
hits AS (SELECT row, license, max(score) AS score, sum({words.format('passage')}) AS covered FROM lined JOIN found USING (passage) WHERE score >= {LEAST} GROUP BY ALL),
own AS (SELECT row, license AS own_license, score, covered FROM hits QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, license) = 1),
judged AS MATERIALIZED (SELECT s.row, doc_id, path, words, own_license, score, covered, regexp_replace(path, '/?[^/]*$', '') AS folder FROM scanned s LEFT JOIN own USING (row)),
held_by AS (SELECT folder AS above, own_license AS license FROM judged WHERE own_license IS NOT NULL AND covered >= {FILE_SHARE} * words
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, doc_id) = 1),
folders AS (SELECT DISTINCT folder, unnest(list_distinct(list_transform(range(0, length(string_split(folder, '/')) + 1), lambda i: array_to_string(list_slice(string_split(folder, '/'), 1, i), '/')))) AS above FROM judged),
nearest AS (SELECT folder, above, license AS inherited FROM folders JOIN held_by USING (above) QUALIFY row_number() OVER (PARTITION BY folder ORDER BY length(above) DESC) = 1)
SELECT doc_id, path, own_license, score, coalesce(own_license, inherited) AS license, CASE WHEN own_license IS NOT NULL THEN path ELSE above END AS origin
FROM judged LEFT JOIN nearest USING (folder)"""


SQL = _sql().replace("AS STRING", "AS VARCHAR")
