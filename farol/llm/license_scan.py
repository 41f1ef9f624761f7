"""Licences of files by TF-IDF against templates, inherited along directories (operator 5, SQL functions only).

Every line that mentions a licence is compared with every template by the
cosine of sparse TF-IDF vectors; a file takes its best line's licence. Files
without one inherit from the nearest directory above them that has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.llm.common import staged

# Notices as their publishers word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
]
# A line is compared when it holds one of these; every template does.
MENTION = r"(?i)licen[cs]e|copyright|rights reserved|redistribution|permission is hereby"
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
OWN_SCORE = 0.6      # cosine from which a file counts as licensed by its own line
FILE_SCORE = 0.9     # cosine from which a file also speaks for its directory


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def template_terms(docs: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """(notice, licence, term, tf): one row per notice and term, a fixed list whatever the corpus."""
    notices = F.array(*[
        F.struct(F.lit(i).alias("notice"), F.lit(k).alias("licence"), F.lit(v).alias("wording"))
        for i, (k, v) in enumerate(templates)
    ])
    rows = docs.sparkSession.range(1).select(F.explode(notices).alias("n")).select(
        "n.notice", "n.licence", F.explode(_words(F.col("n.wording"))).alias("term"))
    return rows.groupBy("notice", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))


def idf(files: DataFrame, terms: list[str]) -> DataFrame:
    """Inverse document frequency of the template terms over all whole texts, and of any other word."""
    held = F.array_intersect(F.array_distinct(_words(F.coalesce("text", F.lit("")))), F.array(*map(F.lit, terms)))
    df = files.select(F.explode(held).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = files.agg(F.count(F.lit(1))).scalar()
    listed = files.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, terms))).alias("term"))
    return listed.join(df, "term", "left").select(
        "term", (F.log((1 + n) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf"), (F.log(1 + n) + 1).alias("other"))


def match_files(files: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """Best (licence, score) of each file with a line that mentions one: key, licence, score."""
    spec = template_terms(files, templates)
    terms = sorted({r["term"] for r in spec.select("term").distinct().collect()})  # the templates' words
    weights = staged(idf(files, terms), "idf")
    other = weights.agg(F.max("other")).scalar()
    vectors = F.broadcast(spec.join(F.broadcast(weights), "term").select("notice", "licence", "term", (F.col("tf") * F.col("idf")).alias("w")))
    norms = F.broadcast(vectors.groupBy("notice", "licence").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("t_norm")))
    lines = files.where(F.col("text").rlike(MENTION)).select(
        "key", F.explode(F.array_distinct(F.filter(F.split("text", "\n"), lambda x: x.rlike(MENTION)))).alias("line"))
    tf = lines.select("key", F.xxhash64("line").alias("line"), F.explode(_words(F.col("line"))).alias("term")).groupBy("key", "line", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighed = tf.join(F.broadcast(weights.select("term", "idf")), "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce(F.col("idf"), other))
    line_norm = weighed.groupBy("key", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l_norm"))
    dots = weighed.join(vectors.withColumnRenamed("w", "tw"), "term").groupBy("key", "line", "notice").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = dots.join(line_norm, ["key", "line"]).join(norms, "notice").select(
        "key", "licence", F.round(F.col("dot") / (F.col("l_norm") * F.col("t_norm")), 6).alias("score"))
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("b"))
    return best.select("key", F.col("b.licence").alias("licence"), (-F.col("b.minus")).alias("score"))


def parents(path: Column) -> Column:
    """All directories above a path, nearest first; the root is the empty text."""
    steps = F.split(path, "/")
    return F.transform(F.sequence(F.size(steps) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Licence of every file: (doc_id, path, licence, score, origin).

    ``files`` has doc_id, path and text. A file whose best line reaches
    OWN_SCORE has that licence (origin ``own``). One that reaches FILE_SCORE
    speaks for its directory; among several the first path does. Any other
    file takes the licence of the nearest directory above that has one
    (``inherited``, score of the file it comes from), else NULL and ``none``.
    NULL text or NULL path: no licence of its own, nothing to inherit.
    Ties go to the first licence by name. Rows that repeat an id and path
    share a result; an empty table gives none.
    """
    templates = templates or TEMPLATES
    keyed = files.select(F.col("doc_id").cast("long").alias("doc_id"), "path", "text", F.xxhash64("doc_id", "path", "text").alias("key"))
    own = staged(match_files(keyed, templates).where(F.col("score") >= OWN_SCORE), "licences")
    named = staged(keyed.select("doc_id", "path", "key").join(own, "key", "left"), "licensed")
    directory = F.regexp_replace(F.col("path"), "/?[^/]*$", "")
    speaks = named.where((F.col("score") >= FILE_SCORE) & F.col("path").isNotNull()).groupBy(directory.alias("dir")).agg(
        F.min(F.struct("path", "licence", "score")).alias("from"))
    # Directories are few beside files: each is resolved once against those above it.
    dirs = named.where("path is not null").select(directory.alias("leaf")).distinct()
    above = dirs.select("leaf", F.posexplode(F.concat(F.array("leaf"), F.when(F.col("leaf") == "", F.array().cast("array<string>")).otherwise(parents(F.col("leaf"))))).alias("up", "dir"))
    nearest = above.join(speaks, "dir").groupBy("leaf").agg(F.min(F.struct("up", "from")).alias("near")).select("leaf", "near.from.*").select(
        "leaf", F.col("licence").alias("d_licence"), F.col("score").alias("d_score"))
    return named.withColumn("leaf", directory).join(nearest, "leaf", "left").select(
        "doc_id", "path", F.coalesce("licence", "d_licence").alias("licence"), F.coalesce("score", "d_score").alias("score"),
        F.when(F.col("licence").isNotNull(), "own").when(F.col("d_licence").isNotNull(), "inherited").otherwise("none").alias("origin"))


def with_paths(docs: DataFrame) -> DataFrame:
    """Paths for a table without any: source, then directories of 1,000 and of 50 consecutive ids."""
    return docs.select("doc_id", "text", F.concat_ws(
        "/", F.coalesce("source", F.lit("unknown")), F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 50), F.col("doc_id")).alias("path"))
