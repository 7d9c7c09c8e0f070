"""Licences of files: TF-IDF cosine to templates, then inheritance along directories.

Only DataFrame functions. Terms are runs of letters and digits in lower case, weighted
by their inverse document frequency over all files; terms that no template has weigh as if no
file had them. Every line of every file, and the whole text of files named like a licence, is
compared with every template, and the best cosine from ``SIMILARITY`` on decides.

Nothing is lost by the first filter: for every template, the terms of least weight that cannot
reach the threshold together are left out, and a line without any of the others cannot reach
it either. Only lines with such a term are taken apart.

A file without a licence of its own takes the one of the nearest directory above it that holds a
licence file with one. Null texts have no licence of their own, null paths inherit nothing;
equal rows come back each with the same result, and ties go to the first licence in order.
"""

from __future__ import annotations

from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.storage import settle

SIMILARITY = 0.6
LICENSE_FILE = r"^(licen[cs]e|copying|notice)(\..*)?$"

# The usual words of public licences.
TEMPLATES = (
    ("AGPL-3.0", "licensed under the GNU Affero General Public License version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released under CC0 1.0 Universal Public Domain Dedication"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "Released under the ISC License"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, version 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)


def _terms(column: Column | str) -> Column:
    return F.filter(F.split(F.lower(column), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _template_counts(templates) -> list[tuple[int, str, dict[str, int]]]:
    """(number, licence, how often each term occurs); terms of templates are ASCII."""
    found = []
    for number, (name, text) in enumerate(templates):
        counts: dict[str, int] = {}
        letters = "".join(c if c.isalnum() else " " for c in text.lower())
        for term in letters.split():
            counts[term] = counts.get(term, 0) + 1
        found.append((number, name, counts))
    return found


def _telling_terms(templates, weight: dict[str, float], similarity: float) -> set[str]:
    """Terms of which a text needs one at least to come up to the similarity."""
    telling: set[str] = set()
    for _, _, counts in templates:
        squares = sorted(((n * weight[t]) ** 2, t) for t, n in counts.items())
        limit = similarity**2 * sum(s for s, _ in squares) * (1 - 1e-9)
        total = 0.0
        for square, term in squares:
            total += square
            if total >= limit:
                telling.add(term)
    return telling


def scan(files: DataFrame, similarity: float = SIMILARITY, templates=TEMPLATES) -> DataFrame:
    """``(file_id, path, license, score, origin, from_dir)`` for every row of ``files``.

    ``files`` has file_id, path and text. ``origin`` is ``text`` or ``directory``, or null.
    """
    spark = files.sparkSession
    files = files.select(
        "file_id", "path", "text", F.xxhash64("file_id", "path", "text").alias("key")
    )
    counted = _template_counts(templates)
    vocabulary = sorted({t for _, _, counts in counted for t in counts})
    known = F.array(*[F.lit(t) for t in vocabulary])
    # One row per term of the templates.
    frequency = {
        r["term"]: r["n"]
        for r in files.select(F.explode(F.array_intersect(_terms("text"), known)).alias("term"))
        .groupBy("term").agg(F.count("*").alias("n")).collect()
    }
    total = files.count()
    weight = {t: log((1 + total) / (1 + frequency.get(t, 0))) + 1 for t in vocabulary}
    other = log(1 + total) + 1

    telling = sorted(_telling_terms(counted, weight, similarity))
    has_one = rf"(?<![\p{{L}}\p{{N}}])({'|'.join(telling)})(?![\p{{L}}\p{{N}}])"
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    lines = files.filter(F.lower("text").rlike(has_one)).select(
        "key",
        F.explode(F.concat(
            F.when(name.rlike(LICENSE_FILE), F.array("text")).otherwise(F.array()),
            F.split("text", "\n"),
        )).alias("line"),
    )
    lines = lines.filter(F.lower("line").rlike(has_one)).distinct()

    words = lines.select(
        "key", F.xxhash64("line").alias("unit"), F.explode(_terms("line")).alias("term")
    ).groupBy("key", "unit", "term").agg(F.count("*").alias("n"))
    weights = spark.createDataFrame(sorted(weight.items()), "term string, weight double")
    norms = {k: sqrt(sum((n * weight[t]) ** 2 for t, n in c.items())) for k, _, c in counted}
    vectors = spark.createDataFrame(
        [(t, k, name, n * weight[t] / norms[k]) for k, name, c in counted for t, n in c.items()],
        "term string, template int, license string, part double",
    )
    # Weights and vectors are as small as the templates are.
    weighed = words.join(F.broadcast(weights), "term", "left").select(
        "key", "unit", "term", (F.col("n") * F.coalesce("weight", F.lit(other))).alias("w")
    )
    weighed = settle(weighed, "terms")
    norm = weighed.groupBy("key", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(vectors), "term").groupBy(
        "key", "unit", "template", "license"
    ).agg(F.sum(F.col("w") * F.col("part")).alias("dot"))
    own = (
        dots.join(norm, ["key", "unit"])
        .withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
        .filter(F.col("score") >= similarity)
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
        .select("key", F.col("best.license").alias("own"), (-F.col("best.s")).alias("own_score"))
    )
    own = settle(own, "own-licences")
    return _inherit(files.drop("text"), own)


def _inherit(files: DataFrame, own: DataFrame) -> DataFrame:
    """Give files without a licence the one of the nearest directory above that has one."""
    marked = files.join(own, "key", "left")
    pieces = F.split("path", "/")
    above = F.expr(
        "transform(sequence(0, size(split(path, '/')) - 1),"
        " k -> struct(k as depth, array_join(slice(split(path, '/'), 1, k), '/') as dir))"
    )
    directories = (
        files.filter(F.lower(F.element_at(pieces, -1)).rlike(LICENSE_FILE))
        .join(own, "key")
        .select(F.element_at(above, -1)["dir"].alias("dir"), "own", "own_score", "path")
        .groupBy("dir")
        .agg(F.min(F.struct((-F.col("own_score")).alias("s"), "own", "path")).alias("best"))
        .select("dir", F.col("best.own").alias("from_license"), (-F.col("best.s")).alias("from_score"))
    )
    # A file looks for its directories once, however many files share a directory.
    place = files.filter("path is not null").select(F.element_at(above, -1)["dir"].alias("home"))
    nearest = (
        place.distinct().select("home", F.expr(
            "explode(transform(sequence(0, if(home = '', 0, size(split(home, '/')))),"
            " k -> struct(k as depth, array_join(slice(split(home, '/'), 1, k), '/') as dir))) as d"
        ))
        .select("home", "d.depth", "d.dir")
        .join(directories, "dir")
        .groupBy("home")
        .agg(F.max_by(F.struct("from_license", "from_score", "dir"), "depth").alias("n"))
    )
    return (
        marked.withColumn("home", F.when(F.col("path").isNotNull(), F.element_at(above, -1)["dir"]))
        .join(nearest, "home", "left")
        .select(
            "file_id", "path",
            F.coalesce("own", "n.from_license").alias("license"),
            F.coalesce("own_score", "n.from_score").alias("score"),
            F.when(F.col("own").isNotNull(), "text")
            .when(F.col("n").isNotNull(), "directory").alias("origin"),
            F.when(F.col("own").isNull(), F.col("n.dir")).alias("from_dir"),
        )
    )
