"""Licences of files: what a file says itself, else what the nearest directory above it says.

The lines of a file, and the file as a whole, are compared with licence texts by the cosine of sparse
TF-IDF vectors. A file that as a whole is a licence text licenses its directory; files without a licence of
their own take that of the nearest directory on their path that has one.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractline.llm.common import stored

SIMILARITY = 0.6
_SPLIT = "[^\\p{L}\\p{N}]+"

# How licences are declared, and how their texts begin.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution ShareAlike."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright. CC0 1.0 Universal, public domain."),
)


def _terms(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


_VOCABULARY = sorted({t for _, text in TEMPLATES for t in _terms(text)})


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def term_weights(files: DataFrame) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each template term over all files, and that of a term in no file."""
    vocabulary = F.array(*[F.lit(t) for t in _VOCABULARY])
    found = files.select(F.explode(F.array_intersect(words_of(F.col("text")), vocabulary)).alias("term"))
    counts = {r["term"]: r["count"] for r in found.groupBy("term").count().collect()}
    n = files.count()
    return {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in _VOCABULARY}, math.log(1 + n) + 1


def template_vectors(weights: dict[str, float]) -> list[dict[str, float]]:
    """Unit vectors of the templates."""
    vectors = []
    for _, text in TEMPLATES:
        raw = {t: n * weights[t] for t, n in Counter(_terms(text)).items()}
        size = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({t: v / size for t, v in raw.items()})
    return vectors


def telling_terms(vectors: list[dict[str, float]], similarity: float) -> list[str]:
    """Terms of which any text within ``similarity`` of a template has at least one.

    The cosine of a text that shares only other terms with a template is at most the length of the template's
    vector over those, which stays below ``similarity``.
    """
    chosen: set[str] = set()
    for vector in vectors:
        rest = sum(v * v for v in vector.values())
        for term, value in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < (similarity * 0.999) ** 2:
                break
            chosen.add(term)
            rest -= value * value
    return sorted(chosen)


def own_licences(files: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``key``, ``licence``, ``score``, ``as_file`` for the files (``key``, ``text``) with a licence in them.

    The best line or the whole text counts, equal scores go to the first licence by name; ``as_file`` says
    that the whole text is a licence. Whole texts are read, however long.
    """
    spark = files.sparkSession
    weights, unknown = term_weights(files)
    vectors = template_vectors(weights)
    telling = "(?<![\\p{L}\\p{N}])(?:" + "|".join(map(re.escape, telling_terms(vectors, similarity))) + ")(?![\\p{L}\\p{N}])"
    some = files.filter(F.lower("text").rlike(telling)).select("key", "text").dropDuplicates(["key"])
    segments = F.concat(F.array("text"), F.split("text", "\n"))
    segments = some.select("key", F.posexplode(segments).alias("at", "segment")).filter(F.lower("segment").rlike(telling))
    terms = segments.select("key", "at", F.explode(words_of(F.col("segment"))).alias("term"))
    terms = terms.groupBy("key", "at", "term").agg(F.count(F.lit(1)).alias("tf"))
    # Templates and their terms are fixed values: a few hundred rows.
    rows = [(t, float(weights[t]), i, v[t]) for t in _VOCABULARY for i, v in enumerate(vectors) if t in v]
    known = spark.createDataFrame([(t, w) for t, w in weights.items()], "term string, idf double")
    parts = spark.createDataFrame([(t, i, w) for t, _, i, w in rows], "term string, template int, part double")
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(TEMPLATES)], "template int, licence string")
    weighed = terms.join(F.broadcast(known), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    weighed = stored(weighed.select("key", "at", "term", "w"), "licence-terms")
    sizes = weighed.groupBy("key", "at").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    dots = weighed.join(F.broadcast(parts), "term").groupBy("key", "at", "template").agg(F.sum(F.col("w") * F.col("part")).alias("dot"))
    scored = dots.join(sizes, ["key", "at"]).withColumn("score", F.round(F.col("dot") / F.col("size"), 6))
    scored = scored.filter(F.col("score") >= similarity).join(F.broadcast(names), "template")
    best = F.min(F.struct((-F.col("score")).alias("s"), "licence"))
    found = scored.groupBy("key").agg(best.alias("b"), F.max(F.col("at") == 0).alias("as_file"))
    return found.select("key", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"), "as_file")


def _folder(path: Column) -> Column:
    """The directory of a path; the root is the empty text."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licences(files: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``files`` (``path``, ``text``) with ``licence``, ``score``, ``origin`` and ``licensed_by``.

    ``origin`` is ``own`` or ``inherited``; without a licence all four are null. ``licensed_by`` is the file's path
    or the directory. Several licence files in a directory: the highest score counts, then the first by name. A
    file without a path inherits nothing; null and empty texts have no licence of their own. Repeated rows have
    equal results. Other columns pass through, but for columns of these four names.
    """
    made = ("licence", "score", "origin", "licensed_by")
    files = files.select(*[c for c in files.columns if c not in made])
    key = F.xxhash64("path", F.col("path").isNull(), F.md5(F.col("text").cast("binary")))
    own = stored(own_licences(files.select(key.alias("key"), "text"), similarity), "licence-own")
    light = stored(files.select(key.alias("key"), "path").distinct(), "licence-paths")

    declared = own.filter("as_file").join(light, "key").filter("path IS NOT NULL")
    best = F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b")
    by_folder = declared.groupBy(_folder(F.col("path")).alias("_above")).agg(best)
    folders = light.filter("path IS NOT NULL").select(_folder(F.col("path")).alias("_dir")).distinct()
    steps = F.split("_dir", "/")
    upward = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    above = folders.select("_dir", F.explode(F.array_distinct(upward)).alias("_above"))
    nearest = Window.partitionBy("_dir").orderBy(F.length("_above").desc())
    given = above.join(by_folder, "_above").withColumn("n", F.row_number().over(nearest)).filter("n = 1")
    given = stored(given.select("_dir", "_above", F.col("b.licence").alias("_l"), (-F.col("b.s")).alias("_s")), "licence-folders")

    mine = own.select(F.col("key").alias("_key"), F.col("licence").alias("_own"), F.col("score").alias("_score"))
    rows = files.withColumn("_k", key).withColumn("_folder", _folder(F.col("path")))
    rows = rows.join(mine, F.col("_k") == F.col("_key"), "left").join(given, F.col("_folder") == F.col("_dir"), "left")
    has = F.col("_own").isNotNull()
    return rows.select(
        *files.columns,
        F.coalesce("_own", "_l").alias("licence"),
        F.when(has, F.col("_score")).otherwise(F.col("_s")).alias("score"),
        F.when(has, F.lit("own")).when(F.col("_l").isNotNull(), F.lit("inherited")).alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("_above")).alias("licensed_by"),
    )
