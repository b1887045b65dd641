"""Licences of files: notices found by sparse TF-IDF cosine, and inheritance from directories.

A text, its lines, and windows of it across lines are compared with template texts of about the
window's length: notices, headers, SPDX tags, and the titles and first sentences of whole
licences. Only passages are taken apart that hold one of the templates' anchors: by Cauchy and
Schwarz, a passage without any of them can't reach the threshold. Common words come last among
anchors. A file without a notice of its own inherits from the nearest directory above it that has
a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import saved

_GNU = "GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version"
_BODY = "Copyright (C) {1} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_KEPT = _BSD + ": Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."


def _gnu(name: str, short: str, version: str, date: str, year: str) -> list[str]:
    return [
        f"This work is licensed under the {name}, version {version}",
        f"Licensed under the {name}, version {version}",
        f"{name} Version {version}, {date} " + _BODY.format(name, year),
        f"{name} Version {version}, {date}",
        _GNU.format(name.removeprefix('GNU '), version),
        f"SPDX-License-Identifier: {short}-{version}.0-only",
        f"SPDX-License-Identifier: {short}-{version}.0-or-later",
    ]


# Usual notices, headers, tags and beginnings of public licences.
TEMPLATES = {
    "AGPL-3.0": _gnu("GNU Affero General Public License", "AGPL", "3", "19 November 2007", "2007"),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": [
        _BSD,
        _KEPT,
        "BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "GPL-2.0": _gnu("GNU General Public License", "GPL", "2", "June 1991", "1989, 1991"),
    "GPL-3.0": _gnu("GNU General Public License", "GPL", "3", "29 June 2007", "2007"),
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "ISC License",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "LGPL", "3", "29 June 2007", "2007"),
    "MIT": [
        "Released under the MIT License",
        "The MIT License",
        "MIT License",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}

#: Words that most texts hold, here or in other languages: they are the last to become anchors.
COMMON = frozenset("a and are as at be by for from have in is it its not of only or that the this to with you mit".split())

TERM = r"[a-z0-9]+"


def template_weights(templates: dict[str, str]) -> tuple[dict[str, dict[str, float]], dict[str, float], float]:
    """TF-IDF of each template at length one; the IDF of each term; that of any other term."""
    counts = {name: Counter(re.findall(TERM, text.lower())) for name, text in templates.items()}
    present = Counter(term for terms in counts.values() for term in terms)
    idf = {term: math.log((1 + len(templates)) / (1 + n)) + 1 for term, n in present.items()}
    weights = {}
    for name, terms in counts.items():
        raw = {term: n * idf[term] for term, n in terms.items()}
        length = math.sqrt(sum(w * w for w in raw.values()))
        weights[name] = {term: w / length for term, w in raw.items()}
    return weights, idf, math.log(1 + len(templates)) + 1


def anchor_terms(terms: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a passage must hold one to reach the threshold with the template."""
    anchors: set[str] = set()
    rest = 1.0
    for term, weight in sorted(terms.items(), key=lambda x: (x[0] in COMMON, -x[1], x[0])):
        if rest < threshold * threshold:
            break
        anchors.add(term)
        rest -= weight * weight
    return sorted(anchors)


def _windows(terms: Column, anchors: list[str], length: int) -> Column:
    """The windows of ``length`` terms of a text that hold an anchor."""
    stride = max(1, length // 8)
    last = F.size(terms) - 1
    held = F.array(*map(F.lit, anchors))
    places = F.filter(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")), lambda i: F.array_contains(held, F.get(terms, i)))
    first = lambda i: F.ceil(F.greatest(i - (length - 1), F.lit(0)) / stride).cast("int") * stride
    starts = F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(F.least(first(i), i - i % stride), i, F.lit(stride)))))
    return F.transform(starts, lambda i: F.slice(terms, i + 1, F.lit(length)))


def license_scan(
    spark: SparkSession,
    files: DataFrame,
    path: Column,
    is_license_file: Column,
    id_column: str = "doc_id",
    text: str = "text",
    templates: dict[str, str | list[str]] | None = None,
    threshold: float = 0.7,
) -> DataFrame:
    """For each row its id, ``path``, ``own_license``, ``own_score``, ``license`` and ``inherited_from``.

    ``own_license`` is the licence one of whose templates is most like any window, if the cosine is ``threshold`` or more
    (ties: the first name); ``license`` is that or the one of the nearest directory above with a
    licence file, whose name is then ``inherited_from``. A directory's licence is the best match
    among its licence files. NULL and empty texts hold no notice; a NULL path has no directory;
    repeated rows each get a row; further columns are ignored; no rows give no rows.
    """
    listed = TEMPLATES if templates is None else templates
    texts = [(name, text) for name in sorted(listed) for text in ([listed[name]] if isinstance(listed[name], str) else listed[name])]
    names = [name for name, _ in texts]
    by_place, idf, other = template_weights({str(k): text for k, (_, text) in enumerate(texts)})
    weights = [by_place[str(k)] for k in range(len(texts))]
    lengths = [len(re.findall(TERM, text.lower())) for _, text in texts]
    anchors = [anchor_terms(w, threshold) for w in weights]
    everything = sorted(set().union(*anchors))
    any_of = "|".join(everything)
    holds = lambda c: c.rlike(rf"(?i)(?<![a-z0-9])(?:{any_of})(?![a-z0-9])") if everything else F.lit(False)
    rows = files.select(
        F.col(id_column).alias("id"), path.alias("path"), F.coalesce(is_license_file, F.lit(False)).alias("is_file"),
        F.xxhash64(F.col(id_column), path, F.col(text)).alias("row"), F.col(text).alias("text"),
    )
    # Equal rows have equal passages, so one of them will do.
    hit = rows.where(holds(F.col("text"))).select("row", "text").dropDuplicates(["row"])
    terms = F.regexp_extract_all(F.lower("text"), F.lit(f"({TERM})"), F.lit(1))
    lines = F.transform(F.split(F.lower("text"), "\n"), lambda x: F.regexp_extract_all(x, F.lit(f"({TERM})"), F.lit(1)))
    tokens = hit.select("row", terms.alias("terms"), lines.alias("lines"))
    held = F.array(*map(F.lit, everything)).cast("array<string>")
    # The whole text and its lines, for notices of other lengths than the templates'; then windows
    # of the lengths of the templates that have the anchor, begun at each eighth of a length.
    slices = [F.array("terms"), F.filter("lines", lambda x: F.arrays_overlap(x, held))]
    for length in sorted(set(lengths)):
        of_length = sorted({term for some, n in zip(anchors, lengths, strict=True) for term in some if n == length})
        if of_length:
            slices.append(_windows(F.col("terms"), of_length, length))
    windows = tokens.select("row", F.posexplode(F.concat(*slices)).alias("window", "terms"))
    # Terms are a fixed few; each window is summed up where it stands, in one row.
    counted = windows.select("row", "window", F.explode("terms").alias("term")).groupBy("row", "window", "term").count()
    table = spark.createDataFrame(
        [(term, idf[term], *[w.get(term, 0.0) for w in weights]) for term in sorted(idf)] or [("", 1.0, *[0.0] * len(names))],
        "term string, idf double" + "".join(f", w{k} double" for k in range(len(names))),
    )
    weighed = counted.join(F.broadcast(table), "term", "left")  # as many rows as the templates have terms
    value = F.col("count") * F.coalesce("idf", F.lit(other))
    scores = weighed.groupBy("row", "window").agg(
        F.sqrt(F.sum(value * value)).alias("length"),
        *[F.sum(value * F.coalesce(f"w{k}", F.lit(0.0))).alias(f"s{k}") for k in range(len(names))],
    )
    each = F.array(*[F.struct((F.round(F.col(f"s{k}") / F.col("length"), 9)).alias("score"), F.lit(-k).alias("k")) for k in range(len(names))])
    best = scores.groupBy("row").agg(F.max(F.array_max(each)).alias("best")).where(F.col("best.score") >= threshold)
    own = saved(
        spark,
        best.select(
            "row", F.element_at(F.array(*map(F.lit, names)), 1 - F.col("best.k")).alias("own_license"), F.col("best.score").alias("own_score")
        ),
        "own-licenses",
    )
    parent = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", ""))
    known = saved(
        spark,
        rows.select("id", "path", "is_file", "row").join(own, "row", "left").withColumn("directory", parent),
        "scanned-files",
    )
    of_directory = known.where("is_file AND own_license IS NOT NULL AND directory IS NOT NULL").groupBy("directory").agg(
        F.min(F.struct((-F.col("own_score")).alias("score"), "own_license")).alias("found")
    )
    of_directory = saved(spark, of_directory.select(F.col("directory").alias("above"), F.col("found.own_license").alias("license")), "directory-licenses")
    # Each directory once, with itself and those above it.
    directories = known.where("directory IS NOT NULL").select("directory").distinct()
    parts = F.split("directory", "/")
    lines = directories.select("directory", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth")).withColumn(
        "above", F.expr("array_join(slice(split(directory, '/'), 1, depth), '/')")
    )
    nearest = lines.join(of_directory, "above").groupBy("directory").agg(F.max(F.struct("depth", "above", "license")).alias("near"))
    nearest = saved(spark, nearest.select("directory", F.col("near.above").alias("_above"), F.col("near.license").alias("_license")), "inherited")
    from_above = F.col("own_license").isNull() & F.col("_license").isNotNull()
    return known.join(nearest, "directory", "left").select(
        F.col("id").alias(id_column),
        "path",
        "own_license",
        "own_score",
        F.coalesce("own_license", "_license").alias("license"),
        F.when(from_above, F.col("_above")).alias("inherited_from"),
    )
