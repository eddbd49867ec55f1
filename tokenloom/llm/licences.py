"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance along directories.

What is compared is every line of a text, wherever it stands, that holds one of ``MARKERS``, and every paragraph that does,
so headers spread over several lines are seen whole. Of a file named like a licence, every paragraph is compared with
the opening paragraphs of the licences themselves. A paragraph with so many distinct terms that no template has
that the words of the longest template, each said once, can't make up for them (they weigh no more than the rarest term, as
those do) is running text, of which only the lines are compared. Terms are words of letters and digits. A term of a template is weighted by the logarithm of its
rarity among all documents; other terms weigh as much as the rarest, so a line that says more than a template is less like
it. Template terms are a fixed, small table, so their weights are broadcast; document terms are joined sparsely. A file's
own licence is its nearest template with a cosine of at least ``THRESHOLD``. A file without one inherits that of the
licence file in its nearest ancestor directory, found by joining all ancestors of its path with the directories.

Only DataFrame functions are used. The join on directories has one row for each directory on its right side, so a
directory with very many files is split by adaptive execution.

Edge cases: a null text has no header, a null path no directory; ties of templates go to the first name, of licence files
in one directory to the higher score, then the first name; repeated rows are judged each; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Usual one-line notices, titles, tags and opening paragraphs of well-known licences.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Attribution 4.0 International"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC0-1.0", "Released under the CC0 1.0 Universal public domain dedication license."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("ISC", "ISC License"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "The MIT License (MIT)"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
]
# What a notice outside a licence file has, names of licence files, and what parts paragraphs.
MARKERS = "(?i)licen[cs]e|copyright|spdx"
LICENCE_NAMES = "(?i)^(un)?licen[cs]e|^copying|^notice"
PARAGRAPH = "\n[ \t\r/*#;-]*\n"
THRESHOLD = 0.6


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")


def template_table(spark: SparkSession, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(templates or TEMPLATES)]
    return spark.createDataFrame(rows, "template int, licence string, notice string")


def rarity(files: DataFrame, template_terms: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(term, idf) of the templates' terms over all files."""
    words = F.array(*[F.lit(t) for t in vocabulary])
    seen = files.select(F.explode(F.concat(F.array_intersect(terms(F.col("text")), words), F.array(F.lit("")))).alias("term"))
    counted = seen.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # The empty term is counted once for each file.
    # One window over the templates' terms alone, a fixed small table.
    total = F.coalesce(F.max(F.when(F.col("term") == "", F.col("df"))).over(Window.partitionBy(F.lit(1))), F.lit(0))
    known = template_terms.select("term").union(template_terms.sparkSession.createDataFrame([("",)], "term string")).distinct()
    return known.join(counted, "term", "left").select(
        "term", F.when(F.col("term") == "", F.log(total + 1.0) + 1.0).otherwise(F.log((total + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0).alias("idf")
    )


def own_licences(files: DataFrame, templates: DataFrame) -> DataFrame:
    """(row, licence, score) of the files with a line or paragraph near a template. ``files``: row, name, text."""
    notice = templates.select("template", "licence", F.explode(terms(F.col("notice"))).alias("term"))
    counted = notice.groupBy("template", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))
    vocabulary = [r[0] for r in counted.select("term").distinct().orderBy("term").collect()]
    idf = rarity(files, counted.select("term"), vocabulary)
    weighed = counted.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weights = weighed.join(norms, "template").select("template", "licence", "term", "idf", (F.col("w") / F.col("norm")).alias("unit"))

    named = F.coalesce(F.col("name").rlike(LICENCE_NAMES), F.lit(False))
    marked = files.where(F.col("text").rlike(MARKERS) | (named & F.col("text").isNotNull()))
    says = lambda part: part.rlike(MARKERS)
    lines = F.filter(F.split("text", "\n"), says)
    paragraphs = F.filter(F.split("text", PARAGRAPH), lambda part: named | says(part))
    # A paragraph of one line is that line.
    known = F.array(*[F.lit(t) for t in vocabulary])
    longest = counted.groupBy("template").count().agg(F.max("count")).first()[0] or 0
    foreign = longest * (1 / THRESHOLD**2 - 1)
    several = F.filter(
        paragraphs,
        lambda part: (F.contains(part, F.lit("\n")) | ~says(part)) & (F.size(F.array_except(terms(part), known)) <= foreign),
    )
    said = marked.select("row", F.posexplode(F.concat(lines, several)).alias("line", "said"))
    units = said.select("row", "line", F.explode(terms(F.col("said"))).alias("term"))
    tf = units.groupBy("row", "line", "term").agg(F.count(F.lit(1)).alias("n"))
    plain = F.broadcast(idf.where("term <> ''"))
    rarest = F.broadcast(idf.where("term = ''").select(F.lit(1).alias("one"), F.col("idf").alias("most")))
    scored = (
        tf.join(plain, "term", "left")
        .withColumn("one", F.lit(1))
        .join(rarest, "one")
        .select("row", "line", "term", (F.col("n") * F.coalesce("idf", "most")).alias("w"))
    )
    length = scored.groupBy("row", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dot = (
        scored.join(F.broadcast(weights), "term")
        .groupBy("row", "line", "template", "licence")
        .agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("length"), 9)
    return (
        dot.join(length, ["row", "line"])
        .select("row", "licence", cosine.alias("score"))
        .where(F.col("score") >= THRESHOLD)
        .groupBy("row")
        .agg(F.min(F.struct((-F.col("score")).alias("less"), "licence")).alias("best"))
        .select("row", "best.licence", (-F.col("best.less")).alias("score"))
    )


def scan(files: DataFrame, row: str = "doc_id", path: str = "path", text: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """row, path, own_licence, own_score, licence, inherited_from of every file."""
    spark = files.sparkSession
    base = files.select(
        F.struct(F.col(row).alias("id"), F.col(path).alias("path"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("md5")).alias("row"),
        F.element_at(F.split(F.col(path), "/"), -1).alias("name"),
        F.col(text).alias("text"),
    )
    own = own_licences(base, template_table(spark, templates))
    judged = base.select("row", "name").join(own, "row", "left")
    steps = F.split(F.col("row.path"), "/")
    depth = F.size(steps) - 1
    home = F.array_join(F.slice(steps, 1, depth), "/")
    given = (
        judged.where(F.col("licence").isNotNull() & F.col("name").rlike(LICENCE_NAMES))
        .groupBy(home.alias("dir"))
        .agg(F.min(F.struct((-F.col("score")).alias("less"), "licence")).alias("best"))
        .select("dir", F.col("best.licence").alias("dir_licence"))
    )
    up = F.transform(F.sequence(F.lit(0), depth), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    above = judged.where(F.col("licence").isNull() & F.col("row.path").isNotNull()).select("row", F.explode(up).alias("dir")).distinct()
    nearest = (
        above.join(given, "dir")
        .groupBy("row")
        .agg(F.max(F.struct(F.length("dir").alias("deep"), "dir", "dir_licence")).alias("found"))
        .select("row", "found.dir", "found.dir_licence")
    )
    return judged.join(nearest, "row", "left").select(
        F.col("row.id").alias(row),
        F.col("row.path").alias("path"),
        F.col("licence").alias("own_licence"),
        F.col("score").alias("own_score"),
        F.coalesce("licence", "dir_licence").alias("licence"),
        F.col("dir").alias("inherited_from"),
    )
