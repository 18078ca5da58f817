"""License notices in documents, without Python on the executors.

Words are runs of letters and digits, lower-cased; shingles are five words. Texts and templates are cut into overlapping windows of a few
lengths, and each window's MinHash signature into bands. A template's windows start at every word; those of a text at every
quarter of their length. A text's windows that share a band with a template's retrieve it, and the
shares of the template's shingles that the whole text holds decide.

With BANDS bands of ROWS values, windows of Jaccard similarity ``LIKE`` share a band with a probability of 1 - (1 - LIKE ** ROWS) ** BANDS, over
0.999. A shared band means a shared smallest shingle, so only windows that hold some template shingle are signed.

Templates are a stated table, held in blocks of ``SHINGLES_PER_BLOCK`` shingles as part of the plan; documents are
read once for each block and never shuffled before retrieval.

Defined results: null and empty texts match nothing; templates of fewer than five words are left out; equal templates all
match; a repeated doc_id gives one row for each license; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
WINDOWS = (5, 8, 16, 32)
BANDS = 16
ROWS = 2
LIKE = 0.6
CONTAINED = 0.8
SHINGLES_PER_BLOCK = 5000
SEPARATOR = r"[^\p{L}\p{N}]+"

#: Widely used license notices.
NOTICES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission",
    "cc-by-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies",
    "mit-line": "Released under the MIT License",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    # Near variants each have a template, so that the higher containment tells them apart.
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3",
    "apache-2.0-short": "under the Apache License 2.0",
    "apache-2.0-short-version": "under the Apache License, Version 2.0",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0",
    "bsd-2-line": "Licensed under the BSD 2-Clause License",
    "bsd-3-line": "Licensed under the BSD 3-Clause License",
    "bsd-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "bsd-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "cc-by-3.0-unported": "This work is licensed under the Creative Commons Attribution 3.0 Unported License",
    "cc-by-4.0-short": "under CC BY 4.0",
    "cc-by-4.0-short-a": "under a CC BY 4.0",
    "cc-by-4.0-short-license": "CC BY 4.0 license",
    "cc-by-4.0-short-the": "under the CC BY 4.0",
    "cc-by-nc-3.0-unported": "This work is licensed under the Creative Commons Attribution-NonCommercial 3.0 Unported License",
    "cc-by-nc-4.0-international": "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-4.0-short": "CC BY-NC 4.0",
    "cc-by-nc-nd-3.0-unported": "This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License",
    "cc-by-nc-nd-4.0": "This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "cc-by-nc-nd-4.0-short": "CC BY-NC-ND 4.0",
    "cc-by-nc-nd-url": "creativecommons.org/licenses/by-nc-nd/4.0",
    "cc-by-nc-sa-3.0-unported": "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License",
    "cc-by-nc-sa-4.0": "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nc-sa-4.0-short": "CC BY-NC-SA 4.0",
    "cc-by-nc-sa-url": "creativecommons.org/licenses/by-nc-sa/4.0",
    "cc-by-nc-url": "creativecommons.org/licenses/by-nc/4.0",
    "cc-by-nd-3.0-unported": "This work is licensed under the Creative Commons Attribution-NoDerivs 3.0 Unported License",
    "cc-by-nd-4.0": "This work is licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-nd-4.0-short": "CC BY-ND 4.0",
    "cc-by-nd-url": "creativecommons.org/licenses/by-nd/4.0",
    "cc-by-sa-3.0-unported": "This work is licensed under the Creative Commons Attribution-ShareAlike 3.0 Unported License",
    "cc-by-sa-4.0-short": "CC BY-SA 4.0",
    "cc-by-sa-url": "creativecommons.org/licenses/by-sa/4.0",
    "cc-by-url": "creativecommons.org/licenses/by/4.0",
    "cc0-url": "creativecommons.org/publicdomain/zero/1.0",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2",
    "gpl-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "isc-line": "Licensed under the ISC License",
    "lgpl-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "lgpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3",
    "mit-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-distributed": "Distributed under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-licensed-short": "is licensed under the MIT license",
    "mit-terms": "under the terms of the MIT License",
    "mpl-2.0-line": "Licensed under the Mozilla Public License 2.0",
    "zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
}


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(NOTICES.items()), "license string, text string")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once for each row however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingles(text: Column) -> Column:
    """Hashes of all shingles in order; null and short texts have none."""

    def hashed(words: Column) -> Column:
        last = F.size(words) - SHINGLE
        shingles = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))
        return F.when(last >= 0, shingles).otherwise(F.array().cast("array<bigint>"))

    return _with(F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), lambda w: F.xxhash64(w)), hashed)


def _band_keys(shingles: Column) -> Column:
    """One key for each band of the window's signature."""
    smallest = [_smallest(shingles, k) for k in range(BANDS * ROWS)]
    return F.array(*(F.xxhash64(F.lit(b), *smallest[b * ROWS : (b + 1) * ROWS]) for b in range(BANDS)))


def _template_windows(templates: DataFrame) -> DataFrame:
    """``license``, ``length`` and the ``shingles`` of each window: of the longest length that the template has, and 5."""
    number = F.size("all") + SHINGLE - 1
    longest = F.coalesce(*(F.when(number >= w, F.lit(w)) for w in sorted(WINDOWS, reverse=True)))
    cut = templates.withColumn("length", F.explode(F.array_distinct(F.array(longest, F.lit(WINDOWS[0])))))
    starts = F.sequence(F.lit(1), F.size("all") - F.col("length") + SHINGLE)
    cut = cut.withColumn("start", F.explode(starts))
    return cut.select("license", "length", F.slice("all", F.col("start"), F.col("length") - SHINGLE + 1).alias("shingles"))


def _starts(position: Column, length: int) -> Column:
    """Starts, counted from 0, of the windows of ``length`` words that hold the shingle at ``position`` and begin at a quarter of it."""
    step = max(1, length // 4)
    first = F.greatest(F.ceil((position - (length - SHINGLE)) / step), F.lit(0))
    return F.transform(F.sequence(first, F.floor(position / step)), lambda k: (k * step).cast("int"))


def _windows(positions: Column, length: int) -> Column:
    """Length and start of all windows of ``length`` words that hold a shingle at one of the ``positions``."""
    starts = F.flatten(F.transform(positions, lambda p: _starts(p, length)))
    return F.transform(F.array_distinct(starts), lambda s: F.struct(F.lit(length).alias("length"), s.alias("start")))


def _smallest(shingles: Column, function: int) -> Column:
    return F.array_min(F.transform(shingles, lambda v: F.xxhash64(v, F.lit(function))))


def find_licenses(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """``doc_id``, ``license``, ``containment`` of each template (license, text) that a document's text holds."""
    spark = documents.sparkSession
    shingled = templates.filter("license IS NOT NULL").select("license", F.array_distinct(_shingles(F.trim(F.regexp_replace("text", SEPARATOR, " ")))).alias("all"))
    shingled = shingled.filter(F.size("all") > 0)
    rows = sorted((r.license, r["all"]) for r in shingled.collect())
    blocks, size = [[]], 0
    for license, shingles in rows:
        if size and size + len(shingles) > SHINGLES_PER_BLOCK:
            blocks, size = [*blocks, []], 0
        blocks[-1].append((license, shingles))
        size += len(shingles)
    found = spark.createDataFrame([], "doc_id long, license string, containment double")
    for block in blocks:
        if block:
            found = found.unionByName(_find(documents, spark.createDataFrame(block, "license string, all array<bigint>"), sorted({s for _, b in block for s in b})))
    return found


def _find(documents: DataFrame, templates: DataFrame, known: list[int]) -> DataFrame:
    texts = documents.select(F.col("doc_id").cast("long"), _shingles(F.col("text")).alias("all"))
    held = F.array_intersect("all", F.lit(known).cast("array<bigint>"))
    texts = texts.withColumn("held", held).filter(F.size("held") > 0)
    both = F.struct("all", "held")
    at = _with(both, lambda b: F.filter(F.sequence(F.lit(0), F.size(b["all"]) - 1), lambda i: F.array_contains(b["held"], F.get(b["all"], i))))
    windows = _with(at, lambda positions: F.flatten(F.array(*(_windows(positions, w) for w in WINDOWS))))
    texts = texts.select("doc_id", "all", "held", F.explode(F.array_distinct(windows)).alias("window"))
    part = F.slice("all", F.col("window.start") + 1, F.col("window.length") - SHINGLE + 1)
    texts = texts.select("doc_id", "held", F.col("window.length").alias("length"), part.alias("shingles"))
    texts = texts.select("doc_id", "held", "length", F.explode(F.array_distinct(_band_keys(F.col("shingles")))).alias("band"))
    bands = _template_windows(templates).select("license", "length", F.explode(F.array_distinct(_band_keys(F.col("shingles")))).alias("band")).distinct()
    retrieved = texts.join(bands, ["length", "band"]).join(templates, "license")
    containment = F.size(F.array_intersect("held", "all")) / F.size("all")
    matches = retrieved.select("doc_id", "license", containment.alias("containment")).filter(F.col("containment") >= CONTAINED)
    return matches.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"))
