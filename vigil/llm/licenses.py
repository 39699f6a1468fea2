"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

DataFrame operations only. Words are runs of letters and digits, lower-cased; a shingle is three words. A template of n
words is looked for in windows of the smallest power of two W with n <= W / 2 + 1, every W / 2 words, so that a whole
occurrence always lies in one window. There are ``BANDS`` bands of one minimum each: a window that contains 80 % of a
template has a Jaccard similarity of at least 0.8 * (n - 2) / (W - 2) >= 0.2 with it and shares a band with
probability 1 - (1 - 0.2)^32 > 0.999; a whole occurrence with more than 1 - (1 - 0.25)^32 > 0.9998.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHINGLE = 3
BANDS = 32
PERCENT = 80

# Names and public notices of common licenses.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License",
    "MIT-licensed": "Licensed under the MIT License",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
           " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
           " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0": "You may not use this file except in compliance with the License. You may obtain a copy of the License at"
                  " http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
           " License as published by the Free Software Foundation",
    "LGPL": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
            " Public License as published by the Free Software Foundation",
    "AGPL": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
           " following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
            " liable for any damages arising from the use of this software",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
}


def _shingles(text: str) -> str:
    """SQL for the hashes of all runs of three words of a text, and of a shorter text as a whole."""
    found = f"filter(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), x -> x <> '')"
    return (
        f"transform(array({found}), w -> if(size(w) < {SHINGLE}, if(size(w) = 0, array(), array(xxhash64(w))),"
        f" transform(slice(w, 1, size(w) - {SHINGLE - 1}), (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2)))))[0]"
    )


def _bands(shingles: str) -> str:
    """SQL for the minimum of every band, tagged by its number."""
    return f"transform(sequence(0, {BANDS - 1}), k -> xxhash64(k, array_min(transform({shingles}, x -> xxhash64(x, k)))))"


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, width, of, bands) of each template: window width, its distinct shingles, its bands."""
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in sorted(templates.items()))))
    table = spark.range(1, numPartitions=1).select(rows.alias("t")).selectExpr("t.license", f"{_shingles('t.text')} AS of")
    return table.selectExpr(
        "license", f"CAST(pow(2, greatest(3, ceil(log2(2 * (size(of) + {SHINGLE - 2}))))) AS INT) AS width", "array_distinct(of) AS of"
    ).withColumn("bands", F.expr(_bands("of")))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = PERCENT) -> DataFrame:
    """Licenses named in the whole texts of ``docs`` (doc_id, text): doc_id, license, containment, first_word, windows.

    One row for each document and template of which some window contains at least ``percent`` of the shingles: the best
    containment, where the first such window begins, and how many windows hold it. A window does not hold a template
    that is only a variant of another one of that width, there or in the next windows: one of which a larger part is
    contained, at common places, and which has all shingles that were found of the variant. A window without any shingle of any template contains nothing
    of one and is skipped before the bands. A null, blank or unlicensed text gives no row; rows of one doc_id are one
    document; an empty table gives an empty result; other columns are not read. Templates are a bounded list, so they are
    broadcast and their hashes are constants of the plan.
    """
    spark = docs.sparkSession
    table = template_table(spark, TEMPLATES if templates is None else templates)
    known = table.select("width", F.explode("of").alias("h")).distinct().collect()
    widths = sorted({r["width"] for r in known})
    hashes = ", ".join(f"{r}L" if r > -(1 << 63) else "CAST('-9223372036854775808' AS BIGINT)" for r in sorted({r["h"] for r in known}))
    found = docs.select("doc_id", F.expr(_shingles("text")).alias("all"))
    hits = found.withColumn("hits", F.expr(f"filter(transform(all, (x, i) -> if(x IN ({hashes}), i, -1)), i -> i >= 0)")).filter("size(hits) > 0")
    starts = ", ".join(
        f"transform(array_distinct(flatten(transform(hits, i -> filter(array(i div {w // 2} - 1, i div {w // 2}), b -> b >= 0)))),"
        f" b -> struct({w} AS width, CAST(b * {w // 2} AS INT) AS start, slice(all, CAST(b * {w // 2} AS INT) + 1, {w - SHINGLE + 1}) AS has))"
        for w in widths
    )
    windows = hits.select("doc_id", F.expr(f"inline(concat({starts}))"))
    banded = windows.select("doc_id", "width", "start", "has", F.explode(F.expr(_bands("has"))).alias("band"))
    bands = table.select("license", "width", "of", F.explode("bands").alias("band"))
    common = F.expr("size(array_intersect(has, of))")
    matched = banded.join(F.broadcast(bands), ["width", "band"]).filter(100 * common >= percent * F.size("of"))
    found_of = matched.select(
        "doc_id", "width", "start", "license", "of", (common / F.size("of")).alias("containment"), F.array_intersect("has", "of").alias("own"),
        F.expr("filter(transform(has, (x, i) -> if(array_contains(of, x), xxhash64(start + i, x), NULL)), x -> x IS NOT NULL)").alias("at"),
    )
    held = found_of.groupBy("doc_id", "width", "start", "license").agg(F.max(F.struct("containment", "at", "own", "of")).alias("most"))
    held = held.select("doc_id", "width", "start", "license", "most.*").withColumn("slot", F.expr("2 * start div width"))
    here = Window.partitionBy("doc_id", "width").orderBy("slot").rangeBetween(-1, 1)  # an occurrence can be cut by a window
    variant = "exists(others, o -> o.containment > containment AND arrays_overlap(o.at, at) AND size(array_except(own, o.of)) = 0)"
    best = held.withColumn("others", F.collect_list(F.struct("containment", "at", "of")).over(here)).filter(f"NOT {variant}")
    return best.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min("start").cast("bigint").alias("first_word"),
        F.countDistinct("start").alias("windows"),
    )
