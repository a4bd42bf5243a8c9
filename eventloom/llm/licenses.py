"""License scans in DataFrame functions only: MinHash bands over overlapping windows, then exact containment.

Words are lower-cased runs of ASCII letters and digits, shingles five of them. Windows come in a few sizes; each
template belongs to the least size whose windows, at their stride, cover any occurrence of it with up to a quarter
more words whole. The number of bands follows from the least Jaccard similarity that such a window can have with
its template, so that a match is retrieved with the chance that RECALL states. Retrieved windows are verified by
the share of the template's shingles that they hold.

Two filters come first, and neither can lose a match: a text must hold one of the words that more than a fifth of
each template's shingles carry, and a window must hold a shingle of some template.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, chosen, cut, running_sums, text_or_empty

SHINGLE, CONTAINMENT, RECALL = 5, 0.8, 0.9999
WORD = "[a-z0-9]+"
SIZES = (8, 14, 24, 48, 96, 192)

# Notices and opening grants of public licenses, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "This software is licensed under the BSD License"),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Distributed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
)


@dataclass
class Template:
    number: int
    name: str
    shingles: list[str]
    size: int
    bands: int


def stride(size: int) -> int:
    return max(1, size // 8)


def prepare(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[Template]:
    """Shingles, window size and number of bands of each template; a template of fewer than five words is refused."""
    out = []
    for number, (name, text) in enumerate(templates):
        words = re.findall(WORD, text.lower())
        shingles = sorted({" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)})
        fits = [s for s in SIZES if math.ceil(1.25 * len(words)) <= s - stride(s) + 1]
        if not shingles or not fits:
            raise ValueError(f"template {number} has {len(words)} words")
        t, need = len(shingles), math.ceil(CONTAINMENT * len(shingles))
        least = need / (fits[0] - SHINGLE + 1 + t - need)
        out.append(Template(number, name, shingles, fits[0], math.ceil(math.log(1 - RECALL) / math.log(1 - least))))
    return out


def telling_words(templates: list[Template]) -> list[str]:
    """Words of which each matching text holds at least one: for each template, over a fifth of its shingles carry one."""
    chosen: set[str] = set()
    for t in templates:
        carried = {w: {s for s in t.shingles if w in s.split()} for s in t.shingles for w in s.split()}
        have = set().union(*(carried.get(w, set()) for w in chosen)) if chosen else set()
        for w in sorted(carried, key=lambda w: (-len(w), w)):
            if len(have) > (1 - CONTAINMENT) * len(t.shingles):
                break
            chosen.add(w)
            have |= carried[w]
    return sorted(chosen)


def band(shingles: Column, k: Column) -> Column:
    """The k-th MinHash of an array of shingle hashes; one row makes a band."""
    return F.xxhash64(k, F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, k))))


def template_bands(spark: SparkSession, templates: list[Template]) -> list[tuple[int, int, int]]:
    """(number, band, key) by the very expressions that windows get; as many rows as templates have bands."""
    rows = spark.createDataFrame([(t.number, t.bands, t.shingles) for t in templates], "number int, bands int, shingles array<string>")
    keyed = rows.withColumn("hashes", F.transform("shingles", lambda s: F.xxhash64(s))).select("number", F.explode(F.sequence(F.lit(0), F.col("bands") - 1)).alias("k"), "hashes")
    return [tuple(r) for r in keyed.select("number", "k", band(F.col("hashes"), F.col("k"))).collect()]


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: row_no, doc_id, matches array<struct<start, end, license, containment>> in order of start.

    start and end are code points of the original (end exclusive) from the first to the last shared word; overlapping
    finds of one license are one match with the best containment, and of finds with the same start only those stay that
    are contained best, so that versions of a license are told apart. Null or wordless text has no match; ids may be null
    or repeat; an empty table gives no rows. Texts are read once and never shuffled; past the first two steps rows
    hold the words of one window each.
    """
    spark = docs.sparkSession
    known = prepare(templates)
    keys = template_bands(spark, known)
    rows = chosen(docs, doc_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("row_no"), "doc_id", text_or_empty("text").alias("text"))
    lowered = F.lower("text")
    held = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in telling_words(known)])
    own = ascii_lower(F.col("text"))
    none = F.array().cast("array<string>")
    words = F.regexp_extract_all(own, F.lit(WORD), F.lit(0))
    # steps: from where a word begins to where the next one does; the first is the gap before the first word.
    steps = F.zip_with(F.concat(F.array(F.lit("")), words), F.split(own, WORD, -1), lambda w, g: F.length(w) + F.length(g))
    read = rows.select("row_no", "doc_id", F.when(held, words).otherwise(none).alias("words"), F.when(held, steps).otherwise(F.array().cast("array<int>")).alias("steps"))
    scanned = cut(read, "words")

    last = F.size("words") - SHINGLE
    at_word = lambda i: F.array_join(F.slice(F.col("words"), i + 1, SHINGLE), " ")
    ours = [s for t in known for s in t.shingles]
    hits = F.filter(F.sequence(F.lit(0), last), lambda i: at_word(i).isin(ours))
    # From here on only documents that hold a shingle of some template are looked at. starts: where each word begins.
    held_ones = scanned.where(last >= 0).withColumn("hits", hits).where(F.size("hits") > 0)
    marked = cut(held_ones.select("row_no", "words", running_sums(F.col("steps")).alias("starts"), "hits"), "marked")

    sizes = sorted({t.size for t in known})
    table = spark.createDataFrame([(n, k, key, known[n].size) for n, k, key in keys], "number int, k int, key bigint, size int")
    facts = spark.createDataFrame([(t.number, t.name, t.shingles) for t in known], "number int, license string, template array<string>")
    bands = {s: max(t.bands for t in known if t.size == s) for s in sizes}
    windows = None
    for s in sizes:
        per, step = s - SHINGLE + 1, stride(s)
        # Windows start at multiples of the stride; those around each hit are listed from it, so long texts cost by their hits.
        final = F.floor(F.greatest(F.lit(0), last + 1 - per + step - 1) / step).cast("int")
        around = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(F.least(final, F.ceil(F.greatest(F.lit(0), h - per + 1) / step).cast("int")), F.least(final, F.floor(h / step).cast("int")), F.lit(1)))))  # noqa: B023
        slices = F.transform(around, lambda w: F.struct((w * step).alias("at"), F.slice("words", w * step + 1, s).alias("words"), F.slice("starts", w * step + 1, s).alias("starts")))  # noqa: B023
        one = marked.select("row_no", F.explode(slices).alias("w")).select("row_no", F.lit(s).alias("size"), "w.*")
        shingles = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - SHINGLE)), at_word)
        hashed = one.withColumn("hashes", F.transform(shingles, lambda x: F.xxhash64(x)))
        keyed = hashed.select("row_no", "size", "at", "words", "starts", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands[s] - 1)), lambda k: band(F.col("hashes"), k))).alias("k", "key"))
        windows = keyed if windows is None else windows.unionByName(keyed)
    # Templates, their bands and shingles are given as parameters: a few thousand rows at most.
    retrieved = windows.join(F.broadcast(table), ["size", "k", "key"]).groupBy("row_no", "number", "at").agg(F.first("words").alias("words"), F.first("starts").alias("starts"))
    inside = F.sequence(F.lit(0), F.size("words") - SHINGLE)
    shared = F.filter(inside, lambda i: F.array_contains("template", at_word(i)))
    verified = retrieved.join(F.broadcast(facts), "number").withColumn("shared", shared).withColumn(
        "containment", F.size(F.array_distinct(F.transform("shared", at_word))) / F.size("template")
    ).where(F.col("containment") >= CONTAINMENT)
    tail = F.array_max("shared") + (SHINGLE - 1)
    spans = verified.select("row_no", "license", "containment", F.get("starts", F.array_min("shared")).alias("start"), (F.get("starts", tail) + F.length(F.get("words", tail))).alias("end")) \
        .groupBy("row_no", "license", "start", "end").agg(F.max("containment").alias("containment"))
    best = F.max("containment").over(Window.partitionBy("row_no", "start"))
    spans = spans.withColumn("best", best).where("containment = best").drop("best")
    # Overlapping spans of one license in one document become one; groups are bounded by that document's length.
    order = Window.partitionBy("row_no", "license").orderBy("start", "end")
    new = F.coalesce((F.col("start") >= F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    merged = spans.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy("row_no", "license", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("containment").alias("containment"))
    found = merged.groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct("start", "end", "license", "containment"))).alias("matches"))
    nothing = F.array().cast("array<struct<start:int,end:int,license:string,containment:double>>")
    return scanned.select("row_no", "doc_id").join(found, "row_no", "left").select("row_no", "doc_id", F.coalesce("matches", nothing).alias("matches"))


def licenses_report(found: DataFrame) -> DataFrame:
    """doc_id, n_matches, licenses (names, sorted, joined by commas), spans (license:start:end, joined likewise)."""
    return found.select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",").alias("spans"),
    )
