"""Licence scans: sparse TF-IDF cosine of texts to licence templates, and
inheritance from the nearest ancestor directory.

A file's units are its lines, its leading comment block and, if its name says
that it is a licence file, its whole text.  Every unit of every file is a bag
of words weighted by TF-IDF; document frequencies of all words are counted over
all units of the corpus.  A unit whose cosine to its best template reaches
``COSINE`` carries that licence.  Tasks know the frequencies of the templates'
words and of the ``FREQUENT`` most common ones; no other word is more frequent
than these, which bounds its weight from below and so a unit's cosine from
above.  A cosine cannot exceed the share of a unit's length that is in template
words either, so most units need no product.  The other words of units that may
still match are joined with their counted frequencies.

A licence file's licences hold for its directory.  A file without one of its
own inherits those of the nearest directory above it that has any: the distinct
directories are joined with the licensed ones on each of their ancestors' paths
and the deepest match wins, so the join is as large as the directory tree.

Null texts count as empty; a file with a null path has no directory and cannot
inherit.  Rows that repeat a path are files of their own (licence files of one
directory add up).  An empty table gives no row."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import column_lists

COSINE = 0.6
#: Words, the most common first, whose frequencies every task gets; those of others are joined.
FREQUENT = 20_000
#: Words that a task counts before it hands on its counts.
_COUNTED = 1 << 19
_WORDS = re.compile(r"[^\W_]+")
_COMMENT = re.compile(r"\s*(#|//|/\*|\*|--|;|<!--|\"\"\"|%)")
#: File names that hold a licence, and notices and grants in the words of the licences' authors.
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense)([.\-_].*)?$"
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def units(text: str | None, licence_file: bool) -> list[list[str]]:
    """The bags of words of a file."""
    if not text:
        return []
    lines = text.splitlines()
    out = [words(x) for x in lines]
    head = 0
    while head < len(lines) and _COMMENT.match(lines[head]):
        head += 1
    if head > 1:
        out.append([w for bag in out[:head] for w in bag])
    if licence_file:
        out.append([w for bag in out[: len(lines)] for w in bag])
    return [bag for bag in out if bag]


class Matcher:
    """Cosines of bags of words to the templates, given the number of units,
    the document frequencies of the templates' words and of frequent ones, and
    the highest that any other word may have."""

    def __init__(self, templates: list[tuple[str, str]], n: int, df: dict[str, int], most: int):
        self.names = [name for name, _ in templates]
        weight = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for _, t in templates for w in words(t)}
        self.weight, self.least = weight, math.log((1 + n) / (1 + most)) + 1
        self.frequent = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in df.items() if w not in weight}
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, (_, t) in enumerate(templates):
            bag = {w: c * weight[w] for w, c in Counter(words(t)).items()}
            norm = math.sqrt(sum(v * v for v in bag.values()))
            for w, v in bag.items():
                self.postings.setdefault(w, []).append((i, v / norm))

    def best(self, bag: list[str], cosine: float) -> tuple[str, float, float, dict[str, int]] | None:
        """The nearest template, the product with it, the bag's squared length
        in words of known frequency and the counts of its other words; None if
        the cosine cannot reach ``cosine`` whatever their frequencies are."""
        weight, frequent = self.weight, self.frequent
        counts = Counter(bag)
        inside = {w: c * weight[w] for w, c in counts.items() if w in weight}
        known = sum(v * v for v in inside.values())
        if not known:
            return None
        square, other = known, {}
        for w, c in counts.items():
            if w not in weight:
                if w in frequent:
                    square += (c * frequent[w]) ** 2
                else:
                    other[w] = c
        at_least = square + self.least**2 * sum(c * c for c in other.values())
        if known < cosine * cosine * at_least * (1 - 1e-9):
            return None
        dots: dict[int, float] = {}
        for w, v in inside.items():
            for i, t in self.postings[w]:
                dots[i] = dots.get(i, 0.0) + v * t
        i = max(sorted(dots), key=lambda k: round(dots[k], 12))
        if dots[i] < cosine * math.sqrt(at_least) * (1 - 1e-9 if other else 1):
            return None
        return self.names[i], dots[i], square, other


def frequencies(files: DataFrame) -> DataFrame:
    """(word, n): in how many units of all files each word occurs; the empty
    word has the number of units."""

    def run(batches):
        df = Counter()

        def out():
            b = pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64())], ["word", "n"])
            df.clear()
            return b

        for _, named, texts in column_lists(batches, "licence_file", "text"):
            for name, text in zip(named, texts):
                for bag in units(text, name):
                    df[""] += 1
                    df.update(set(bag))
                if len(df) > _COUNTED:
                    yield out()
        yield out()

    return files.select("licence_file", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def named_files(documents: DataFrame, path: Column) -> DataFrame:
    """Add the file's path, directory (null for a null path, empty at the top)
    and whether its name is a licence file's."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return documents.withColumn("path", path).withColumn("directory", F.regexp_replace("path", r"/?[^/]*$", "")) \
        .withColumn("licence_file", F.coalesce(name.rlike(LICENCE_FILE), F.lit(False)))


def own_licences(files: DataFrame, cosine: float = COSINE, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, path, directory, licence_file, own, score): the licences found
    in each file, sorted, and the best cosine (0 without any)."""
    counted = frequencies(files).checkpoint()
    # written first: collected at once, the driver would get as many rows of every task
    common = counted.where("word != ''").orderBy(F.desc("n"), "word").limit(FREQUENT).checkpoint().orderBy(F.desc("n"), "word").collect()
    most = common[-1]["n"] if common else 0
    vocabulary = sorted({"", *(w for _, t in templates for w in words(t))})
    df = {r["word"]: r["n"] for r in [*common, *counted.where(F.col("word").isin(vocabulary)).collect()]}
    n = df.pop("", 0)
    shared = files.sparkSession.sparkContext.broadcast(Matcher(templates, n, df, most))
    hit = pa.list_(pa.struct([("name", pa.string()), ("score", pa.float64())]))
    unit = pa.list_(pa.struct([("name", pa.string()), ("dot", pa.float64()), ("square", pa.float64()),
                               ("other", pa.list_(pa.struct([("word", pa.string()), ("count", pa.int64())])))]))

    def run(batches):
        match = shared.value
        for b, named, texts in column_lists(batches, "licence_file", "text"):
            hits, left = [], []
            for name, text in zip(named, texts):
                near = [m for m in (match.best(bag, cosine) for bag in units(text, name)) if m]
                hits.append([{"name": k, "score": min(1.0, dot / math.sqrt(square))} for k, dot, square, other in near if not other])
                left.append([{"name": k, "dot": dot, "square": square, "other": [{"word": w, "count": c} for w, c in other.items()]}
                             for k, dot, square, other in near if other])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in ("doc_id", "path", "directory", "licence_file")),
                 pa.array(hits, hit), pa.array(left, unit)],
                ["doc_id", "path", "directory", "licence_file", "hits", "left"])

    kind = files.schema["doc_id"].dataType.simpleString()
    found = files.select("doc_id", "path", "directory", "licence_file", "text").mapInArrow(
        run, f"doc_id {kind}, path string, directory string, licence_file boolean, hits array<struct<name:string,score:double>>, "
             "left array<struct<name:string,dot:double,square:double,other:array<struct<word:string,count:bigint>>>>")
    found = found.withColumn("file", F.monotonically_increasing_id()).checkpoint()
    # a word that is joined occurs in no more units than the rarest of the common ones, so no key is crowded
    left = found.select("file", F.posexplode("left").alias("unit", "of"))
    left = left.select("file", "unit", "of.name", "of.dot", "of.square", F.inline("of.other"))
    weight = F.log((1 + F.lit(n)) / (1 + F.col("n"))) + 1
    late = left.join(counted, "word").groupBy("file", "unit", "name", "dot", "square").agg(F.sum((F.col("count") * weight) ** 2).alias("more"))
    late = late.withColumn("score", F.least(F.lit(1.0), F.col("dot") / F.sqrt(F.col("square") + F.col("more")))).where(F.col("score") >= cosine)
    late = late.groupBy("file").agg(F.collect_set("name").alias("names"), F.max("score").alias("late"))
    own = F.concat("hits.name", F.coalesce("names", F.array().cast("array<string>")))
    return found.join(late, "file", "left").select(
        "doc_id", "path", "directory", "licence_file", F.sort_array(F.array_distinct(own)).alias("own"),
        F.greatest(F.coalesce(F.array_max("hits.score"), F.lit(0.0)), F.coalesce("late", F.lit(0.0))).alias("score"))


def scan(files: DataFrame, cosine: float = COSINE, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, path, licences, origin, from_directory, score) of every file:
    origin is own, inherited or none."""
    found = own_licences(files, cosine, templates).checkpoint()
    licensed = found.where(F.col("licence_file") & (F.size("own") > 0)).groupBy(F.col("directory").alias("ancestor")).agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("own")))).alias("inherited"))
    directories = found.where("directory is not null").select("directory").distinct()
    steps = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    climbed = directories.select("directory", F.posexplode(F.array_distinct(above)).alias("depth", "ancestor"))
    nearest = climbed.join(licensed, "ancestor").groupBy("directory").agg(
        F.max_by(F.struct("ancestor", "inherited"), "depth").alias("from")).withColumnRenamed("directory", "_dir")
    rows = found.join(nearest, F.col("directory") == F.col("_dir"), "left")
    own = F.size("own") > 0
    return rows.select(
        "doc_id", "path", F.when(own, F.col("own")).otherwise(F.coalesce("from.inherited", F.array().cast("array<string>"))).alias("licences"),
        F.when(own, "own").when(F.col("from").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(own, F.col("directory")).otherwise(F.col("from.ancestor")).alias("from_directory"), "score")
