"""Licence scan: sparse TF-IDF cosine of lines to licence templates, and licences of the nearest ancestor directory.

A line, and each run of a template's length in it, is compared with the templates of licence headers; weights come from all lines of the corpus: of the words of templates, and of those beside
them in lines that reach the threshold if other words weigh least. A file that is mostly licence text is a licence file and speaks for its directory: files without
a header of their own inherit from the nearest directory above them that has one, found by joins on path prefixes.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import land, table

#: The usual wording of licence headers and first lines of licence files.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "The MIT License (MIT)", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "GPL-2.0": ["This program is licensed under the GNU General Public License, version 2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "SPDX-License-Identifier: GPL-2.0-only"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "Use of this source code is governed by a BSD-style license", "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["Released under CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related rights to this work"],
    "Proprietary": ["All rights reserved", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited"],
}
TOKEN = re.compile(r"[a-z0-9]+(?:[.-][0-9a-z]+)*")
THRESHOLD, FILE_SHARE = 0.8, 0.2


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


class Scanner:
    """The templates as sparse unit vectors, and the words without one of which no line can be similar enough.

    By Cauchy-Schwarz a line's cosine to a template is at most the root of the share of the template's squared weight
    on the words they have in common; the anchors of a template are its heaviest words, all of which a line must not
    lack together if it is to reach the threshold.
    """

    def __init__(self, templates: dict[str, list[str]], lines: int, counts: dict[str, int], threshold: float, unseen: float | None = None) -> None:
        self.threshold = threshold
        self.unseen = math.log(1 + lines) + 1 if unseen is None else unseen
        texts = [(name, tokens(t)) for name, ts in sorted(templates.items()) for t in ts]
        self.words = {w for _, ws in texts for w in ws}
        self.idf = {w: math.log((1 + lines) / (1 + counts.get(w, 0))) + 1 for w in self.words | counts.keys()}
        self.names = [name for name, _ in texts]
        self.lengths = [len(ws) for _, ws in texts]
        self.index: dict[str, list[tuple[int, float]]] = defaultdict(list)
        anchors = set()
        for i, (_, ws) in enumerate(texts):
            v = {w: n * self.idf[w] for w, n in Counter(ws).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            left = 1.0
            for w, x in sorted(v.items(), key=lambda p: (-p[1], p[0])):
                self.index[w].append((i, x / norm))
                if left >= threshold**2:
                    anchors.add(w)
                    left -= (x / norm) ** 2
        self.anchors = sorted(anchors)

    def hits(self, ws: list[str]) -> Iterator[tuple[float, int, int, int]]:
        """Cosine, template, begin and end of the runs of a line that reach the threshold."""
        shares: dict[int, float] = defaultdict(float)
        vectors: dict[int, dict[str, float]] = defaultdict(dict)
        for w in dict.fromkeys(ws):
            for i, y in self.index.get(w, ()):
                shares[i] += y * y
                vectors[i][w] = y
        for i in sorted(shares):
            if shares[i] >= self.threshold**2 - 1e-9:
                near = [(0, len(ws)), *self.runs(ws, vectors[i], self.lengths[i])]
                for a, b in near:
                    dot = norm = 0.0
                    for w, n in Counter(ws[a:b]).items():
                        x = n * self.idf.get(w, self.unseen)
                        norm += x * x
                        dot += x * vectors[i].get(w, 0.0)
                    if dot >= self.threshold * math.sqrt(norm):
                        yield min(1.0, dot / math.sqrt(norm)), i, a, b

    def runs(self, ws: list[str], vector: dict[str, float], length: int) -> Iterator[tuple[int, int]]:
        """The runs of this length, shorter than the line, that may reach the threshold: sums slide along the line, a word in and one out.

        Sums that slide gather rounding errors, hence the slack; the caller computes the cosine of what is left anew.
        """
        if length >= len(ws):
            return
        counts: dict[str, int] = defaultdict(int)
        dot = norm = 0.0
        for end, w in enumerate(ws, 1):
            x = self.idf.get(w, self.unseen)
            n = counts[w]
            counts[w] = n + 1
            norm += (2 * n + 1) * x * x
            dot += x * vector.get(w, 0.0)
            if end > length:
                w = ws[end - length - 1]
                x = self.idf.get(w, self.unseen)
                n = counts[w]
                counts[w] = n - 1
                norm -= (2 * n - 1) * x * x
                dot -= x * vector.get(w, 0.0)
            if end >= length and dot >= self.threshold * math.sqrt(max(norm, 0.0)) - 1e-6:
                yield end - length, end

    def lines(self, low: str) -> Iterator[list[str]]:
        """The tokens of lines that can be similar enough."""
        if any(a in low for a in self.anchors):
            for line in low.split("\n"):
                if any(a in line for a in self.anchors):
                    yield TOKEN.findall(line)

    def beside(self, text: str) -> set[str]:
        """The words outside the templates in runs that reach the threshold."""
        return {w for ws in self.lines(text.lower()) for _, _, a, b in self.hits(ws) for w in ws[a:b]} - self.words

    def scan(self, text: str) -> tuple[str | None, float, int, int]:
        """Licence and cosine of the best line or run (of equal ones in a line that of the longest template, then the first line), tokens in such, all tokens."""
        low = text.lower()
        found, score, inside = None, 0.0, 0
        for ws in self.lines(low):
            covered: set[int] = set()
            best, longest, name = 0.0, 0, None
            for cosine, i, a, b in self.hits(ws):
                covered.update(range(a, b))
                if cosine > best + 1e-12 or (cosine > best - 1e-12 and self.lengths[i] > longest):
                    best, longest, name = cosine, self.lengths[i], self.names[i]
            inside += len(covered)
            if best > score + 1e-12:
                found, score = name, best
        return found, score, inside, len(TOKEN.findall(low)) if found else 0


def _line_counts(batches: Iterator[pa.RecordBatch], vocabulary: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """For each batch the number of lines with tokens (under no word) and of those with each word of the vocabulary."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column("text").to_pylist():
            for line in (text or "").lower().split("\n"):
                ws = TOKEN.findall(line)
                if ws:
                    counts[""] += 1
                    counts.update(vocabulary.intersection(ws))
        names = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[w] for w in names], pa.int64())], names=["word", "lines"])


def _beside(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = set().union(*(scanner.beside(t or "") for t in batch.column("text").to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(words), pa.string())], names=["word"])


def _scan_rows(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scanner.scan(t or "") for t in batch.column("text").to_pylist()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        rest = [c for c in batch.schema.names if c != "text"]
        types = (pa.string(), pa.float64(), pa.int32(), pa.int32())
        names = ["_own", "_score", "_inside", "_tokens"]
        yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(c)) for c in rest], *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]], names=[*rest, *names])


def scan_licences(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (``path``, ``text``) without the text and with licence, score, origin and licence_dir.

    Origin is ``header`` (a line of its own or a part of one, also of a licence file), ``inherited`` (of the nearest ancestor directory
    with a licence file; licence_dir tells which) or ``none`` (licence null, score 0). Where a directory has several
    licence files the best score counts, then the smallest name. A null text is empty; a null path has no directory
    and inherits nothing. Rows stay as they are, repeated ones too; columns with names of the result are replaced, and
    names with an underscore in front are reserved.
    """
    vocabulary = frozenset(w for ts in templates.values() for t in ts for w in tokens(t))
    text = files.select(F.col("text").cast("string").alias("text"))

    def counted(words: frozenset[str]) -> dict[str, int]:
        """One row per word."""
        rows = text.mapInArrow(functools.partial(_line_counts, vocabulary=words), "word string, lines bigint").groupBy("word").agg(F.sum("lines").alias("lines"))
        return {r["word"]: r["lines"] for r in rows.collect()}

    counts = counted(vocabulary)
    lines = counts.pop("", 0)
    least = Scanner(templates, lines, counts, threshold, unseen=1.0)
    # the distinct words in and around headers, which grow more slowly than the text
    others = frozenset(r["word"] for r in text.mapInArrow(functools.partial(_beside, scanner=least), "word string").distinct().collect())
    if others:
        counts |= counted(others)
        counts.pop("", None)
    scanner = Scanner(templates, lines, counts, threshold)
    rest = files.drop("licence", "score", "origin", "licence_dir", "text")
    schema = T.StructType([*rest.schema.fields, *[T.StructField(n, t) for n, t in (("_own", T.StringType()), ("_score", T.DoubleType()), ("_inside", T.IntegerType()), ("_tokens", T.IntegerType()))]])
    scanned = files.select(*rest.columns, F.col("text").cast("string").alias("text")).mapInArrow(functools.partial(_scan_rows, scanner=scanner), schema)
    scanned = land(scanned.withColumn("_dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit("")))
                   .withColumn("_dir", F.when(F.col("path").isNotNull(), F.col("_dir"))), "scanned")
    # one licence per directory
    speaks = scanned.where((F.col("_inside") >= FILE_SHARE * F.col("_tokens")) & F.col("_own").isNotNull() & F.col("_dir").isNotNull())
    best = F.min(F.struct((-F.col("_score")).alias("s"), F.col("_own").alias("l"))).alias("b")
    owners = speaks.groupBy(F.col("_dir").alias("_above")).agg(best).select("_above", F.col("b.l").alias("_licence"), (-F.col("b.s")).alias("_given"))
    # nearest ancestor of each distinct directory: join all its prefixes, keep the longest
    dirs = scanned.where("_own IS NULL AND _dir IS NOT NULL").select("_dir").distinct()
    parts = F.split("_dir", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat_ws("/", F.slice(parts, F.lit(1), i)))
    above = dirs.select("_dir", F.explode(F.array_distinct(F.concat(prefixes, F.array(F.lit(""))))).alias("_above"))
    nearest = above.join(owners, "_above").groupBy("_dir").agg(F.max(F.struct(F.length("_above").alias("n"), "_above", "_licence", "_given")).alias("m"))
    nearest = nearest.select(F.col("_dir").alias("_of"), F.col("m._above").alias("_from"), F.col("m._licence").alias("_licence"), F.col("m._given").alias("_given"))
    joined = scanned.join(nearest, F.col("_own").isNull() & (F.col("_dir") == F.col("_of")), "left")
    own, inherited = F.col("_own").isNotNull(), F.col("_licence").isNotNull()
    return joined.select(
        *rest.columns,
        F.coalesce("_own", "_licence").alias("licence"),
        F.when(own, F.col("_score")).otherwise(F.coalesce("_given", F.lit(0.0))).alias("score"),
        F.when(own, "header").when(inherited, "inherited").otherwise("none").alias("origin"),
        F.when(~own, F.col("_from")).alias("licence_dir"),
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source, language, hundreds of ids."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.expr("doc_id div 1000").cast("string"), F.expr("doc_id div 100").cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return scan_licences(docs.select("doc_id", path.alias("path"), "text"))
