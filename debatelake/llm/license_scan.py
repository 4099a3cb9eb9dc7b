"""License scans: TF-IDF cosine to templates, then inheritance by directory.

A passage of a file, as long as a template and anywhere in the text, is a
sparse TF-IDF vector over words, with document frequencies counted over the
whole corpus for the words of the templates; any other word weighs as the
rarest one. The words that a passage shares with a template bound its cosine,
so that only passages near enough to reach the least are compared. A file
without a licence of its own takes that of the nearest ancestor directory
which holds a licence file: one so named whose text grants a licence.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, checkpointed, col, ship
from .decontaminate import words

#: Notices and opening passages by licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("GPL-2.0", "This program is free software under the GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("Proprietary", "All rights reserved"),
)
#: Names of licence files.
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"
LEAST_COSINE = 0.75
#: Most directories whose licences are broadcast, counted.
BROADCAST_ROWS = 100_000


class Matcher:
    """Cosines of passages to the templates."""

    def __init__(self, templates: Iterable[tuple[str, str]], frequency: dict[bytes, int], documents: int, least: float = LEAST_COSINE):
        self.least = least
        self.idf = {w: math.log((1 + documents) / (1 + n)) + 1 for w, n in frequency.items()}
        self.rarest = math.log(1 + documents) + 1
        self.number = {w: i for i, w in enumerate(self.idf)}
        #: name, length, unit vector, and the square of it by word number
        self.templates = []
        for name, text in templates:
            ws = words(text)
            if not ws:
                continue
            v, norm = self.vector(ws)
            v = {w: x / norm for w, x in v.items()}
            mass = np.zeros(len(self.number))
            mass[[self.number[w] for w in v]] = [x * x for x in v.values()]
            self.templates.append((name, len(ws), v, mass))

    def vector(self, ws: list[bytes]) -> tuple[dict[bytes, float], float]:
        v = {w: (1 + math.log(n)) * self.idf.get(w, self.rarest) for w, n in Counter(ws).items()}
        return v, math.sqrt(sum(x * x for x in v.values())) or 1.0

    def best(self, ws: list[bytes]) -> tuple[float, str | None]:
        """The greatest cosine of a passage that reaches the least, and its licence; the first template wins a tie."""
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        at = np.nonzero(ids >= 0)[0]
        found: tuple[float, str | None] = (0.0, None)
        if not len(at):
            return found
        ids = ids[at]
        for name, length, v, mass in self.templates:
            sums = np.concatenate(([0.0], np.cumsum(mass[ids])))
            # a passage's words have this much of the template's square at most, which bounds its cosine's square
            shared = sums[np.searchsorted(at, at + length)] - sums[:-1]
            near = np.nonzero(shared >= self.least * self.least - 1e-9)[0]
            for i in near[np.argsort(-shared[near], kind="stable")].tolist():
                if shared[i] <= found[0] * found[0]:
                    break
                passage, norm = self.vector(ws[at[i] : at[i] + length])
                cosine = sum(x * v[w] for w, x in passage.items() if w in v) / norm
                if cosine >= self.least and cosine > found[0] + 1e-12:
                    found = cosine, name
        return found


def vocabulary(templates: Iterable[tuple[str, str]]) -> list[bytes]:
    return sorted({w for _, t in templates for w in words(t)})


def template_frequencies(files: DataFrame, text_col: str, templates: Iterable[tuple[str, str]]) -> tuple[dict[bytes, int], int]:
    """Documents of the whole corpus with each template word, and all documents."""
    ship(files.sparkSession)
    wanted = frozenset(vocabulary(templates))

    def run(batches):
        counts, n = Counter(), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                for text in batch.column("text").slice(i, 256).to_pylist():
                    counts.update(wanted.intersection(words(text)))
                    n += 1
        counts[b""] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["w", "n"])

    rows = files.select(col(text_col).alias("text")).mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r.w): r.n for r in rows}
    total = found.pop(b"", 0)
    return {w: found.get(w, 0) for w in wanted}, total


def directory(path):
    """Parent of a path column; the empty root for names without a slash."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    templates: Iterable[tuple[str, str]] = TEMPLATES,
    least: float = LEAST_COSINE,
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """Add ``license``, ``license_cosine``, ``license_from`` and ``license_dir`` to each file.

    ``license_from`` is ``header`` for a passage of the file itself, ``file``
    for a licence file, ``inherited`` for the nearest ancestor directory with
    one, which ``license_dir`` names; else all four are null. If a directory
    has several licence files, the greatest cosine wins, then the least licence
    name. Null paths have no directory and inherit nothing; null and empty
    texts match nothing; repeated rows stay; an empty table gives none.
    ``keep`` names the columns to carry, all by default; columns named like the
    new ones are replaced.
    """
    templates = tuple(templates)
    new = ("license", "license_cosine", "license_from", "license_dir")
    carry = [c for c in (files.columns if keep is None else keep) if c not in new]
    matcher = Matcher(templates, *template_frequencies(files, text_col, templates), least)
    shared = files.sparkSession.sparkContext.broadcast(matcher)
    held = files.select(*[col(c).alias(f"k{i}") for i, c in enumerate(carry)], col(path_col).alias("p"), col(text_col).alias("t"))

    def factory():
        matcher = shared.value

        def work(rows):
            found = [matcher.best(words(text)) for text in rows["t"]]
            return {"lic": [name for _, name in found], "cos": [cosine if name else None for cosine, name in found]}

        return work

    own = attach(held, {"t": "t"}, factory, {"lic": pa.string(), "cos": pa.float64()}, [c for c in held.columns if c != "t"])
    own = own.withColumn("dir", directory(F.col("p")))
    named = F.coalesce(F.regexp_extract("p", r"([^/]*)$", 1).rlike(FILE_NAMES), F.lit(False))
    own = checkpointed(own.withColumn("is_file", F.col("lic").isNotNull() & F.col("p").isNotNull() & named))
    # one licence for each directory that holds a licence file, found by map-side combination
    granted = own.where("is_file").groupBy("dir").agg(F.max_by("lic", F.struct("cos", F.transform(F.split("lic", ""), lambda c: -F.ascii(c)))).alias("dl"))
    # each directory in use, once, meets its ancestors' licences
    parts = F.split("dir", "/")
    ups = F.transform(F.sequence(F.size(parts), F.lit(1)), lambda n: F.struct(F.array_join(F.slice(parts, 1, n), "/").alias("up"), n.alias("depth")))
    root = F.array(F.struct(F.lit("").alias("up"), F.lit(0).alias("depth")))
    used = own.where("lic is null and p is not null").select("dir").distinct()
    ancestors = used.select("dir", F.explode(F.concat(F.when(F.col("dir") != "", ups).otherwise(F.slice(ups, 1, 0)), root)).alias("a")).select("dir", "a.up", "a.depth")
    nearest = ancestors.join(granted.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max_by(F.struct("dl", "up"), "depth").alias("n"))
    nearest = checkpointed(nearest.select("dir", F.col("n.dl").alias("dl"), F.col("n.up").alias("up")))
    if nearest.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        nearest = F.broadcast(nearest)
    out = own.join(nearest, "dir", "left")
    inherited = F.col("lic").isNull() & F.col("dl").isNotNull()
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(carry)],
        F.coalesce("lic", "dl").alias("license"),
        F.col("cos").alias("license_cosine"),
        F.when(F.col("is_file"), "file").when(F.col("lic").isNotNull(), "header").when(inherited, "inherited").alias("license_from"),
        F.when(F.col("is_file"), F.col("dir")).when(inherited, F.col("up")).alias("license_dir"),
    )
