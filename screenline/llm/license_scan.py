"""License scan: MinHash bands over overlapping text windows.

Templates are partitioned by the number of their word shingles (up to 1, 2, 4,
8, ...). For each partition a text is cut into overlapping windows, so that any
run of as many shingles as the partition's largest template lies in one window.
A template contained to 0.75 has a Jaccard similarity of at least 0.27 to such a
window, so with 32 bands of one minimum each they share a band with probability
1 - 4e-5 or more. Windows and templates that share one are confirmed by exact
shingle containment. Windows that share
no shingle at all with a template cannot share a band with it, and are not made.

Words are runs of letters and digits, A-Z lower-cased, other ASCII characters
apart. All of it is functions of Spark: no Python in the tasks, and no row of a
text is moved; one row per document and license found is.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.session import local_table

SIZE = 5
PERCENT = 75
BANDS = 32
# Templates looked for in one reading of the documents.
BLOCK = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

# Standard notices of common licenses.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("mit", "Released under the MIT License."),
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "gpl-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "cc-by-4.0-long",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
]

_MASKS = [int(x) for x in np.random.default_rng(23).integers(-(1 << 63), 1 << 63, BANDS, dtype=np.int64)]


def _words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(plain, APART), lambda w: w != "")


def _shingles(words: Column, k: Column | int) -> Column:
    """Hashes of all runs of ``k`` words, in order; none in a shorter text."""
    k = F.lit(k) if isinstance(k, int) else k
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.xxhash64(F.slice(words, i, k)))
    return F.when((F.size(words) >= k) & (k > 0), runs).otherwise(F.array().cast("array<bigint>"))


def _made(df: DataFrame, **columns: Column) -> DataFrame:
    """doc_id and new columns, behind a generator: else filters and lambdas that
    use a column would have its whole expression written out inside them."""
    return df.select("doc_id", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def size_class(n: int) -> int:
    return 1 << (n - 1).bit_length()


def window(size: int) -> tuple[int, int]:
    """Stride and length, in shingles, of the windows for templates of up to ``size``."""
    return (1, size) if size <= 4 else (size // 4, size // 4 * 5)


def signed_templates(spark, templates: list[tuple[str, str]]) -> list[tuple]:
    """(name, words per shingle, distinct shingles, longest word) of each template
    that has a word; one of fewer than five words is one shingle of all of them."""
    table = local_table(spark, [(n, t) for n, t in templates], "name string, text string")
    table = table.select("name", _words(F.col("text")).alias("w"))
    table = table.withColumn("k", F.least(F.size("w"), F.lit(SIZE))).where("k > 0")
    runs = F.array_sort(F.array_distinct(_shingles(F.col("w"), F.col("k"))))
    rows = table.select("name", "k", "w", runs.alias("s")).collect()
    return sorted({(r["name"], r["k"], tuple(r["s"]), max(r["w"], key=len)) for r in rows})


def _long_array(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _minimum(values: tuple[int, ...], mask: int) -> int:
    return min(v ^ mask for v in values)


def _masked_minimum(values: str, mask: int) -> Column:
    return F.array_min(F.transform(values, lambda v: v.bitwiseXOR(F.lit(mask))))


def _places(hashes: str, known: list[int]) -> Column:
    """Places of the shingles that some template has."""
    return F.filter(F.transform(hashes, lambda h, i: F.when(h.isin(known), i)), lambda i: i.isNotNull())


def _windows(hashes: str, places: str, group: int, stride: int, length: int) -> Column:
    """Windows that hold one of the places, in order and once each. The others
    share no shingle with a template, so they cannot share a band with one."""

    def over(i: Column) -> Column:
        low = F.greatest(F.lit(0), F.floor((i - length + stride) / stride).cast("int"))
        return F.sequence(low, F.floor(i / stride).cast("int"))

    starts = F.array_distinct(F.flatten(F.transform(places, over)))
    return F.transform(
        starts,
        lambda j: F.struct(
            F.lit(group).alias("kind"),
            (j * stride).alias("first"),
            F.slice(hashes, j * stride + 1, F.lit(length)).alias("s"),
        ),
    )


def _held(words: DataFrame, signed: list[tuple], percent: int) -> DataFrame:
    """Windows that contain a template, in one reading of the documents: the
    windows of all partitions of a text come from its shingles, made once."""
    widths = sorted({k for _, k, _, _ in signed})

    def made(k: int) -> Column:
        if k == SIZE:
            return _shingles(F.col("_words"), k)
        # A short template's only shingle holds its longest word.
        some = F.array(*[F.lit(w) for w in sorted({w for _, v, _, w in signed if v == k})])
        none = F.array().cast("array<bigint>")
        return F.when(F.arrays_overlap("_words", some), _shingles(F.col("_words"), k)).otherwise(none)

    rows = _made(words, **{f"h{k}": made(k) for k in widths})
    known = {k: sorted({v for _, w, s, _ in signed if w == k for v in s}) for k in widths}
    rows = rows.where(reduce(lambda a, b: a | b, [F.arrays_overlap(f"h{k}", _long_array(known[k])) for k in widths]))
    places = {f"p{k}": _places(f"h{k}", known[k]) for k in widths}
    rows = _made(rows, **{f"h{k}": F.col(f"h{k}") for k in widths}, **places)
    kinds = sorted({(k, size_class(len(s))) for _, k, s, _ in signed})
    cut = F.concat(*[_windows(f"h{k}", f"p{k}", g, *window(size)) for g, (k, size) in enumerate(kinds)])
    windows = rows.select("doc_id", F.explode(cut).alias("x")).select("doc_id", "x.kind", "x.first", "x.s")
    keys = F.array(*[F.struct(F.lit(b).alias("band"), _masked_minimum("s", m).alias("low")) for b, m in enumerate(_MASKS)])
    index = [
        (kinds.index((k, size_class(len(s)))), b, _minimum(s, m), name, list(s))
        for name, k, s, _ in signed
        for b, m in enumerate(_MASKS)
    ]
    # At most BLOCK templates times BANDS rows.
    index = F.broadcast(
        local_table(words.sparkSession, index, "of int, band int, low long, license string, t array<long>")
    )
    same = (F.col("kind") == F.col("of")) & (F.col("key.band") == F.col("band")) & (F.col("key.low") == F.col("low"))
    met = windows.select("doc_id", "kind", "first", "s", F.explode(keys).alias("key")).join(index, same)
    common = F.size(F.array_intersect("s", "t"))
    met = met.select("doc_id", "license", "first", F.size("t").alias("n_shingles"), common.alias("n_common"))
    return met.where(100 * F.col("n_common") >= percent * F.col("n_shingles"))


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> DataFrame:
    """One row per doc_id and license of which a window holds at least
    ``percent`` in 100 of the distinct shingles: doc_id, license, n_shingles,
    n_common (the most in a window), first_window (its first word, from 0, of
    the first window with as many).

    Texts that are null or have no words hold no license; rows under one doc_id
    are one document, rows without one are one too. Templates without words
    match nothing; without templates, or documents, the result is empty.
    """
    signed = signed_templates(docs.sparkSession, TEMPLATES if templates is None else templates)
    words = _made(docs.select(F.col("doc_id").cast("long"), "text"), _words=_words(F.col("text")))
    parts = [_held(words, signed[i : i + BLOCK], percent) for i in range(0, len(signed), BLOCK)]
    if not parts:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, license string, n_shingles int, n_common int, first_window int"
        )
    best = reduce(DataFrame.unionAll, parts).groupBy("doc_id", "license")
    return best.agg(
        F.max("n_shingles").alias("n_shingles"),
        F.max("n_common").alias("n_common"),
        F.max(F.struct(F.col("n_common"), (-F.col("first")).alias("f"))).alias("_best"),
    ).select("doc_id", "license", "n_shingles", "n_common", (-F.col("_best.f")).alias("first_window"))
