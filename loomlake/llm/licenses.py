"""License scans, by DataFrame functions only.

Template texts are license statements. A text's words (lower-cased letters and digits) give 5-word shingles; windows of
them that overlap by three quarters are hashed by ``BANDS`` min-hashes of one row each, for every size class of templates.
A template is retrieved when a window agrees with it in a band; then it is verified exactly: at least ``PERCENT`` of its
shingles stand in the text. Window sizes follow a template's size within a factor of 1.5, so a window over a match has
a Jaccard similarity of 0.8 / 1.5 * 7 / 8 = 0.46 at least, and one band of 12 agrees with probability over 0.999; templates
of up to four shingles have windows of their own size at every place.

Before that, a text must hold one of ``ANCHORS``. Each template has anchors in more than a fifth of its shingles
(checked), so no text that could match is lost. The plan is one pass without a shuffle; the templates are literals of it,
at most ``MAX_TEMPLATES``.

Defined results: null texts and texts of fewer than five words match nothing; a template of fewer than five words is an
error; a row has one result for each license found, ``n_matched`` shingles of it; repeated rows each have theirs; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SHINGLE, PERCENT, BANDS = 5, 80, 12
MAX_TEMPLATES = 2000
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHORS = ("licen", "permission", "redistribution", "copyright", "software", "binary")

#: Statements of public licenses: fixed values.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, even where ``use`` has it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOW), SEPARATOR), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Hash of the five words from each place on."""

    def own(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))
        return F.when(F.size(w) >= SHINGLE, F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, SHINGLE), " ")))).otherwise(F.array().cast("array<bigint>"))

    return bound(words, own)


def longs(values: list[int]) -> Column:
    """A literal array, written as one string."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def size_class(n: int) -> int:
    """The largest of 1, 2, 3, 4, 6, 8, 12, 16, 24, ... up to n."""
    sizes = [s for k in range(20) for s in (1 << k, 3 << k >> 1 if k else 1)]
    return max(s for s in sizes if s <= n)


def window_starts(at: Column, n: Column, width: int) -> Column:
    """Starts of the windows of one width that hold one of the places ``at``."""
    step = max(1, width // 4)
    last = F.greatest(n - width, F.lit(0))

    def around(p: Column) -> Column:
        first = (F.ceil(F.greatest(p - width + 1, F.lit(0)) / step) * step).cast("int")
        end = F.least(p, last)
        return F.when(first <= end, F.concat(F.sequence(first, end, F.lit(step)), F.array(last))).otherwise(F.array(last))

    return F.array_distinct(F.flatten(F.transform(at, around)))


def band_hits(hashes: Column, starts: dict[int, Column], band: int, keys: dict[int, list[int]]) -> Column:
    """Template keys among the min-hashes of all windows under one hash function; a key is told apart by width and band."""

    def key(own: Column, width: int):
        return lambda i: F.xxhash64(F.array_min(F.slice(own, i + 1, width)), F.lit(width), F.lit(band))

    def hits(own: Column) -> Column:
        return F.flatten(F.array(*[F.array_intersect(F.transform(s, key(own, w)), longs(keys[w])) for w, s in starts.items()]))

    return bound(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))), hits)


def prepared(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Shingles, size class and band keys of each template."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError("too many templates for literals of a plan")
    names = list(templates)
    texts = spark.range(1).select(F.posexplode(F.split(F.lit("\x1f".join(templates[n] for n in names)), "\x1f")).alias("i", "text"))
    texts = texts.select("i", words(F.col("text")).alias("w")).select("i", "w", F.array_distinct(shingles(F.col("w"))).alias("sh"))
    said = sorted(texts.collect(), key=lambda r: r["i"])
    rows = []
    for name, own in zip(names, said, strict=True):
        n = len(own["sh"])
        if not n:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        rows.append({"name": name, "sh": own["sh"], "width": size_class(n)})
    for t, own in zip(rows, said, strict=True):
        t["grams"] = [own["w"][i : i + SHINGLE] for i in range(len(own["w"]) - SHINGLE + 1)]
    width = F.get(longs([t["width"] for t in rows]), F.col("i")).cast("int")
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    keys = texts.select("i", F.transform(bands, lambda b: F.xxhash64(F.array_min(F.transform("sh", lambda h: F.xxhash64(h, b))), width, b)).alias("keys"))
    return [t | {"keys": r["keys"]} for t, r in zip(rows, sorted(keys.collect(), key=lambda r: r["i"]), strict=True)]


def anchors_of(known: list[dict], usual: tuple[str, ...] = ANCHORS, most: int = 24) -> tuple[str, ...]:
    """Words without one of which no text can match: of each template so few shingles lack one that the others aren't enough.

    The usual ones where they do, else words of the templates, those first that help most templates; none (every text is read) where ``most`` don't do.
    """

    def open_(t: dict, anchors: tuple[str, ...]) -> bool:
        bare = len({" ".join(g) for g in t["grams"] if not any(a in w for a in anchors for w in g)})
        return bare * 100 >= PERCENT * len(t["sh"])

    anchors = usual
    while left := [t for t in known if open_(t, anchors)]:
        if len(anchors) >= most:
            return ()
        help_: dict[str, int] = {}
        for t in left:
            for w in {w for g in t["grams"] for w in g if w.isascii() and len(w) > 3}:
                help_[w] = help_.get(w, 0) + sum(w in g for g in t["grams"])
        help_ = {w: n for w, n in help_.items() if w not in anchors}
        if not help_:
            return ()
        anchors = (*anchors, max(sorted(help_), key=help_.get))
    return anchors


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, n_matched, containment)."""
    known = prepared(docs.sparkSession, templates or TEMPLATES)
    by_key: dict[int, list[int]] = {}
    for k, t in enumerate(known):
        for key in t["keys"]:
            by_key.setdefault(key, []).append(k)
    # one pattern, so that a text is read once
    anchors = anchors_of(known)
    anchored = F.col("text").rlike("|".join("".join(f"[{c}{c.upper()}]" for c in a) for a in anchors)) if anchors else F.col("text").isNotNull()
    d = docs.where(anchored).select("doc_id", words(F.col("text")).alias("words"))
    widths = sorted({t["width"] for t in known})
    every = sorted({h for t in known for h in t["sh"]})  # a hash set in the plan
    d = d.select("doc_id", shingles(F.col("words")).alias("sh"))
    # a band agrees on a shingle of the template, so only windows that hold a shingle of some template can agree
    d = d.withColumn("at", F.filter(F.transform("sh", lambda h, i: F.when(h.isin(every), i)), lambda i: i.isNotNull()))
    d = d.select("doc_id", "sh", *[window_starts(F.col("at"), F.size("sh"), w).alias(f"w{w}") for w in widths])
    starts = {w: F.col(f"w{w}") for w in widths}
    met = [band_hits(F.col("sh"), starts, k, {w: sorted({t["keys"][k] for t in known if t["width"] == w}) for w in widths}) for k in range(BANDS)]
    lookup = F.map_from_arrays(longs(list(by_key)), F.split(F.lit(";".join(",".join(map(str, v)) for v in by_key.values())), ";"))
    found = F.array_distinct(F.flatten(F.transform(F.flatten(F.array(*met)), lambda h: F.split(F.element_at(lookup, h), ","))))
    d = d.select("doc_id", "sh", F.explode(found).alias("k")).withColumn("k", F.col("k").cast("int"))
    sets = F.array(*[longs(t["sh"]) for t in known])
    names = F.split(F.lit("\x1f".join(t["name"] for t in known)), "\x1f")
    own = F.get(sets, F.col("k"))
    d = d.withColumn("n_matched", F.size(F.array_intersect(own, F.col("sh"))).cast("long")).withColumn("n_own", F.size(own))
    d = d.where(F.col("n_matched") * 100 >= F.col("n_own") * PERCENT)
    return d.select("doc_id", F.get(names, F.col("k")).alias("license"), "n_matched", (F.col("n_matched") / F.col("n_own")).alias("containment"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


_VALUES = ", ".join(f"('{n}', '{t}')" for n, t in TEMPLATES.items())
ORACLE = rf"""
WITH t AS (SELECT * FROM (VALUES {_VALUES}) v(license, text)),
norm AS (
  SELECT license AS name, NULL::BIGINT AS doc_id, list_filter(string_split_regex(translate(text, '{UPPER}', '{LOW}'), '{SEPARATOR}'), lambda w: w <> '') AS w FROM t
  UNION ALL
  SELECT NULL, doc_id, list_filter(string_split_regex(translate(text, '{UPPER}', '{LOW}'), '{SEPARATOR}'), lambda w: w <> '') FROM documents WHERE text IS NOT NULL),
s AS (
  SELECT DISTINCT name, doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS g
  FROM (SELECT name, doc_id, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM norm WHERE len(w) >= {SHINGLE})),
n AS (SELECT name, count(*) AS n FROM s WHERE name IS NOT NULL GROUP BY name),
m AS (SELECT d.doc_id, t.name AS license, count(*) AS n_matched FROM s t JOIN s d ON d.g = t.g AND t.name IS NOT NULL AND d.name IS NULL GROUP BY ALL)
SELECT doc_id, license, n_matched, n_matched / n AS containment FROM m JOIN n ON n.name = m.license WHERE 100 * n_matched >= {PERCENT} * n
"""
