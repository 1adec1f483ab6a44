"""Operator 10: license scans, by DataFrame functions alone.

A text's words (lower case, of letters and digits) give five-word shingles, each hashed.  Windows of shingles are
min-hashed in bands, and the bands' keys are joined to the keys of the license templates' windows; templates that a
window retrieves are verified by exact containment: the share of the template's shingles that the text holds must reach
0.8.

Template windows start at every shingle.  A template of 2 * WIDE shingles or more has windows of WIDE, which texts have
every WIDE / 2, in BANDS bands of one min-hash each: windows of Jaccard similarity s meet with probability
1 - (1 - s) ** BANDS, 0.94 at one half, and an untouched run of 3 * WIDE / 2 shingles with certainty.  A shorter
template has windows of one shingle, which meet with certainty wherever one shingle is shared.  Any number of templates
may be given: their keys and shingles are tables, broadcast up to FEW rows and joined by a shuffle beyond.

Defined results: null and empty texts and texts of fewer than five words match nothing; equal texts get equal matches;
each template is reported once a row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: Public license notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
WORDS = 5
WIDE = 8
BANDS = 4
SHARE = 0.8
#: rows of a table that is broadcast
FEW = 100_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(text: Column) -> Column:
    """Hashes of the text's five-word shingles in order; empty where there are fewer words."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - WORDS)
        each = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]))
        return F.when(F.size(w) >= WORDS, each).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashes)


def band_keys(window: Column, bands: int) -> Column:
    """A key a band: the band's least hash in the window, marked with the band."""
    salt = [0x1E3779B97F4A7C15, 0x4F6CDD1D2B1C3E57, 0x2545F4914F6CDD1D, 0x6A09E667F3BCC908]

    def least_with(s: int) -> Column:
        return F.array_min(F.transform(window, lambda x: x.bitwiseXOR(F.lit(s))))

    return F.array(*[F.xxhash64(F.lit(b), least_with(s)) for b, s in enumerate(salt[:bands])])


def window_keys(h: Column, width: int, step: int) -> Column:
    """Distinct band keys of the windows of width shingles that start every step shingles (one band for single shingles,
    whose key is the shingle); h is a bound variable or a plain column, as it is read once a window."""
    if width == 1:
        return F.array_distinct(h)
    starts = F.sequence(F.lit(1), F.greatest(F.size(h) - width + 1, F.lit(1)), F.lit(step))
    keys = F.flatten(F.transform(starts, lambda i: let(F.slice(h, i, width), lambda w: band_keys(w, BANDS))))
    return F.when(F.size(h) > 0, F.array_distinct(keys)).otherwise(F.array().cast("array<bigint>"))


def template_index(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """license, h (its shingles), n and wide of the templates that have any."""
    rows = spark.createDataFrame([(str(n), str(t)) for n, t in templates], "license string, text string")
    rows = rows.select("license", F.array_distinct(shingles(F.col("text"))).alias("h"))
    return rows.withColumn("n", F.size("h").cast("long")).filter("n > 0").withColumn("wide", F.col("n") >= 2 * WIDE)


def few(table_: DataFrame, most: int = FEW) -> DataFrame:
    """table_, marked for broadcast if it is counted to be small."""
    return F.broadcast(table_) if table_.count() <= most else table_


def candidates(docs: DataFrame, index: DataFrame) -> DataFrame:
    """doc_id, fp (of the text) and license where a window of the text meets one of the template."""
    single, wide = (index.filter(w).select("license", "h") for w in ("not wide", "wide"))
    keys = single.select("license", F.explode("h").alias("key"))
    keys = keys.unionByName(wide.select("license", F.explode(window_keys(F.col("h"), WIDE, 1)).alias("key")))

    def of(h: Column) -> Column:
        return F.concat(window_keys(h, 1, 1), window_keys(h, WIDE, WIDE // 2))

    each = docs.select("doc_id", F.xxhash64("text").alias("fp"), F.explode(let(shingles(F.col("text")), of)).alias("key"))
    return each.join(few(keys), "key").select("doc_id", "fp", "license").distinct()


def scan(docs: DataFrame, templates=TEMPLATES, share: float = SHARE) -> DataFrame:
    """doc_id, license, matched, shingles, containment, first_word (from 0) of each license found.  Only rows that a
    template was retrieved for are read again to be verified."""
    index = template_index(docs.sparkSession, templates)
    met = materialize(candidates(docs.select("doc_id", "text"), index), "licenses")
    met = met.select(F.col("doc_id").alias("met_id"), F.col("fp").alias("met_fp"), "license")
    rows = docs.select("doc_id", "text").withColumn("fp", F.xxhash64("text"))
    rows = rows.join(few(met), F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("fp") == F.col("met_fp")))
    rows = rows.join(few(index.select(F.col("license").alias("name"), F.col("h").alias("template"), "n")), F.col("license") == F.col("name"))

    def described(h: Column) -> Column:
        def of(both: Column) -> Column:
            return F.struct(
                F.size(both).cast("long").alias("matched"),
                (F.size(both) / F.col("n").cast("double")).alias("containment"),
                (F.array_position(h, F.get(both, F.lit(0))) - 1).cast("long").alias("first_word"),
            )

        return let(F.array_intersect(h, F.col("template")), of)

    found = rows.select("doc_id", "license", F.col("n").alias("shingles"), let(shingles(F.col("text")), described).alias("f"))
    return found.filter(F.col("f.containment") >= share).select("doc_id", "license", "f.matched", "shingles", "f.containment", "f.first_word")


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same matches by plain containment of each template's shingles in the text's words."""
    import re

    rows = []
    for name, text in TEMPLATES:
        w = [x for x in re.split(r"[^a-z0-9]+", text.lower()) if x]
        rows += [(name, " ".join(w[i : i + WORDS])) for i in range(len(w) - WORDS + 1)]
    values = ", ".join(f"('{n}', ' {s} ')" for n, s in dict.fromkeys(rows))
    return f"""
WITH shingle(license, s) AS (VALUES {values}),
body AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ' AS b FROM documents),
hit AS (SELECT doc_id, license, s, position(s IN b) AS p, b FROM body JOIN shingle ON contains(b, s)),
per AS (SELECT doc_id, license, count(*) AS matched, min(p) AS p, any_value(b) AS b FROM hit GROUP BY doc_id, license),
size AS (SELECT license, count(*) AS n FROM shingle GROUP BY license)
SELECT doc_id, license, CAST(matched AS BIGINT) AS matched, CAST(n AS BIGINT) AS shingles,
       matched / CAST(n AS DOUBLE) AS containment,
       CAST(length(substr(b, 1, p)) - length(replace(substr(b, 1, p), ' ', '')) - 1 AS BIGINT) AS first_word
FROM per JOIN size USING (license)
WHERE matched / CAST(n AS DOUBLE) >= {SHARE}"""


SQL = _sql()
