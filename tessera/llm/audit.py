"""Operator 13: how the filters of a corpus act together, in every order.

Each document gets a mask of the filters that it fails.  Which documents a filter removes in an order, and what it
removes beside others, follows from the counts of the masks alone: 2**filters cells a part and not a row more.

The filter for copies finds them by partition refinement.  A class of documents that may still be alike is split by
their lengths in code points, then by the hashes of their successive blocks; a class of one is dropped after each split.
Blocks grow by a factor of 16, so a few rounds cover any length, and texts are read for that once: rounds see hashes
only.  Survivors' full texts are compared with the one of their class's least id; those that differ from it (two texts
with all hashes alike) make up a class of their own and are compared again, until none are left.  A copy is a document
whose text a document of a lesser id has; whether that one is removed itself doesn't matter.

A split is a count by key and a join of the rows with the keys that two or more have: one row of a key on one side, so a
class with a third of all rows is divided over tasks.  The least id is a partial minimum; its text is joined to the
members', one row of a class on one side.

Defined results: a null text is an empty one; a null lang is the part ''; a document without an id neither is a copy
nor makes one; rows that share an id and a text aren't copies of each other, as none has a lesser id; labels of several
rows count if any says so, and null ids have none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch_scope, table

#: Where blocks of characters end; a text is shorter than the last.
ENDS = (256, 4096, 1 << 16, 1 << 20, 1 << 24, 1 << 28, (1 << 31) - 1)
WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"


def block_hashes(text: Column) -> list[Column]:
    """A hash of each block of a text; blocks past its end have the hash of no characters."""
    starts = (0, *ENDS)
    return [F.xxhash64(F.substring(text, a + 1, b - a)).alias(f"h{i}") for i, (a, b) in enumerate(zip(starts, ENDS, strict=False))]


def text_failures(text: Column, found: Column) -> dict[str, Column]:
    """Whether a text, whose words are found, fails each of the filters that look at it alone."""
    return {
        "A": F.size(found) < 100,
        "B": F.size(F.array_distinct(found)) * 100 < F.size(found) * 80,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys another row has too."""
    many = rows.groupBy(*keys).agg(F.count("*").alias("_many")).filter("_many > 1").drop("_many")
    return rows.join(many, keys, "left_semi")


def refine(described: DataFrame) -> DataFrame:
    """Of rows with n (length), h0, h1, ... (block_hashes), those that agree in all of it with another row, after
    rounds that drop what agrees with none so far."""
    keys = ["n"]
    left = materialize(_shared(described, keys), "lengths")
    for i, start in enumerate((0, *ENDS[:-1])):
        if left.filter(F.col("n") > start).isEmpty():
            break  # no text reaches this block
        keys.append(f"h{i}")
        left = materialize(_shared(left, keys), f"block{i}")
    return left


def copies(docs: DataFrame, described: DataFrame | None = None) -> DataFrame:
    """copy_id, copy_n and copy_class (id, length, class of its hashes) of the documents that are copies.

    described, where the caller has it already: id, n and block_hashes of docs."""
    if described is None:
        text = F.coalesce("text", F.lit(""))
        described = materialize(docs.select(F.col("doc_id").cast("long").alias("id"), F.length(text).alias("n"), *block_hashes(text)), "described")
    keys = ["n", *[c for c in described.columns if c.startswith("h") and c[1:].isdigit()]]
    alike = refine(described.filter("id IS NOT NULL").select("id", *keys).distinct()).withColumn("class", F.xxhash64(*keys))
    # one row of a class and its least id; equal class numbers of different keys only cost another comparison below
    ids = alike.select(F.col("id").alias("_id"), F.col("n").alias("_n"), F.col("class").alias("_class"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("_n", F.length("text"))
    left = materialize(texts.join(ids, (F.col("id") == F.col("_id")) & (texts["_n"] == ids["_n"])).select("id", "text", F.col("_class").alias("class")), "survivors")
    found = []
    while True:
        first = left.groupBy(F.col("class").alias("_class")).agg(F.min("id").alias("least"))
        # the least id's text; a class's rows of one id share a length and all hashes, and if they still differ, one of them
        least = left.join(first, (F.col("class") == F.col("_class")) & (F.col("id") == F.col("least"))).groupBy("_class", "least").agg(F.min("text").alias("shown"))
        compared = left.join(least, F.col("class") == F.col("_class")).withColumn("same", F.col("text") == F.col("shown"))
        marks = materialize(compared.select("id", F.length("text").alias("n"), "class", "same", (F.col("same") & (F.col("id") > F.col("least"))).alias("copy")), "marks")
        found.append(marks.filter("copy").select(F.col("id").alias("copy_id"), F.col("n").alias("copy_n"), F.col("class").alias("copy_class")))
        if marks.filter("NOT same").isEmpty():
            break
        left = materialize(compared.filter("NOT same").select("id", "text", "class"), "survivors")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def failures(docs: DataFrame) -> DataFrame:
    """id, part and mask (bit i: FILTERS[i] fails) of every document."""
    text = F.coalesce("text", F.lit(""))
    # one pass over the texts: what each fails by itself, and what the rounds need
    cheap = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    cheap = cheap.withColumn("found", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    fails = text_failures(F.col("text"), F.col("found"))
    mask = sum((F.when(fails[f], 1 << i).otherwise(0) for i, f in enumerate("ABCD")), F.lit(0))
    described = materialize(cheap.select("id", "part", mask.alias("mask"), F.length("text").alias("n"), *block_hashes(F.col("text"))), "described")
    keys = [c for c in described.columns if c[0] == "h"]
    gone = copies(docs, described)
    every = described.withColumn("class", F.xxhash64("n", *keys))
    joined = every.join(gone, (F.col("id") == F.col("copy_id")) & (F.col("n") == F.col("copy_n")) & (F.col("class") == F.col("copy_class")), "left")
    e = F.when(F.col("copy_id").isNotNull(), 1 << FILTERS.index("E")).otherwise(0)
    return joined.select("id", "part", (F.col("mask") + e).alias("mask"))


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of the filters before it) of every order of the filters."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    return [("".join(p), i + 1, bit[f], sum(bit[x] for x in p[:i])) for p in permutations(filters) for i, f in enumerate(p)]


def interactions(masks: DataFrame, labels: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For every part, order of filters and step: what the step keeps and removes.  masks: id, part, mask."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    cells = masks.join(known, F.col("id") == F.col("_id"), "left").groupBy("part", "mask")
    cells = cells.agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    cells = materialize(cells, "cells")
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(p).alias("before")) for o, s, b, p in orders(filters)])
    each = cells.select("*", F.inline(steps))
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(test: Column, of: str = "n") -> Column:
        return F.sum(F.when(test, F.col(of)).otherwise(0)).cast("long")

    out = each.groupBy("part", "filter_order", "step", "bit").agg(
        total(~earlier & ~fails).alias("kept"),
        total(~earlier & fails).alias("removed"),
        total(earlier & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(~earlier & fails, "good").alias("good_lost"),
        total(~earlier & fails, "toxic").alias("toxic_lost"),
    )
    shares = out.groupBy(F.col("part").alias("_part"), F.col("bit").alias("_bit")).agg(F.sum("removed").alias("shapley"))
    return out.join(shares, (F.col("part") == F.col("_part")) & (F.col("bit") == F.col("_bit"))).drop("_part", "_bit", "bit")


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    with scratch_scope(spark) as scope:
        return scope.keep(materialize(interactions(failures(docs), table(spark, sf_dir, "labels")), "audit"))


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (
  SELECT part,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
      || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN w.doc_id > least THEN 'E' ELSE '' END AS fails,
         coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM w LEFT JOIN labels l ON w.doc_id = l.doc_id),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f GROUP BY 1, 2),
x(k) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT p.k || q.k || r.k || s.k || t.k AS filter_order
  FROM x p, x q, x r, x s, x t
  WHERE p.k NOT IN (q.k, r.k, s.k, t.k) AND q.k NOT IN (r.k, s.k, t.k) AND r.k NOT IN (s.k, t.k) AND s.k <> t.k),
s AS (
  SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS k, left(filter_order, step - 1) AS before
  FROM o, range(1, 6) AS r(step)),
e AS (
  SELECT part, filter_order, step, k, n, good, toxic, fails = k AS alone, contains(fails, k) AS now,
         before <> '' AND translate(fails, before, '') <> fails AS earlier
  FROM c, s),
g AS (
  SELECT part, filter_order, step, k,
         CAST(coalesce(sum(n) FILTER (WHERE NOT earlier AND NOT now), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (WHERE NOT earlier AND now), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (WHERE earlier AND now), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (WHERE alone), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (WHERE NOT earlier AND now), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (WHERE NOT earlier AND now), 0) AS BIGINT) AS toxic_lost
  FROM e GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM g"""
