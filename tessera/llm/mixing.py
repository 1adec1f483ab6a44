"""Operator 1: mixing sources to target weights.

Every document gets a hash-random key; documents are range-sorted by (source, key) over all partitions, running totals
of their sizes are formed from per-partition sums, and each source is cut where its exact budget ends.  A budget above
the source's size takes whole passes (epochs) first.

Defined results: a null text has size 0; a null source is a source of its own and comes last; sources that hold no
words get target 0; an empty table gives an empty result; rows alike in doc_id, source and text are interchangeable;
further columns of the input do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, running_total, unused, words

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3


def _key(seed: int) -> Column:
    """The hash of id and text, so that documents without ids are in random order too."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def document_sizes(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, source, size in words, and what orders documents within a source: key (hash-random), then fp."""
    return docs.select(
        "doc_id",
        "source",
        words("text").alias("size"),
        _key(seed).alias("key"),
        F.xxhash64("text").alias("fp"),
    )


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target, budget.  Sources in code-point order take the weights in turn; together the
    targets are the size of the whole corpus.  A target stops at epochs times its source's size and the excess is
    shared again by weight: the level at which the shares w * level, so limited, add up.  All of it is done by running
    totals over the table of sources, so their number may grow with the corpus."""
    per = materialize(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1)), "sources"
    )
    ranked = running_total(per, ["one"], ["source"], {"rank": "one"}, "ranked")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    ranked = materialize(ranked.withColumn("ratio", F.col("cap") / F.col("weight")), "weights")
    size, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    filled = running_total(ranked, ["one"], ["ratio", "rank"], {"caps": "cap", "weights": "weight"}, "levels")
    level = (F.lit(size) - F.col("caps")) / F.greatest(F.lit(weight) - F.col("weights"), F.lit(1e-300))
    level = filled.withColumn("level", level).filter("level <= ratio").agg(F.min_by("level", "ratio")).first()[0] or 0.0
    target = F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double"))
    out = ranked.withColumn("target", F.greatest(target, F.lit(0.0)))
    return materialize(
        out.select("source", "source_size", "target", F.least(F.round("target"), F.col("cap")).cast("long").alias("budget")),
        "targets",
    )


def _passes() -> dict:
    """Whole passes over the source, and the words that are left for the last, partial one."""
    size = F.greatest(F.col("source_size"), F.lit(1))
    return {"passes": F.floor(F.col("budget") / size).cast("long"), "rest": F.col("budget") % size}


def mix(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = MOST_EPOCHS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(decisions, targets).  decisions: doc_id, source, size, key, fp, source_size, target, passes, cut (words of the
    last pass that this document gives: its size before the cut, a part of it at the cut, else 0) and taken."""
    sizes = materialize(document_sizes(docs, seed), "sizes")
    targets = source_targets(sizes, weights, epochs)
    before = running_total(sizes, ["source"], ["key", "doc_id", "size", "fp"], {"before": "size"}, "mixed")
    t = targets.withColumnRenamed("source", "_source").withColumns(_passes())
    out = before.join(t, before["source"].eqNullSafe(t["_source"]), "left").drop("_source")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))).cast("long")
    out = out.withColumn("cut", cut)
    return out.withColumn("taken", (F.col("passes") * F.col("size") + F.col("cut")).cast("long")), targets


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = MOST_EPOCHS, seed: int = 17) -> DataFrame:
    """The documents of the mix, each as often as it is taken.  The document at a source's cut comes whole if at least
    half of it lies before the cut, so each source is within half a document of its budget; rows alike in all that
    orders them share one decision.  Texts aren't shuffled: the place of each source's cut is joined to the documents."""
    decisions, targets = mix(docs, weights, epochs, seed)
    last = decisions.filter("cut * 2 >= size and cut > 0").groupBy("source").agg(
        F.max(F.struct("key", F.col("doc_id"), "size", "fp")).alias("last")
    )
    t = targets.withColumns(_passes()).join(
        last.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left"
    )
    source, passes, cut, copies, n = unused(docs.columns, "source_of", "passes", "last", "copies", "turn")
    t = materialize(t.select(F.col("source").alias(source), F.col("passes").alias(passes), F.col("last").alias(cut)), "cuts")
    mine = F.struct(_key(seed).alias("key"), F.col("doc_id"), words("text").alias("size"), F.xxhash64("text").alias("fp"))
    more = F.when(F.col(cut).isNotNull() & (mine <= F.col(cut)), 1).otherwise(0)
    # a document without words has nothing to repeat: it stays once
    times = F.when(words("text") == 0, F.lit(1)).otherwise(F.col(passes) + more).cast("int")
    joined = docs.join(t, docs["source"].eqNullSafe(t[source]), "left").withColumn(copies, times)
    return joined.filter(F.col(copies) > 0).withColumn(n, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    decisions, _ = mix(table(spark, sf_dir, "documents"))
    return decisions.select("doc_id", "size", "source_size", "target", "taken")
