"""From raw documents to packed training sequences, in five stages.

1. toxicity: documents that the fitted model scores 0.7 or more go.  labels is the table beside documents.
2. line dedup: repeated and nearly repeated lines go but for their earliest; documents left without lines go.
3. near-dedup: one document of each class of near duplicates stays.
4. mixing: sources are brought to their target weights; documents may repeat, up to three times, or go.
5. packing: token ids, cut and packed best fit decreasing; a row a piece.

Each stage reads what the one before it wrote.  All but the last return the columns of documents.  A stage over an empty
table returns an empty table; null texts pass all stages (and pack as an end id alone).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import lines, mixing, near, packing, toxicity
from tessera.llm.common import drop_scratch, materialize, scratch_scope, table, unused

TOXIC = 0.7
#: Words that packing keeps a worker, twice at most: its executors also bear what the stages before it left.
KEPT_WORDS = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (score,) = unused(docs.columns, "toxicity")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), score)
    return scored.filter(F.col(score) < TOXIC).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs)
    emptied = out.columns[-1]
    return out.filter(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.near_dedup(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.vocabulary(), kept=KEPT_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can't express the stages; tests hold run() against brute force on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage wrote on its way is deleted when the stage is done, and its result when the
    next one is."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch_scope(spark) as scope:
            out = scope.keep(materialize(stage(spark, docs, sf_dir), name.replace(" ", "_")))
        if name != STAGES[0][0]:
            drop_scratch(docs)
        docs = out
    return docs
