"""Signals per chunk and what a document makes of them; ordered template gates; statuses of pipelines and backups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as X


def aggregate_chunks(chunks: DataFrame) -> DataFrame:
    """Per file: whether any chunk is positive, the greatest probability, the excerpt of the surest positive chunk (one
    with a matched phrase before others), and the domain most chunks name (of equals the first in order), with its
    votes.  chunks: file_id, chunk, positive, p, phrase (matched or not), excerpt, domain."""
    votes = chunks.groupBy("file_id", "domain").agg(F.count("*").alias("n"))
    major = votes.groupBy("file_id").agg(F.min_by("domain", F.struct(-F.col("n"), F.col("domain"))).alias("domain"), F.max("n").alias("votes"), F.sum("n").alias("chunks"))
    sure = F.when(F.col("positive"), F.struct(F.col("phrase").cast("int").alias("f"), "p", (-F.col("chunk")).alias("c")))
    per = chunks.groupBy("file_id").agg(F.bool_or("positive").alias("present"), F.max("p").alias("p_max"), F.bool_or("phrase").alias("phrase_any"), F.max_by("excerpt", sure).alias("excerpt"))
    return per.join(major, "file_id")


def signals_to_claims(signals: DataFrame, predicate: str = "deadline") -> DataFrame:
    """A raw claim for each successful signal with an excerpt."""
    fine = (F.col("signal_status") == "SUCCESS") & F.col("present") & ~X.is_empty(F.col("excerpt"))
    return signals.filter(fine).select("file_id", F.col("file_id").alias("subject_raw"), F.lit(predicate).alias("predicate"), F.col("excerpt").alias("object_raw"), F.col("excerpt").alias("evidence_excerpt"), F.lit("SUPPORTED_BY_ARCHIVE").alias("status"))


def template(text: Column, path: Column, garbled: Column, gates: list[tuple[str, str, int, str]], other: str = "generic") -> Column:
    """The first template whose marker stands near the top (or whose path token occurs in the path); garbled text first.
    gates: template, marker, within, path token (empty for none)."""
    out = F.lit(other)
    for name, marker, within, token in reversed(gates):
        fits = X.near_top(text, marker, within)
        if token:
            fits = fits | F.lower(path).contains(token)
        out = F.when(fits, name).otherwise(out)
    return F.when(garbled, "garbled").otherwise(out)


def roll_up(rows: DataFrame, group: str, status: str, attention: list[str]) -> DataFrame:
    """Per group: n, and how many need attention; and a last line for all."""
    per = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col(status).isin(*attention)).alias("attention"))
    return per.unionByName(per.agg(F.sum("n").alias("n"), F.sum("attention").alias("attention")).withColumn(group, F.lit("TOTAL")))


def backup_freshness(sets: DataFrame, as_of, seconds: int) -> DataFrame:
    """Per group: the latest verified set and whether it is younger than seconds."""
    last = sets.filter("verified").groupBy("name").agg(F.max("created_at").alias("created_at"))
    every = sets.select("name").distinct().join(last, "name", "left")
    late = F.col("created_at").isNull() | (F.col("created_at") + F.expr(f"interval {seconds} seconds") < F.lit(as_of).cast("timestamp_ntz"))
    return every.select("name", "created_at", F.when(late, "DEGRADED").otherwise("PASS").alias("classification"))


def backup_health(records: DataFrame, as_of, seconds: int, days: int) -> DataFrame:
    """name, classification, latest_backup, backup_age (whole seconds), restore_age (days) of each group of backup records
    (name, action, outcome, at, backup_id, fit).  FAIL without a verified backup, where the latest is older than seconds,
    or isn't fit now (what verifying it again said; null isn't fit); DEGRADED without a verified restore test, or where the
    latest is over days old; else PASS.  Of backups of one time the last by backup_id is the latest."""
    now = F.lit(as_of).cast("timestamp_ntz")
    made = (F.col("action") == "backup.create") & (F.col("outcome") == "verified")
    tried = (F.col("action") == "restore.check") & (F.col("outcome") == "verified")
    last = F.max(F.when(made & F.col("at").isNotNull(), F.struct("at", "backup_id", F.coalesce("fit", F.lit(False)).alias("fit"))))
    out = records.groupBy("name").agg(last.alias("_b"), F.max(F.when(tried, F.col("at"))).alias("_r"))
    since = lambda c: F.timestamp_diff("MICROSECOND", c, now) / F.lit(1e6)
    age, tested = since(F.col("_b.at")), since(F.col("_r")) / 86400
    state = F.when(F.col("_b").isNull() | (age > seconds) | ~F.col("_b.fit"), "FAIL").when(F.col("_r").isNull() | (tested > days), "DEGRADED").otherwise("PASS")
    return out.select("name", state.alias("classification"), F.col("_b.backup_id").alias("latest_backup"), age.cast("long").alias("backup_age"), tested.alias("restore_age"))
