"""Ledger streams that don't depend on the order of arrival, and a sink that a restart can't make write twice."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.operators.ledger import RUN_STATES, RUN_TRANSITIONS

VIOLATIONS = "run_id long, seq long, event_type string"
STATE = "state string, next long, latest long, waiting array<struct<seq: long, event_type: string>>"


def ordered_violations(stream: DataFrame, at: str, delay: str, states: dict = RUN_STATES, transitions=RUN_TRANSITIONS) -> DataFrame:
    """run_id, seq, event_type of the events that their run's state before doesn't allow, whatever order and batches they
    arrive in.  Events (run_id, seq from 1 on, event_type and their time at) that come before their turn wait in the
    run's state until those before them have come.  When the watermark has passed a run's latest event by delay, what
    still waits is checked in order over its gaps, as the batch check reads it, and the run's state is freed; repeats of
    events that had their turn are passed over.  The state holds the events out of turn only."""
    allowed = {(s, e) for s, e in transitions}

    def take(now: str | None, run: int, seq: int, event: str, bad: list) -> str | None:
        if event not in states:
            return now  # it changes no state
        if (now, event) not in allowed:
            bad.append((run, seq, event))
        return states[event]

    def step(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now, turn, latest, kept = held.get if held.exists else (None, 1, 0, [])
        waiting, bad = {w[0]: w[1] for w in kept}, []
        if held.hasTimedOut:
            for seq in sorted(waiting):
                now = take(now, key[0], seq, waiting[seq], bad)
            held.remove()
        else:
            for frame in frames:
                for seq, event, ms in zip(frame["seq"], frame["event_type"], frame["_ms"], strict=True):
                    latest = max(latest, int(ms))
                    if seq >= turn:
                        waiting.setdefault(int(seq), event)
            while turn in waiting:
                now = take(now, key[0], turn, waiting.pop(turn), bad)
                turn += 1
            held.update((now, turn, latest, sorted(waiting.items())))
            # a timer must lie past the watermark, which already allows for the delay
            held.setTimeoutTimestamp(max(latest, held.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(bad, columns=["run_id", "seq", "event_type"])

    events = stream.withWatermark(at, delay).select("run_id", "seq", "event_type", at, (F.unix_micros(F.col(at).cast("timestamp")) / 1000).cast("long").alias("_ms"))
    return events.groupBy("run_id").applyInPandasWithState(step, VIOLATIONS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, path: str, batch: int) -> bool:
    fs, p = _fs(spark, f"{path}/manifest/{batch}.json")
    return fs.exists(p)


def commit(spark: SparkSession, path: str, batch: int, rows: int) -> None:
    """Names a batch in the manifest: written aside, then renamed, so that it is there whole or not at all."""
    fs, p = _fs(spark, f"{path}/manifest/{batch}.json")
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/aside/{batch}.json")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps({"batch": batch, "rows": rows}).encode()))
    out.close()
    fs.mkdirs(p.getParent())
    if not fs.rename(aside, p) and not fs.exists(p):
        raise OSError(f"batch {batch} can't be committed under {path}")


def write_once(path: str, before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: each batch goes to a folder of its own, which a repeat overwrites, and counts once the
    manifest names it.  A batch that the manifest names is not written again, so a query restarted anywhere, also between
    data and manifest, leaves each row once.  before_commit is called in between."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if committed(spark, path, number):
            return
        target = f"{path}/data/batch={number}"
        batch.write.mode("overwrite").parquet(target)
        if before_commit:
            before_commit(number)
        # the count is the footers', not a second run of the batch
        commit(spark, path, number, spark.read.parquet(target).count())

    return write


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the batches that the manifest names, with their batch."""
    named = spark.read.schema("batch long, rows long").json(f"{path}/manifest").select(F.col("batch").alias("_batch"))
    return spark.read.parquet(f"{path}/data").join(named, F.col("batch") == F.col("_batch"), "left_semi")


def resume_point(spark: SparkSession, path: str) -> int:
    """The batch that a sink waits for: one after the last that is committed, all before it being so."""
    fs, p = _fs(spark, f"{path}/manifest")
    if not fs.exists(p):
        return 0
    named = spark.read.schema("batch long, rows long").json(f"{path}/manifest")
    got = named.agg(F.max("batch").alias("last"), F.count("*").alias("n")).first()
    if got["last"] is not None and got["last"] + 1 != got["n"]:
        raise ValueError(f"the manifest of {path} has gaps: {got['n']} batches up to {got['last']}")
    return 0 if got["last"] is None else got["last"] + 1


def run_once(stream: DataFrame, path: str, checkpoint: str, before_commit: Callable[[int], None] | None = None) -> None:
    """Processes what is there now into a write_once sink and stops."""
    query = stream.writeStream.foreachBatch(write_once(path, before_commit)).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    query.start().awaitTermination()
