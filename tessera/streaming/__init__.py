"""Streams over event files: import deduplication, freshness and state-machine checks.  The batch operators define what
they compute; these keep it up to date."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tessera.operators.ledger import RUN_STATES, RUN_TRANSITIONS


def event_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def import_dedup(stream: DataFrame, at: str, key: str, delay: str) -> DataFrame:
    """The first row of each key; state goes once the watermark passes."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def latest(stream: DataFrame, at: str, key: str, delay: str, window: str) -> DataFrame:
    """Per window and key: the latest time and count, late rows up to delay included."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, window), key).agg(F.max(at).alias("latest"), F.count("*").alias("n"))


def fsm_check(stream: DataFrame) -> DataFrame:
    """run_id, seq, event_type of events that the run's state before doesn't allow.  Rows of a run must arrive in order
    over batches; within a batch they are sorted by seq."""
    allowed = {(s, e) for s, e in RUN_TRANSITIONS}

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get[0] if state.exists else None
        bad = []
        for r in pd.concat(list(frames)).sort_values("seq").itertuples():  # a run's rows of one batch
            if r.event_type not in RUN_STATES:
                continue  # events that change no state
            if (now, r.event_type) not in allowed:
                bad.append((key[0], r.seq, r.event_type))
            now = RUN_STATES[r.event_type]
        state.update((now,))
        yield pd.DataFrame(bad, columns=["run_id", "seq", "event_type"])

    return stream.select("run_id", "seq", "event_type").groupBy("run_id").applyInPandasWithState(
        step, "run_id long, seq long, event_type string", "state string", "append", GroupStateTimeout.NoTimeout
    )


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there now and stops."""
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
