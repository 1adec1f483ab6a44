"""What several operators share: small filters, connected components, batches; scratch tables are tessera.scratch's."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import suppress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.scratch import bound_batches, cleanup, drop_scratch, materialize, running_total, scratch_scope, unused  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(column: Column | str) -> Column:
    """Number of maximal runs of characters other than space and U+0009 to U+000D; null counts 0."""
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def batches(schema: pa.Schema, rows: Iterable[tuple], limit: int = 8 << 20, weigh=None) -> Iterator[pa.RecordBatch]:
    """Record batches of about limit bytes (weigh(row) or 64 each)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row) if weigh else 64
        if size >= limit:
            yield _batch(schema, held)
            held, size = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def release() -> None:
    """Ends a partition: what a worker no longer needs goes back to the system, as workers wait for their next task while
    others run."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # the C library may have no such call
        ctypes.CDLL(None).malloc_trim(0)


def least_hashed(rows: DataFrame, h: Column, most: int, n: int) -> DataFrame:
    """The most rows (of n) whose hashes h are least, all if there are fewer.  Rows whose hash is too great to be among
    them, by a factor of four, go before anything is ordered, so a task hands on few."""
    share = min(1.0, 4 * most / max(n, 1))
    low = rows if share == 1.0 else rows.filter(F.pmod(h, F.lit(1 << 30)) < int(share * (1 << 30)))
    return low.orderBy(F.pmod(h, F.lit(1 << 30)), h).limit(most)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bloom:
    """A Bloom filter of fixed size (bits, a power of two) over 64-bit keys with three probes.  Past its capacity it
    only lets more keys through, so it may cut work before an exact join but never decides a result."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
        h = mix64(keys.astype(np.uint64))
        step = mix64(h + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return [((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(3)]

    @classmethod
    def build(cls, keys: DataFrame, column: str, bits: int = 1 << 24) -> Bloom:
        def fold(frames):
            mine = np.zeros(bits, dtype=bool)
            for frame in frames:
                for p in cls._places(frame[column].to_numpy().view(np.uint64), bits):
                    mine[p] = True
            packed = np.packbits(mine).view(np.uint64)
            at = np.flatnonzero(packed)
            del mine
            yield pd.DataFrame({"at": at.astype(np.int64), "word": packed[at].view(np.int64)})
            release()

        got = (
            keys.select(column)
            .mapInPandas(fold, "at long, word long")
            .groupBy("at")
            .agg(F.bit_or("word").alias("word"))
            .toPandas()
        )
        out = np.zeros(bits // 64, dtype=np.int64)
        out[got["at"].to_numpy()] = got["word"].to_numpy()
        return cls(np.unpackbits(out.view(np.uint8)).astype(bool))

    def has(self, keys: np.ndarray) -> np.ndarray:
        a, b, c = self._places(keys, len(self.bits))
        return self.bits[a] & self.bits[b] & self.bits[c]

    def packed(self) -> bytes:
        return np.packbits(self.bits).tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Bloom:
        return cls(np.unpackbits(np.frombuffer(data, dtype=np.uint8)).astype(bool))


def might_hold(bloom: Bloom, spark: SparkSession, key: Column) -> Column:
    """Whether the 64-bit key may be among the filter's."""
    held = spark.sparkContext.broadcast(bloom.packed())  # of fixed size

    @F.pandas_udf("boolean")
    def test(batches_: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mine = Bloom.unpack(held.value)
        for b in batches_:
            yield pd.Series(mine.has(b.fillna(0).to_numpy(np.int64).view(np.uint64)))
        del mine
        release()

    return test(key)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """v, root (the least vertex of v's component) of the vertices of edges: large-star and small-star rounds, each a
    partial minimum per vertex and a join, until they change nothing.  Nothing is gathered on the driver but counts."""
    now = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges"
    )
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: a vertex's greater neighbours go to the least of its neighbourhood
        large = now.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u")  # w > u
        large = large.select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u > v")
        # small star: a vertex and its lesser neighbours, of which it has few by now, go to the least of them
        lower = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = lower.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after = materialize(small.filter("u > v").distinct(), "stars")
        drop_scratch(now)
        now = after
        # done when every vertex has one edge, to a vertex that has none itself
        more = now.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
        if more.filter("n > 1").isEmpty() and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
