"""Operator 5: exact top-k by inner product with kd-trees.

Each shard is a kd-tree: median splits of the widest dimension, nodes with tight bounding boxes.  A query's inner
product with any row of a box is at most q+ . high + q- . low; boxes are searched best bound first, and a box is left
out for the queries whose kth score lies above its bound.  The kth score carries over from a shard near the query to
the choice of shards and from shard to shard.  vectors.py says how shards and queries meet.

Defined results: vectors null, empty, or holding null or non-finite components take no part; vectors of different
dimensions don't meet; equal scores go to the smaller vec_id; a repeated vec_id is a candidate once a row, and only
rows with the query's own id are not its candidates; a query whose id occurs twice is asked once; fewer than k
candidates are all returned; an empty table gives an empty result; extra columns are ignored.  Components are taken as
floor(256 x); scores beyond 2**63 saturate.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .vectors import BLOCK, SHARD, Measure, nearest_of, search, usable

SCALE = 256


def search_whole(q, qids, x, ids, top, measure):
    """vectors.search over whole numbers.  Where products may exceed what doubles hold exactly, every row is scored by
    unlimited integers and top stays as it is."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2**53:
        at, vec, score = search(q, qids, x, ids, top, measure)
        return at, vec, score.astype(np.int64)
    top[:] = -np.inf
    out: list[tuple[int, int, int]] = []
    rows = [[int(c) for c in r] for r in x]
    for i, r in enumerate(q):
        mine = [int(c) for c in r]
        scored = sorted((-sum(a * b for a, b in zip(mine, row, strict=True)), j) for row, j in zip(rows, ids.tolist(), strict=True) if j != qids[i])
        out += [(i, j, max(-(2**63), min(2**63 - 1, -s))) for s, j in scored[: top.shape[1]]]
    at, vec, score = (np.array(c, np.int64) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
    return at, vec, score


class Whole(Measure):
    def bound(self, q, low, high):
        reach = super().bound(q, low, high)
        return reach + np.where(np.abs(reach) < 2**53, 0, np.inf)  # no bound where doubles don't hold the products


def top_k(vectors: DataFrame, queries: DataFrame, k: int, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """vectors and queries: vec_id, v (whole numbers as doubles)."""
    return nearest_of(vectors, queries, k, Whole(), "long", shard, block, search_whole)


def op5_topk(spark, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    rows = rows.filter("vec_id is not null").withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")))
    return top_k(rows, rows.filter("vec_id % 50 = 0"), 5)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
WHERE rank <= 5"""
