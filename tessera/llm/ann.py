"""Operator 7: approximate nearest neighbours by low-dimensional stable projections.

Inner product becomes distance by one more coordinate that brings every row to the largest norm.  Gaussian (2-stable)
projections to M dimensions turn a distance d into d times the root of a chi-square variable with M degrees of freedom.
Each shard is a kd-tree over projected rows.  A query takes the boxes of rows by their projected distance, nearest
first, and verifies their rows on the original vectors; it stops when a row nearer than its kth best would have come up
before with probability P: when chi-square(M) of the next box's projected distance squared, over the kth distance
squared, reaches P.  That is a bound on scores like any other, so shards are chosen and searched as vectors.py says, the
kth score carrying over from a shard near the query.

Every row is indexed; only the upper splits are fitted on a sample.  Recall against brute force is measured in the tests
(0.9 at least).

Defined results: vectors null, empty, zero, or holding null or non-finite components take no part; vectors of
different dimensions don't meet; equal scores go to the smaller vec_id; a repeated vec_id is a candidate once a row; a
query whose id occurs twice is asked once; fewer than k candidates are all returned; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .vectors import BLOCK, SHARD, Measure, nearest_of, usable

M = 8
P = 0.95


@lru_cache(maxsize=8)
def projection(dim: int, m: int, seed: int = 11) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((dim, m))


def chi_square_point(p: float, m: int) -> float:
    """Where the chi-square distribution with m (even) degrees of freedom reaches p: its upper tail is a Poisson sum."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        term, tail = np.exp(-x / 2), 0.0
        for i in range(m // 2):
            tail += term
            term *= x / 2 / (i + 1)
        low, high = (x, high) if 1 - tail < p else (low, x)
    return high


class Projected(Measure):
    """Projected distances as bounds on scores.  norm2[dim]: the largest squared norm of the rows of that dimension."""

    def __init__(self, norm2: dict[int, float], m: int = M, p: float = P):
        self.norm2, self.m, self.point = norm2, m, chi_square_point(p, m)

    def coordinates(self, x):
        a = projection(x.shape[1] + 1, self.m)
        lift = np.sqrt(np.maximum(self.norm2[x.shape[1]] - (x * x).sum(axis=1), 0.0))
        return x @ a[:-1] + lift[:, None] * a[-1]

    def _far2(self, q):
        return (q * q).sum(axis=1) + self.norm2[q.shape[1]]  # distance squared = far2 - 2 * inner product

    def bound(self, q, low, high):
        at = q @ projection(q.shape[1] + 1, self.m)[:-1]
        near2 = np.zeros((len(q), len(low)))  # squared projected distance to each box
        for d in range(self.m):
            gap = np.maximum(np.maximum(low[None, :, d] - at[:, None, d], at[:, None, d] - high[None, :, d]), 0.0)
            near2 += gap * gap
        return (self._far2(q)[:, None] - near2 / self.point) / 2

    def slack(self, q):
        return 1e-9 * (self._far2(q) + 1)

    def final(self, q, x, rough):
        """In double precision, summed coordinate by coordinate: equal vectors get equal scores."""
        out = np.zeros(len(q))
        for d in range(q.shape[1] if len(q) else 0):
            out += q[:, d] * x[:, d]
        return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int, m: int = M, p: float = P, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found.  vectors and queries: vec_id, v."""
    norms = vectors.groupBy(F.size("v").alias("dim")).agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("n2"))
    norm2 = {r["dim"]: r["n2"] for r in norms.collect()}  # a row a dimension
    return nearest_of(vectors, queries, k, Projected(norm2, m, p), "double", shard, block)


def op7_ann(spark, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", zero_too=False).filter("vec_id is not null")
    return nearest(rows, rows.filter("vec_id % 20 = 0"), 20)
