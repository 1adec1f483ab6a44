"""What the vector searches share: kd-splits of the table, shards that are kd-trees, query blocks, and their meeting.

A kd-tree's upper levels, fitted on a bounded sample, deal every row to a cell; cells make shards of about SHARD rows,
and the queries of neighbouring cells make blocks of about BLOCK.  Shards and blocks are single rows of bytes.  A block
is first searched against a shard of its own cells, which gives each query a kth score; then the boxes of all shards
tell which of them may still hold something better, and only those pairs of block and shard meet (a stated query set
against all rows, in blocks), the most promising first.  A task carries the best scores of a block from shard to shard.

Within a shard the tree is searched best box first, for all queries of a block at a time: a node is left out for the
queries whose kth score its box can't reach, at inner nodes as at leaves.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import least_hashed, materialize

SHARD = 8192
BLOCK = 2048
LEAF = 128
#: rows on which the upper levels of the tree are fitted; boxes of shards that are looked at together
SAMPLE = 8_192
PAGE = 1024


class Measure:
    """How a search scores rows (inner products) and bounds a box's scores."""

    def coordinates(self, x: np.ndarray) -> np.ndarray:
        """Rows in the space whose boxes are kept."""
        return x

    def bound(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """[query, box]: a score that no row of the box need exceed to be looked for."""
        return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T

    def slack(self, q: np.ndarray) -> np.ndarray:
        """By how much a rough score may be off."""
        return np.zeros(len(q))

    def final(self, q: np.ndarray, x: np.ndarray, rough: np.ndarray) -> np.ndarray:
        """Exact scores of pairs (a row of q and of x each)."""
        return rough


def usable(vectors: DataFrame, id_col: str, vec_col: str, zero_too: bool = True) -> DataFrame:
    """vec_id, v (array<double>) of vectors that are not null, not empty and all finite (and not zero)."""
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zero_too:
        fine = fine & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).filter(fine)


def to_bytes(x: np.ndarray) -> tuple[str, bytes]:
    """A matrix in the least type that holds it without loss."""
    with np.errstate(all="ignore"):
        for kind in ("<i2", "<f4"):
            y = x.astype(kind)
            if np.array_equal(y.astype(np.float64), x):
                return kind, y.tobytes()
    return "<f8", x.astype("<f8").tobytes()


def matrix(kind: str, data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, -1).astype(np.float64)


class Splits:
    """The upper levels of a kd-tree for each dimension: at every node the widest coordinate of the sample's rows there,
    split at their median."""

    def __init__(self, sample: dict[int, np.ndarray], depth: dict[int, int], measure: Measure):
        self.depth, self.planes = depth, {}
        for dim, levels in depth.items():
            x = sample.get(dim)
            axis, value = np.zeros(2**levels, np.int64), np.full(2**levels, np.inf)
            if levels and x is not None:
                x = measure.coordinates(x)
                stack = [(1, np.arange(len(x)))]
                while stack:
                    node, at = stack.pop()
                    if node < 2**levels and len(at) > 1:
                        wide = int(np.argmax(x[at].max(axis=0) - x[at].min(axis=0)))
                        cut = float(np.median(x[at, wide]))
                        axis[node], value[node] = wide, cut
                        right = x[at, wide] > cut
                        stack += [(2 * node, at[~right]), (2 * node + 1, at[right])]
            self.planes[dim] = (axis, value)

    def cells(self, dim: int, coordinates: np.ndarray) -> np.ndarray:
        axis, value = self.planes[dim]
        node, every = np.ones(len(coordinates), np.int64), np.arange(len(coordinates))
        for _ in range(self.depth[dim]):
            node = 2 * node + (coordinates[every, axis[node]] > value[node])
        return node - 2 ** self.depth[dim]


def fit_splits(rows: DataFrame, size: int, measure: Measure, sample: int = SAMPLE) -> Splits:
    """Splits of rows into cells of about size, from the sample rows whose ids' hashes are least."""
    counts = {r["dim"]: r["n"] for r in rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}  # a row a dimension
    depth = {dim: max(0, math.ceil(math.log2(n / size))) for dim, n in counts.items()}
    held: dict[int, list] = {}
    if any(depth.values()):
        for r in least_hashed(rows.select("vec_id", "v"), F.xxhash64("vec_id", "v"), sample, sum(counts.values())).select("v").collect():
            held.setdefault(len(r["v"]), []).append(r["v"])
    return Splits({d: np.array(v) for d, v in held.items()}, depth, measure)


def kd_order(x: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """An order of the rows in which a kd-tree's nodes are runs: at each node the widest dimension is split at the median
    (by place, so equal values split too, whole leaves on the left) and both halves go on."""
    out, stack = [], [np.arange(len(x))]
    while stack:
        at = stack.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        wide = int(np.argmax(x[at].max(axis=0) - x[at].min(axis=0)))
        half = halfway(len(at), leaf)
        part = np.argpartition(x[at, wide], half)
        stack.append(at[part[half:]])
        stack.append(at[part[:half]])
    return np.concatenate(out) if out else np.arange(0)


def halfway(n: int, leaf: int = LEAF) -> int:
    return max(leaf, n // 2 // leaf * leaf)


def packed(rows: DataFrame, splits: Splits, size: int, measure: Measure, name: str, levels: int = 0, tree: bool = True) -> DataFrame:
    """rows (vec_id, v) as a table of (dim, cell, number, n, ids, kind, data, low, high): up to size rows of a cell each, as
    bytes, in the order of a kd-tree, with their box.  Cells are joined over the lowest levels.  Rows are brought together
    by cell, but a cell of very many rows is shared by several tasks."""

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            dims = frame["v"].map(len).to_numpy()
            cell = np.zeros(len(frame), np.int64)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                x = np.array(frame["v"].iloc[mine].tolist(), np.float64)
                cell[mine] = splits.cells(int(dim), measure.coordinates(x)) >> min(levels, splits.depth[int(dim)])
            yield frame.assign(dim=dims.astype(np.int64), cell=cell)

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[list, list]] = {}

        def flush(key):
            ids, vs = held.pop(key)
            x = np.array(vs, np.float64)
            c = measure.coordinates(x)
            order = kd_order(c) if tree else np.arange(len(x))
            kind, data = to_bytes(x[order])
            return pd.DataFrame({"dim": [key[0]], "cell": [key[1]], "n": [len(ids)], "ids": [np.array(ids, "<i8")[order].tobytes()], "kind": [kind], "data": [data], "low": [c.min(axis=0).astype("<f8").tobytes()], "high": [c.max(axis=0).astype("<f8").tobytes()]})

        for frame in frames:
            for i, v, dim, cell in zip(frame["vec_id"], frame["v"], frame["dim"], frame["cell"], strict=True):
                ids, vs = held.setdefault((dim, cell), ([], []))
                ids.append(i)
                vs.append(v)
                if len(ids) == size:
                    yield flush((dim, cell))
        for key in list(held):
            yield flush(key)

    dealt = rows.select("vec_id", "v").mapInPandas(assign, "vec_id long, v array<double>, dim long, cell long").hint("rebalance", "dim", "cell")
    out = dealt.mapInPandas(gather, "dim long, cell long, n long, ids binary, kind string, data binary, low binary, high binary")
    return materialize(out.withColumn("number", F.monotonically_increasing_id()), name)


def search(q: np.ndarray, qids: np.ndarray, x: np.ndarray, ids: np.ndarray, top: np.ndarray, measure: Measure) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, id, score) of what in one shard (rows in kd order) may be among each query's best, of which top
    [query, k] holds the scores so far and is brought up to date."""
    k, c, slack = top.shape[1], measure.coordinates(x), measure.slack(q)
    kth = top.min(axis=1)
    found: list[tuple] = []
    heap: list[tuple] = [(-np.inf, 0, len(x), np.arange(len(q)), np.full(len(q), np.inf))]
    while heap:
        _, a, b, active, bound = heapq.heappop(heap)
        go = bound >= kth[active] - slack[active]  # a tie may still have the smaller id
        active = active[go]
        if not len(active):
            continue
        if b - a > LEAF:
            middle = a + halfway(b - a)
            for s, t in ((a, middle), (middle, b)):
                reach = measure.bound(q[active], c[s:t].min(axis=0)[None], c[s:t].max(axis=0)[None])[:, 0]
                heapq.heappush(heap, (-float(reach.max()), s, t, active, reach))
            continue
        rough = q[active] @ x[a:b].T
        rough[qids[active][:, None] == ids[a:b][None]] = -np.inf
        both = np.concatenate([top[active], rough], axis=1)
        best_ = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k :]
        top[active], kth[active] = best_, best_.min(axis=1)
        i, j = np.nonzero((rough >= (kth - slack)[active][:, None]) & (rough > -np.inf))
        found.append((active[i], a + j, rough[i, j]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at, row, score = (np.concatenate([f[n] for f in found]) for n in range(3))
    keep = score >= (kth - slack)[at]
    at, row, score = at[keep], row[keep], score[keep]
    score = measure.final(q[at], x[row], score)
    order = np.lexsort((ids[row], -score, at))
    at, row, score = at[order], row[order], score[order]
    first = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
    turn = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0)) if len(at) else at
    return at[turn < k], ids[row[turn < k]], score[turn < k]


def meet(shards: DataFrame, blocks: DataFrame, k: int, measure: Measure, levels: int, score: str, finder: Callable = search) -> DataFrame:
    """query_id, vec_id, score of the blocks' queries against all shards."""
    q = blocks.select("dim", F.col("cell").alias("bcell"), F.col("number").alias("block"), F.col("n").alias("bn"), F.col("ids").alias("bids"), F.col("kind").alias("bkind"), F.col("data").alias("bdata"))
    result = f"block long, top binary, found array<struct<query_id:long,vec_id:long,score:{score}>>"

    def one(r, top: np.ndarray) -> pd.DataFrame:
        ids = np.frombuffer(r.bids, "<i8")
        at, vec, s = finder(matrix(r.bkind, r.bdata, r.bn), ids, matrix(r.kind, r.data, r.n), np.frombuffer(r.ids, "<i8"), top, measure)
        rows = [{"query_id": a, "vec_id": b, "score": c} for a, b, c in zip(ids[at].tolist(), vec.tolist(), s.tolist(), strict=True)]
        return pd.DataFrame({"block": [r.block], "top": [top.astype("<f8").tobytes()], "found": [rows]})

    def seed(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                yield one(r, np.full((r.bn, k), -np.inf))

    home = shards.groupBy(F.col("dim").alias("hdim"), F.shiftright("cell", levels).alias("hcell")).agg(F.min("number").alias("number"))
    first = q.join(home, (F.col("dim") == F.col("hdim")) & (F.col("bcell") == F.col("hcell"))).drop("hdim", "hcell", "dim")
    first = first.join(shards.select("number", "n", "ids", "kind", "data"), "number")
    seeded = materialize(first.repartition(F.col("block")).mapInPandas(seed, result), "seeded")
    q = q.join(seeded.select("block", "top"), "block", "left")
    q = q.join(home.select("hdim", "hcell", F.col("number").alias("home")), (F.col("dim") == F.col("hdim")) & (F.col("bcell") == F.col("hcell")), "left").drop("hdim", "hcell")
    q = materialize(q, "queries")

    pages = max(1, shards.count() // PAGE)
    boxes = shards.groupBy("dim", F.pmod(F.xxhash64("number"), F.lit(pages)).alias("page")).agg(F.collect_list(F.struct("number", "low", "high")).alias("boxes"))

    def prune(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                queries = matrix(r.bkind, r.bdata, r.bn)
                kth = np.full(r.bn, -np.inf) if r.top is None else np.frombuffer(r.top, "<f8").reshape(r.bn, k).min(axis=1)
                low, high = (np.array([np.frombuffer(b[side], "<f8") for b in r.boxes]) for side in ("low", "high"))
                reach = measure.bound(queries, low, high)
                may = (reach >= (kth - measure.slack(queries))[:, None]).any(axis=0)
                rows = [(r.block, b["number"], float(x)) for b, x, m in zip(r.boxes, reach.max(axis=0), may, strict=True) if m and b["number"] != r.home]
                yield pd.DataFrame(rows, columns=["block", "number", "reach"])

    pairs = materialize(q.join(boxes, "dim").select("block", "bn", "bkind", "bdata", "top", "home", "boxes").repartition("block").mapInPandas(prune, "block long, number long, reach double"), "pairs")
    held = pairs.join(shards.select("number", "n", "ids", "kind", "data"), "number").join(q.select("block", "bn", "bids", "bkind", "bdata", "top"), "block")
    n = pairs.count()
    tasks = max(1, n // 8, min(n, 4 * shards.sparkSession.sparkContext.defaultParallelism))
    held = held.repartition(tasks).sortWithinPartitions("block", F.desc("reach"))

    def rest(frames):
        known: dict[int, np.ndarray] = {}
        for frame in frames:
            for r in frame.itertuples(index=False):
                if r.block not in known:
                    known.clear()  # blocks come one after another
                    known[r.block] = np.full((r.bn, k), -np.inf) if r.top is None else np.frombuffer(r.top, "<f8").reshape(r.bn, k).copy()
                yield one(r, known[r.block])

    more = held.select("block", "n", "ids", "kind", "data", "bn", "bids", "bkind", "bdata", "top").mapInPandas(rest, result)
    found = seeded.select("found").unionByName(more.select("found"))
    return found.select(F.explode("found").alias("f")).select("f.query_id", "f.vec_id", "f.score")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ties to smaller vec_id: query_id, rank, vec_id, score."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_of(rows: DataFrame, queries: DataFrame, k: int, measure: Measure, score: str, shard: int, block: int, finder: Callable = search) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows.  rows and queries: vec_id, v."""
    splits = fit_splits(rows, shard, measure)
    asked = queries.dropDuplicates(["vec_id"]).filter(F.size("v").isin(*splits.depth) if splits.depth else F.lit(False))
    n = asked.count()
    deep = max(splits.depth.values(), default=0)
    levels = max(0, deep - max(0, int(math.log2(max(n, 1) / block)) if n > block else 0))
    shards = packed(rows, splits, shard, measure, "shards")
    blocks = packed(asked, splits, block, measure, "blocks", levels, tree=False)
    return best(meet(shards, blocks, k, measure, levels, score, finder), k)
