import numpy as np

from tests.llm.helpers import SF
from tessera.llm import ann, topk
from tessera.llm.vectors import usable


def table(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    nan, one = float("nan"), [1.0] + [0.0] * 63
    odd = [(1000, None), (1001, [nan] * 64), (1050, []), (1051, [None] * 64), (1100, [0.0] * 64), (1101, one), (1102, one), (1300, one), (1300, one), (1152, [1.0, 2.0]), (1200, [2.0, 1.0]), (None, one)]
    return e.unionByName(spark.createDataFrame(odd, "vec_id long, embedding array<float>"))


def brute(rows, step, k):
    rows = [(i, np.array(v)) for i, v in rows]
    out = {}
    for i, q in rows:
        if i % step == 0:
            out[i] = sorted(((-(q @ v), j) for j, v in rows if j != i and len(v) == len(q)))[:k]
    return out


def test_exact_top_k(spark):
    rows = usable(table(spark), "vec_id", "embedding").filter("vec_id is not null")
    rows = rows.selectExpr("vec_id", "transform(v, x -> cast(floor(256 * x) as double)) as v").persist()
    want = brute([(r["vec_id"], r["v"]) for r in rows.collect()], 50, 5)
    got = {}
    for r in topk.top_k(rows, rows.filter("vec_id % 50 = 0"), 5, shard=100, block=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert got == {q: v for q, v in want.items() if v}
    assert topk.top_k(rows.limit(0), rows.limit(0), 5).count() == 0


def test_recall(spark):
    rows = usable(table(spark), "vec_id", "embedding", zero_too=False).filter("vec_id is not null").persist()
    want = brute([(r["vec_id"], r["v"]) for r in rows.collect()], 20, 20)
    got = {}
    for r in ann.nearest(rows, rows.filter("vec_id % 20 = 0"), 20, shard=100, block=8).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = sum(len({j for _, j in v} & set(got.get(q, []))) for q, v in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert got[1300][:2] == [1101, 1102]  # equal scores: the smaller id first
    assert ann.nearest(rows.limit(0), rows.limit(0), 20).count() == 0


def test_chi_square_point():
    assert abs(ann.chi_square_point(0.95, 8) - 15.507) < 1e-3
