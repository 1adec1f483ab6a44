import re
from functools import partial

import numpy as np

from tests.llm.helpers import SF, none_of, odd_documents
from tessera.llm import near as N
from tessera.llm.common import components


def brute_classes(rows, at_least=0.8):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    sets, parent = {}, {}
    for i, text in rows:
        w = words.findall(text)
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) or frozenset([tuple(w)])
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(sets[a] & sets[b]) >= at_least * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.filter("doc_id = 3").first()["text"].split(" ")
    more = []
    for i in range(30):  # a chain: each differs from the one before by a few words
        base = list(base)
        base[(i * 7) % len(base)] = f"new{i}"
        more.append((10_000 + i, " ".join(base)))
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r["doc_id"]: r["class_id"] for r in N.classes(docs).collect()}
    assert got == brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd(spark):
    docs = odd_documents(spark)
    got = [(r["doc_id"], r["class_id"]) for r in N.classes(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (6, 1), (2, 2), (3, 3), (4, 4), (5, 5), (7, 7), (None, None), (None, None)], key=str)
    kept = N.near_dedup(docs)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 7, None, None], key=str)
    assert N.near_dedup(none_of(docs)).count() == 0


def test_signatures_estimate_probability_jaccard():
    a = (N.mix64(np.arange(1, 101, dtype=np.uint64)), np.arange(1, 101))
    b = (N.mix64(np.arange(31, 131, dtype=np.uint64)), np.full(100, 40))
    a, b = [(e[o], c[o]) for e, c in (a, b) for o in [np.argsort(e)]]
    sig = N.prob_min_hash([a, b], 6000)
    want = N.probability_jaccard(a, b)
    wa, wb = dict(zip(*a, strict=True)), dict(zip(*b, strict=True))
    plain = sum(1 / sum(max(wa.get(k, 0) / wa[i], wb.get(k, 0) / wb[i]) for k in wa | wb) for i in wa.keys() & wb.keys())
    assert abs(want - plain) < 1e-9 and abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_large_groups_meet_in_small_blocks(spark, monkeypatch):
    """A group of many near copies, in blocks of a few members each."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(160):
        words = list(base)
        for at in rng.choice(120, size=int(rng.integers(1, 7)), replace=False):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_classes(rows)
    monkeypatch.setattr(N, "meet_in_blocks", partial(N.meet_in_blocks, size=30_000))
    assert {r["doc_id"]: r["class_id"] for r in N.classes(docs).collect()} == want and len(set(want.values())) > 1
