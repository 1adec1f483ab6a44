import re

import pytest

from tests.llm.helpers import SF, none_of, odd_documents
from tessera.llm import mixing as M


def targets(sizes):
    """The targets by the rule's own steps."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return out


def check(docs, rows):
    sizes = {}
    for r in docs:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want, taken = targets(sizes), {}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1


def test_against_the_rule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = M.mix(docs)[0].collect()
    check(docs.collect(), rows)
    again = {(r["doc_id"], r["taken"]) for r in M.mix(docs.repartition(3))[0].collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_odd(spark):
    docs = odd_documents(spark)
    check(docs.collect(), M.mix(docs)[0].collect())
    assert M.mix(none_of(docs))[0].count() == 0
    assert M.mixed_documents(none_of(docs)).count() == 0


def test_documents_of_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    copies = {r["doc_id"]: r["count"] for r in M.mixed_documents(docs).groupBy("doc_id").count().collect()}
    for r in M.mix(docs)[0].collect():
        near = r["passes"] + (1 if r["cut"] * 2 >= r["size"] and r["cut"] else 0)
        assert copies.get(r["doc_id"], 0) == (near if r["size"] else 1)
