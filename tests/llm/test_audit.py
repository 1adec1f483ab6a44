import itertools
import re
from collections import Counter

import pytest

from tests.llm.helpers import none_of, odd_documents
from tessera.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """The audit's rows by the letter: every order applied filter by filter."""
    texts = [(i, t or "", part or "") for i, t, part in docs]
    known = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = known.get(i, (False, False))
            known[i] = good or quality == 1, bad or toxic == 1
    rows = []
    for i, t, part in texts:
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts),
        }
        rows.append((part, {k for k, v in fails.items() if v}, *known.get(i, (False, False))))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                lost = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in rows if r[0] == part and f in r[1]]
                out[part, order, step] = [len(left), len(lost), len(failing) - len(lost), sum(r[1] == {f} for r in failing), sum(r[2] for r in lost), sum(r[3] for r in lost)]
                shapley[part, f] += len(lost)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(spark, docs, labels):
    masks = audit.failures(docs)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = audit.interactions(masks, table)
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_against_brute_force(spark):
    plain = " ".join(f"word{i}" for i in range(120))
    texts = [plain, plain, "x", "x", "", None, "ABC def", "a # b", plain + " $", " ".join(["same"] * 150), "é" * 300, "é" * 299 + "e", "Q" * 5000, "Q" * 4999 + "R", "Q" * 5000, plain + " $"]
    rows = [(i, t, ["en", None, "", "de"][i % 4]) for i, t in enumerate(texts)]
    rows += [(0, plain, "en"), (None, plain, "en"), (None, "x", None), (-5, "x", "fr"), (40, "lone", "fr"), (2, "x", "en"), (6, "other text of 6", "de")]
    labels = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (None, 1, 1), (3, None, 1), (9, 1, None), (99, 1, 1), (14, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS part", "'y' AS n", "'z' AS h0", "'w' AS id")
    got = [tuple(r) for r in run(spark, docs, labels).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, labels)


def test_odd_and_empty(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    assert {tuple(r) for r in run(spark, docs, []).collect()} == brute(rows, [])
    assert run(spark, none_of(docs), [(1, 1, 1)]).count() == 0


def test_texts_that_share_all_hashes(spark, monkeypatch):
    # every hash is the same, so only lengths and the comparison of full texts tell documents apart
    monkeypatch.setattr(audit, "block_hashes", lambda text: [audit.F.lit(7).cast("long").alias(f"h{i}") for i in range(len(audit.ENDS))])
    texts = ["aa", "bb", "aa", "cc", "bb", "bb", "dd", "eee", "eee", "fff"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(r["copy_id"] for r in audit.copies(docs).collect())
    assert found == [2, 4, 5, 8]


@pytest.mark.parametrize("split", audit.ENDS[:3])
def test_texts_that_part_late(spark, split):
    a = "a" * split
    docs = spark.createDataFrame([(1, a + "x"), (2, a + "y"), (3, a + "x"), (4, a), (5, a + "xx")], "doc_id long, text string")
    assert [r["copy_id"] for r in audit.copies(docs).collect()] == [3]


def test_rounds_drop_what_stands_alone(spark):
    docs = spark.createDataFrame([(i, f"text {i % 50} " + "z" * (i % 7)) for i in range(200)], "doc_id long, text string")
    text = audit.F.col("text")
    described = docs.select(audit.F.col("doc_id").alias("id"), audit.F.length("text").alias("n"), *audit.block_hashes(text))
    left = {r["id"] for r in audit.refine(described).collect()}
    counts = Counter(r["text"] for r in docs.collect())
    assert left == {r["doc_id"] for r in docs.collect() if counts[r["text"]] > 1}
