import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import SF, none_of, odd_documents
from tessera.llm import bpe


@pytest.fixture(scope="module")
def mine():
    return bpe.Codec(bpe.ranks_path())


@pytest.fixture(scope="module")
def theirs(mine):
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mine.ranks, special_tokens={})
    return lambda t: np.array(encoding.encode_ordinary(t), "<u4").tobytes()


def same(mine, theirs, text):
    ids = mine.encode(text)
    assert ids == theirs(text), text[:100]
    assert mine.decode(ids) == text.encode()


def test_odd_texts(mine, theirs):
    for t in ("", " ", "a  b", " a", "a ", "a\n b", "a\nb", "\na", "it's don't 's", "x\n\ny", "a\tb", "<|endoftext|>", "a\x1cb\x85c\xa0d", "'re 'rE", "ab, cd. é, 1, a!! b? c,. \na, x,", "a. b, c\nd."):
        same(mine, theirs, t)


def test_random_texts(mine, theirs):
    rng = random.Random(1)
    for _ in range(5000):
        same(mine, theirs, "".join(rng.choice("ab1. \n\t,'séxxxx日") for _ in range(rng.randint(0, 40))))
    tokens = [b.decode() for b in mine.ranks if b.isalpha()]
    for _ in range(1000):
        same(mine, theirs, "".join(rng.choice(tokens) for _ in range(rng.randint(1, 60))))


@pytest.mark.parametrize("text", [" " * 5000, "x" * 5000, " " + "x" * 5001, "ab" * 3000 + "c", "é" * 3000, "thononon" * 500, "a b " * 50_000, "q" * 70_000 + " b" * 50_000, "a b" + "=- " * 3 + "-" * 90_000])
def test_long_matches_and_texts(mine, theirs, text):
    same(mine, theirs, text)


def test_leaves_are_whole_and_small(mine):
    text = "word " * 60_000 + "y" * 100_000 + " tail\nof it"
    parts = list(mine.leaves(text))
    assert "".join(parts) == text and all(len(p) <= bpe.LEAF or "yy" in p for p in parts)


def test_join_is_associative(mine):
    rng = random.Random(2)
    tokens = list(mine.ranks)
    for _ in range(500):
        a, b, c = ([i for i in mine.merge(rng.choice(tokens) + rng.choice(tokens))] for _ in range(3))
        assert mine.join(mine.join(a, b), c) == mine.join(a, mine.join(b, c)) == mine.merge(b"".join(mine.tokens[i] for i in a + b + c))


def test_both_merges_agree(mine):
    rng = random.Random(3)
    for _ in range(300):
        piece = bytes(rng.choice(b"aabbc \xc3\xa9") for _ in range(rng.randint(1, 96)))
        assert mine.merge(piece) == mine._merge_many(piece)


def test_memories_stay_bounded(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 5)
    small = bpe.Codec(bpe.ranks_path())
    same(small, theirs, "some words that are longer than what is kept, once and again and once more")
    assert max(len(k) + len(k.old) for k in (small.units, small.spaced, small.halves, small.windows)) <= 10


def test_odd_tables(spark, mine):
    docs = odd_documents(spark).selectExpr("*", "'x' AS token_ids", "'y' AS token_bytes")
    out = bpe.encode(docs, bpe.ranks_path())
    assert out.columns == docs.columns + ["_token_ids"]
    back = bpe.decode(out, "_token_ids", bpe.ranks_path())
    rows = back.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert bytes(r["_token_ids"]) == mine.encode(r["text"] or "") and bytes(r["_token_bytes"]).decode() == (r["text"] or "")
    assert bpe.encode(none_of(docs), bpe.ranks_path()).count() == 0
    null = bpe.decode(spark.createDataFrame([(None,)], "ids binary"), "ids", bpe.ranks_path())
    assert null.first()["token_bytes"] is None


def test_query(spark, theirs):
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = theirs(r["text"] or "")
        want.append((r["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe.op11_bpe(spark, SF).collect()]
    assert sorted(got) == sorted(want)
