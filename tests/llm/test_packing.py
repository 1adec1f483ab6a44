import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import SF, none_of, odd_documents
from tessera.llm import packing as P


def naive(counts, top):
    rooms = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fits = [i for i, r in enumerate(rooms) if r >= n]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= n
            else:
                rooms.append(top - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    top = rng.choice([10, 16, 37])
    counts = {rng.randint(1, top): rng.randint(1, 30) for _ in range(rng.randint(1, 8))}
    p, bins = P.plan(counts, top), {}
    for n, c in counts.items():
        for r in range(c):
            row = [x for x in p if x[0] == n and x[1] <= r][-1]
            turn = r - row[1]
            bins.setdefault(row[2] + turn // row[3], []).append((row[4] + turn % row[3] * n, n))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= top
    assert len(bins) == naive(counts, top) == max(bins) + 1


def test_segment_tree():
    tree = P.SegmentTree(10)
    for c in (3, 7, 10):
        tree.set(c, True)
    assert [tree.tightest(c) for c in (0, 3, 4, 8, 10)] == [3, 3, 7, 10, 10]
    tree.set(10, False)
    assert tree.tightest(8) is None


def test_encoder_agrees_with_tokenizers():
    enc, rng = P.Encoder(P.vocabulary()), random.Random(1)
    texts = ["", " ", "a  b", " a", "a ", "a\n b", "a\nb", "it's don't 's", "x\n\ny", "a\tb", "a b", "日本 語", "<|endoftext|> a", "a\x1cb c"]
    texts += ["".join(rng.choice("ab1. \n\t,'sé") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for t, e in zip(texts, enc.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert enc.encode(t) == enc.pack(e.ids), t


def check(rows, docs_ids):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at and 0 < n <= 1024
            at += n
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(bins) <= -(-total // 1024) * 1.1 + 1
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows if r["piece"] == 0) == sorted((i is None, i) for i in docs_ids)


def test_pack_odd_and_round_trip(spark):
    docs = odd_documents(spark)
    rows = P.pack(docs, P.vocabulary()).collect()
    check(rows, [r["doc_id"] for r in docs.collect()])
    assert P.pack(none_of(docs), P.vocabulary()).collect() == []
    packed = P.packed_sequences(docs, P.vocabulary()).collect()
    matrix, enc = P.read_matrix(packed), P.Encoder(P.vocabulary())
    got = {}
    for line, r in zip(matrix, packed, strict=True):
        cuts = r["cu_seqlens"]
        assert cuts[-1] == r["n_tokens"] and not line[r["n_tokens"] :].any()
        places = np.frombuffer(r["position_ids"], "<u2")
        for d, a, b in zip(r["doc_ids"], cuts, cuts[1:], strict=False):
            got.setdefault(d, []).append(line[a:b].tolist())
            assert places[a:b].tolist() == list(range(b - a))
    whole = np.frombuffer(enc.encode(docs.filter("doc_id = 5").first()["text"]), "<u2").tolist() + [2]
    assert sorted(map(len, got[5])) == sorted([len(whole) % 1024] + [1024] * (len(whole) // 1024))
    assert sorted(x for part in got[5] for x in part) == sorted(whole)
    # in order: the written rows, cut where the pieces say, give back the ids of every document
    rows = P.place(P.token_pieces(docs, P.vocabulary()).persist()).collect()
    lines, parts = {r["sequence_id"]: line for r, line in zip(packed, matrix, strict=True)}, {}
    for r in P.pack(docs, P.vocabulary()).collect():
        ids = lines[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tolist()
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        parts.setdefault(r["doc_id"], []).append((r["piece"], r["start"], ids))
    assert len(rows) == sum(map(len, parts.values()))
    for r in docs.collect():
        want = enc.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        pieces = sorted(parts[r["doc_id"]])
        same = [p for p in pieces if p[0] == 0]
        if len(same) == 1:
            assert [x for _, _, ids in pieces for x in ids] == want
            assert [s for _, s, _ in pieces] == np.cumsum([0] + [len(ids) for _, _, ids in pieces])[:-1].tolist()


def test_one_long_token(spark):
    docs = spark.createDataFrame([(1, "x" * 300_000), (2, "é" * 50_000)], "doc_id long, text string")
    enc = P.Encoder(P.vocabulary())
    for r in docs.collect():
        mine = sorted((x["start"], x["length"]) for x in P.pack(docs.filter(f"doc_id = {r['doc_id']}"), P.vocabulary()).collect())
        n = len(enc.tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
        assert sum(k for _, k in mine) == n and all(k == 1024 for s, k in mine if s)


def test_query(spark):
    rows = P.op2_packing(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(rows, list(docs))
    enc, parts = P.Encoder(P.vocabulary()), {}
    for r in rows:
        parts.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for i, text in docs.items():
        ids = enc.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for start, n, crc in parts[i]:
            assert zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()) == crc
        assert sum(n for _, n, _ in parts[i]) == len(ids)


def test_few_kept_words_change_no_ids(spark):
    texts = ["one two three, four. one two", "", None, "two\nthree  one " * 40, "x" * 70 + " y", "don't, stop!"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few, many = (sorted(map(tuple, P.pack(docs, P.vocabulary(), kept=kept).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) for kept in (2, 250_000))
    assert few == many and len(few) == len(texts)
    enc = P.Encoder(P.vocabulary(), 2)
    for text in texts:
        enc.encode(text or "")
    assert len(enc.words) <= 2 and len(enc.words.old) <= 2
