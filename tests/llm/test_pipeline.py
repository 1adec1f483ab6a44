import re
from collections import Counter

import corpus_pipeline as C
from tests.llm import test_lines, test_mixing, test_near, test_packing
from tests.llm.helpers import SF, none_of, odd_documents
from tessera.llm import mixing, packing, toxicity
from tessera.llm.common import materialize, table


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, [{r["doc_id"] for r in docs.collect()}]
    for name, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SF), "test")
        if name != "packing":
            assert docs.columns == columns, name
        ids = {r["doc_id"] for r in docs.collect()}
        assert ids and ids <= seen[-1], name
        seen.append(ids)


def test_odd_columns_stay(spark):
    docs = odd_documents(spark)
    columns = docs.columns
    for name, stage in C.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "test")
        assert docs.columns == columns, name
        rows = docs.collect()
        assert rows and all(r[c] == "x" for r in rows for c in columns[5:]), name
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in rows}


def test_empty(spark):
    docs = none_of(table(spark, SF, "documents"))
    for _, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SF), "test")
        assert docs.count() == 0


def test_run_by_brute_force(spark, tmp_path):
    """Every stage by itself in plain Python, on a table of 260 documents with copies, near copies and toxic ones."""
    big = SF.replace("0.001", "0.01")
    some = table(spark, big, "documents").join(table(spark, big, "labels").select("doc_id", "toxic"), "doc_id", "left")
    rows = [r.asDict() for r in some.filter("doc_id < 180 or toxic = 1").collect()]
    more = []
    for i, r in enumerate(rows[:40]):
        words = (r["text"] or "").split(" ")
        words[len(words) // 2] = "changed"
        more += [r | {"doc_id": 100_000 + i}, r | {"doc_id": 200_000 + i, "text": " ".join(words)}]
    columns = table(spark, SF, "documents").columns
    docs = [{c: r[c] for c in columns} for r in rows + more]
    spark.createDataFrame(docs, table(spark, SF, "documents").schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r["doc_id"], 0, r["toxic"] or 0) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    model = toxicity.fit(table(spark, str(tmp_path), "documents"), table(spark, str(tmp_path), "labels"))
    held = [r for r, x in zip(docs, model.scores([r["text"] for r in docs]), strict=True) if x < C.TOXIC]
    assert model.terms and len(held) < len(docs)
    texts = test_lines.brute([(r["doc_id"], r["text"]) for r in held])
    changed = {r["doc_id"] for r in held if texts[r["doc_id"]] != r["text"]}
    held = [r | {"text": texts[r["doc_id"]]} for r in held if r["doc_id"] not in changed or texts[r["doc_id"]].strip()]
    same = test_near.brute_classes([(r["doc_id"], r["text"]) for r in held])
    held = [r for r in held if same[r["doc_id"]] == r["doc_id"]]

    def size(r):
        return len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))

    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in held], "doc_id long, text string")
    keys = {r["doc_id"]: r["key"] for r in frame.select("doc_id", mixing._key(17).alias("key")).collect()}
    of: dict = {}
    for r in held:
        of.setdefault(r["source"], []).append(r)
    copies: Counter = Counter()
    for source, target in test_mixing.targets({s: sum(map(size, v)) for s, v in of.items()}).items():
        whole = sum(map(size, of[source]))
        passes, rest = divmod(min(round(target), 3 * whole), max(whole, 1))
        before, last = 0, -1
        order = sorted(of[source], key=lambda r: keys[r["doc_id"]])
        for i, r in enumerate(order):
            cut = max(0, min(size(r), rest - before))
            last = i if cut and cut * 2 >= size(r) else last
            before += size(r)
        for i, r in enumerate(order):
            copies[r["doc_id"]] = passes + (i <= last) if size(r) else 1
    enc = packing.Encoder(packing.vocabulary())
    lengths: Counter = Counter()
    want: Counter = Counter()
    for r in held:
        n = len(enc.tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
        cuts = [n % 1024 or 1024] + [1024] * ((n - 1) // 1024)
        for piece, k in enumerate(cuts if n > 1024 else [n]):
            want[r["doc_id"], piece, k] += copies[r["doc_id"]]
            lengths[k] += copies[r["doc_id"]]
    got = C.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in got) == +want
    assert len({r["sequence_id"] for r in got}) == test_packing.naive(+lengths, 1024)
    test_packing.check(got, [i for i, n in copies.items() for _ in range(n)])
