from tests.llm.helpers import none_of, odd_documents
from tessera.llm import lines as L


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute(rows):
    seen, out = [], {}
    for doc, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            if line.strip() and (line in {s for s in seen} or len(line) >= L.MIN_CHARS and any(len(s) >= L.MIN_CHARS and abs(len(s) - len(line)) < 2 and edits(s, line) < 2 for s in set(seen))):
                seen.append(line)
                continue
            if line.strip():
                seen.append(line)
            kept.append(line)
        out[doc] = "\n".join(kept)
    return out


def test_against_brute_force(spark):
    a = "the quick brown fox jumps over the lazy dog"
    texts = [f"{a}\nplain line\n\nother words stand here, more of them", f"{a[1:]}\n{a}x\n{a[:20]}Z{a[21:]}\nplain line", f"{a[:20]}{a[21:]}\n{a}xy\nshort\nshorT", f"{a[:3]}Q{a[3:]}\n{a[:-1]}\nshort\naaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaa\naaaaaaaaaaaaaaaaaa\nbaaaaaaaaaaaaaaaaaaa", "other words stand here, more of thee\nother words stand hare, more of thee\n  \n"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(docs).collect()}
    assert got == brute(rows)


def test_odd(spark):
    docs = odd_documents(spark)
    got = [(r["doc_id"], r["text"], r["n_chars"], r["_emptied"]) for r in L.dedup_lines(docs).collect()]
    assert len(got) == 10
    assert (6, "", 0, True) in got and (3, None, None, None) not in [g for g in got if g[3]]
    assert sum(1 for g in got if g[0] == 1 and g[1]) == 2  # equal rows keep the same lines
    assert L.dedup_lines(none_of(docs)).count() == 0


def test_min_chars(spark):
    rows = [(1, "short line\nother"), (2, "shart line\nothers")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in L.dedup_lines(docs, 8).collect()} == {1: rows[0][1], 2: "others"}
    assert {r["doc_id"]: r["text"] for r in L.dedup_lines(docs).collect()} == dict(rows)
