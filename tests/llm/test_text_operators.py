import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import SF, none_of, odd_documents
from tessera.llm import licenses, toxicity, urls


def test_toxicity_held_out(spark):
    rows = toxicity.op4_toxicity(spark, SF.replace("0.001", "0.1")).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(SF.replace("0.001", "0.1") + "/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right >= 0.95 * len(held)


def test_automaton_against_edit_distance():
    terms = [("moron", False, 5.0), ("pathetic", False, 4.0), ("worthless", False, 4.0), ("lowei", True, 3.0), ("idi", True, 3.0)]
    f = toxicity.Automaton(toxicity.Trie(terms))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    for w in ("moron", "m0ron", "morron", "mron", "maroon", "pathetik", "wurthles", "wrthlss", "loweischaft", "idiot", "xmoron", "moo", "", "worthles", "vvorthless", "ppathetic"):
        full = [(distance(w, t), i) for i, (t, stem, _) in enumerate(terms) if not stem and distance(w, t) <= toxicity.allowed_edits(t)]
        stem = [i for i, (t, s, _) in enumerate(terms) if s and w.startswith(t)]
        got = f.find(w)
        assert (got is None) == (not full and not stem), w
        if got and not stem:
            assert got == min(full)[::-1], w


def test_windows_and_quotation():
    f = toxicity.Finder([("moron", False, 4.0), ("idi", True, 2.0)])
    assert f.features("nothing here") == f.features(None) == f.features("") == [0.0] * toxicity.FEATURES
    plain, quoted = f.features("he is a moron today"), f.features('he said "moron" today')
    assert plain[6] == 4.0 and quoted[6] == 4.0 * toxicity.QUOTED and quoted[1] < plain[1]
    dense = f.features('he said "moron idiot moron idiot moron" today')
    assert dense[6] == 4.0  # many finds close together aren't a quotation
    near, far = f.features("moron a moron"), f.features("moron " + "a " * 200 + "moron")
    assert near[2] > far[2] and near[1] == far[1]  # the densest window
    assert f.features('"open quote\nmoron')[6] == 4.0  # marks count line by line
    assert f.features("m0ron")[6] == 4.0 * toxicity._EDITS[1]


def test_fitted_model_scores_odd_texts(spark):
    rows = [(i, f"you moron number {i}" if i % 3 == 0 else f"good day number {i}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, docs.selectExpr("doc_id", "int(doc_id % 3 = 0) AS toxic"))
    assert model.terms
    odd = odd_documents(spark).select("doc_id", "text").unionByName(spark.createDataFrame([(50, "moron " * 60_000), (51, "q" * 300_000), (52, "MORON!")], "doc_id long, text string"))
    got = {}
    for r in toxicity.score(odd, model).collect():
        got.setdefault(r["doc_id"], set()).add(round(r["toxicity"], 12))
    none = got[3] | got[2] | got[4] | got[51]
    assert len(none) == 1 and len(got[1]) == 1 and max(none) < 0.5 < min(got[52])
    assert all(0 <= x <= 1 for v in got.values() for x in v)


def test_grams_take_one_pass(spark):
    long_ = "http://z.net/" + "é" * 1_000_000
    rows = [(1, "abc"), (2, ""), (3, None), (4, "a\n\U0001f600b"), (5, long_)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    began = time.perf_counter()
    got = {r["page_id"]: r["g"] for r in df.filter("page_id < 5").select("page_id", urls._grams(F.col("url"), 2).alias("g")).collect()}
    n = df.filter("page_id = 5").select(F.size(urls._grams(F.col("url"), 5)).alias("n")).first()["n"]
    assert n == len(long_) + 1 and time.perf_counter() - began < 20
    for i, url in rows[:4]:
        marked = None if url is None else "\x02\x02" + url + "\x03"
        assert got[i] == (None if url is None else [marked[k : k + 3] for k in range(len(url) + 1)])


def test_score_leaves_a_column_of_its_name(spark):
    docs = spark.createDataFrame([(1, "you moron", "keep")], "doc_id long, text string, toxicity string")
    out = toxicity.score(docs, toxicity.Model([("moron", False, 4.0)], toxicity.fit_logistic(np.zeros((2, toxicity.FEATURES)), np.array([0.0, 1.0]))))
    assert out.columns == [*docs.columns, "_toxicity"] and out.first()["toxicity"] == "keep"


def test_toxicity_odd(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None), (7, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert all(0 <= r["_toxicity"] <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(none_of(docs), toxicity.fit(none_of(docs), none_of(labels))).count() == 0


def test_toxicity_sample_keeps_the_share(spark):
    # the term is in every toxic row and in as many clean ones, so half of the rows that have it are toxic
    rows = [(i, "you moron there" if i < 300 else "good day there") for i in range(3000)]
    rows += [(i, "you moron there") for i in range(3000, 3300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id >= 3000) AS toxic")
    probe = spark.createDataFrame([(1, "you moron there")], "doc_id long, text string")
    whole = toxicity.score(probe, toxicity.fit(docs, labels)).first()["toxicity"]
    cut = toxicity.score(probe, toxicity.fit(docs, labels, 150)).first()["toxicity"]
    assert 0.4 < whole < 0.6 and abs(cut - whole) < 0.15


def test_urls(spark):
    given = [
        (1, "https://A.Example.ORG/es/x?q"), (2, "http://org/"), (3, "http://x.com/fr/1#f"), (4, "ftp://x.COM/de/"), (5, None), (6, "no scheme"), (7, "http://example.org/en/12"),
        (8, "http://example.org/en/2"), (9, "http://notexample.org/es/"), (10, "http://x.net/fr/1"), (11, "http://x.net?y"), (12, "http://"), (13, "http://Éa.net/p#://q"), (13, "http://Éa.net/p#://q"),
    ]
    pages = spark.createDataFrame([(*g, "x", "y") for g in given], "page_id long, url string, rule string, score string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("org", "/", "org/", "allow") and got[3][2:] == ("com/fr/", "allow") and got[4][2:] == ("com/de/", "block")
    assert got[5] == got[6] == got[12] == ("", "", None, "allow")
    assert got[7][2:] == ("example.org/en/1", "block") and got[8][2:] == ("org/", "allow") and got[9][2:] == ("org/", "allow")
    assert got[10][:3] == ("x.net", "/fr/1", None) and got[11][:2] == ("x.net", "") and got[13][:2] == ("Éa.net", "/p")
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_model_tells_classes_apart(spark):
    rows = [(i, f"http://s{i % 7}.org/news/{i}") for i in range(200)] + [(i + 1000, f"http://s{i % 7}.com/de/casino-{i}") for i in range(200)]
    rows += [(5000 + i, f"http://t{i}.net/news/{i}") for i in range(50)] + [(6000 + i, f"http://t{i}.net/de/casino-{i}") for i in range(50)]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert sum(got[5000 + i] == "allow" for i in range(50)) >= 45 and sum(got[6000 + i] == "block" for i in range(50)) >= 45


def test_url_scores_are_exact(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé0123456789-") for _ in range(24))
    urls_ = [f"http://{word()}.{end}{word()}" for end in ("org/", "com/de/", "net/") for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    grams, contexts, kinds = Counter(), Counter(), defaultdict(set)

    def places(url):
        marked = "\x02" * 5 + url + "\x03"
        return [(k, marked[i - k : i], marked[i]) for i in range(5, len(marked)) for k in range(6)]

    kept = {r["page_id"] for r in pages.filter(f"pmod(xxhash64(url), {urls.HELD}) = 0").collect()}
    for i, url in enumerate(urls_[:600]):
        for k, context, char in places(url) if i not in kept else ():
            grams[i < 300, k, context, char] += 1
            contexts[i < 300, k, context] += 1
            kinds[i < 300, k, context].add(char)

    def mean(good, url):
        out, p = [], None
        for k, context, char in places(url):
            n = max(len(kinds.get((good, k, context), ())), 1)
            p = (grams[good, k, context, char] + n * (p if k else 1 / 256)) / (contexts[good, k, context] + n)
            if k == 5:
                out.append(math.log(p))
        return sum(out) / len(out)

    monkeypatch.setattr(urls, "FREQUENT", 500)
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    score = {i: mean(True, urls_[i]) - mean(False, urls_[i]) for i in [*range(600, 900), *(i for i in kept if i < 600)]}
    judged = [(score[i], i < 300) for i in kept if i < 600]
    low, high = min(judged)[0], max(judged)[0]
    width = (high - low) / urls.BINS
    binned = [(math.floor((x - low) / width), good) for x, good in judged]
    n_good = sum(good for _, good in binned)

    def errors(cut):  # URLs from bin cut on are allowed
        return sum(good for b, good in binned if b < cut) / n_good + sum(not good for b, good in binned if b >= cut) / (len(binned) - n_good)

    cuts = [errors(c) for c in range(urls.BINS + 3)]
    fits = [c for c, e in enumerate(cuts) if e <= min(cuts) + 1e-12]
    threshold = low + width * fits[len(fits) // 2]
    for i in range(600, 900):
        assert abs(got[i]["score"] - score[i]) < 1e-9 and got[i]["verdict"] == ("block" if score[i] < threshold else "allow")
    assert all(got[i]["score"] is None and got[i]["verdict"] == ("allow" if i < 300 else "block") for i in range(600))


def test_url_rules_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/pages.parquet")
    for r in urls.judge(docs).collect():
        rest = r["url"].split("://", 1)[1] if r["url"] and "://" in r["url"] else None
        host = re.split("[/?#]", rest, maxsplit=1)[0] if rest is not None else ""
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0] if rest is not None else ""
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(s + p), s + p, v) for v, s, p in urls.RULES if (host == s or host.endswith("." + s)) and path.startswith(p)]
        assert (r["host"], r["path"], r["rule"]) == (host, path, max(fits)[1] if fits else None)
        assert not fits or r["verdict"] == max(fits)[2]
    long_ = spark.createDataFrame([(1, "http://x.org/" + "ab" * 50_000), (2, "http://y.com/de/" + "é" * 50_000), (3, "http://z.net/" + "q" * 100_000)], "page_id long, url string")
    assert {r["page_id"]: r["rule"] for r in urls.judge(long_).collect()} == {1: "org/", 2: "com/de/", 3: None}


def test_licenses(spark):
    long_ = dict(licenses.TEMPLATES)["gpl-3.0-notice"]
    words = long_.split()
    rows = [
        (1, "x y. Released under the MIT License. z"), (2, None), (3, ""), (4, "a b c"), (5, f"head {long_} tail"), (6, " ".join(["q"] * 500) + " " + " ".join(words[:30] + ["odd"] + words[31:])),
        (7, " ".join(words[: len(words) // 2])), (8, "licensed UNDER\nthe apache-license;  version 2 0"), (8, "licensed UNDER\nthe apache-license;  version 2 0"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, h string")
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r["doc_id"], set()).add(r["license"])

    def shingles(t):
        w = [x for x in re.split(r"[^a-z0-9]+", t.lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = {}
    for i, t in rows:
        for name, body in licenses.TEMPLATES:
            if len(shingles(body) & shingles(t or "")) >= 0.8 * len(shingles(body)):
                want.setdefault(i, set()).add(name)
    assert got == want and 5 in got and 6 in got and 7 not in got
    assert licenses.scan(docs.limit(0)).count() == 0
    many = [(f"t{i}", " ".join(f"v{i}x{j}" for j in range(3 + i % 40))) for i in range(1000)]
    more = spark.createDataFrame([(1, f"so {many[7][1]} and {many[38][1]} it is", "x"), (2, " ".join(["word"] * 300_000), "x"), (3, "r" * 200_000, "x")], docs.schema)
    assert {(r["doc_id"], r["license"]) for r in licenses.scan(more, many).collect()} == {(1, "t7"), (1, "t38")}
    plan = licenses.scan(docs, many)._jdf.queryExecution().executedPlan().toString() + licenses.candidates(docs, licenses.template_index(spark, many))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert docs.filter(F.col("doc_id") == 8).count() == 2


def test_lexicon_has_no_caps(spark):
    """Short and long words count, however many there are; significance is that of the table of documents."""
    g = toxicity.likelihood_ratio(F.lit(9.0), F.lit(1.0), 20.0, 80.0)
    cells, n = [(9, 20 * 10 / 100), (11, 20 * 90 / 100), (1, 80 * 10 / 100), (79, 80 * 90 / 100)], 2
    assert abs(spark.range(1).select(g).first()[0] - n * sum(o * math.log(o / e) for o, e in cells)) < 1e-9
    long = "q" * 200
    bad = [(f"xq {long} filler{i}", 1, 1.0) for i in range(20)]
    clean = [(f"plain filler{i} of them", 0, 1.0) for i in range(40)]
    terms = toxicity.learn_lexicon(spark.createDataFrame(bad + clean, "text string, toxic int, weight double"))
    assert {t for t, stem, _ in terms if not stem} == {"xq", long}
    many = [(" ".join(f"z{i % 3}y{k}" for k in range(2000)), 1, 1.0) for i in range(60)] + clean
    words = toxicity.learn_lexicon(spark.createDataFrame(many, "text string, toxic int, weight double"))
    assert sum(not stem for _, stem, _ in words) == 6000
