import random

from pyspark.sql import functions as F

from tessera.functions import text as X


def values(spark, column, *inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, t string")
    return [r[0] for r in rows.select(column(F.col("t")).alias("x"), "i").orderBy("i").select("x").collect()]


def test_norm(spark):
    given = ["Éa  Straße!", None, " A_b-C ", "İstanbul", "ﬁn"]
    got = values(spark, X.norm, *given)
    assert got[:3] == ["ea stra e", "", "a b c"]
    exact = X.exact_norm(__import__("pandas").Series(given))
    assert list(exact[:3]) == got[:3] and exact[4] == got[4] == "fin"
    rng = random.Random(5)
    odd = ["".join(rng.choice(" aé\u0301\u0308ｆＦ²Åªº①ﬁﬃ№™ǅŭ日本_-\n\t\u00a0\u2003ß") for _ in range(20)) for _ in range(300)]
    odd = [x.replace("ǅ", "") for x in odd]
    assert values(spark, X.norm, *odd) == list(X.exact_norm(__import__("pandas").Series(odd)))


def test_dates(spark):
    got = values(spark, X.parse_date, "2020-01-02", "2020-01-02T10:00", "3/4/1999", "03-04-1999", "2001/5/6", "about 1987", "Tardo 1998", "soon", None)
    assert [str(d) for d in got] == ["2020-01-02", "2020-01-02", "1999-04-03", "1999-04-03", "2001-05-06", "1987-01-01", "None", "None", "None"]
    assert values(spark, X.year, "between 1910 and 1922", "12345", "x1999y", "") == ["1910", "", "", ""]
    assert values(spark, X.year_in, "c1910-2006", "12345", "x1999y") == ["1910", "", "1999"]
    got = values(spark, X.parse_date, "3.4.1999 -> 2000-01-01", "1999-04-03→2000-01-01", "0987", "18th of 1750", "\t2001 ")
    assert [str(d) for d in got] == ["1999-04-03", "1999-04-03", "0987-01-01", "None", "2001-01-01"]


def test_urls_and_names(spark):
    assert values(spark, X.normalize_url, "HTTPS://www.A.org/B/?q#f", "a.org/B", "http://x.org") == ["a.org/B", "a.org/B", "x.org"]
    assert values(spark, X.name_form, "Lee, Ann B.", "Ann Lee") == ["ann lee", "ann lee"]
    assert values(spark, X.slug, " Été à Paris! ", "--") == ["ete-a-paris", "senza-titolo"]
    assert values(spark, X.canonical_name, "anna maria rossi") == ["ROSSI_Anna_Maria"]
    assert values(spark, X.path_ok, "a/b", "/a", "a/../b", "a//b", "./a", "a\\b", "a/b..c") == [True, False, False, False, False, False, True]


def test_chunks(spark):
    text = "First sentence. Second one!\n\nA new paragraph? " + "word " * 100
    for limit in (10, 60, 1000):
        chunks = values(spark, X.lossless_chunks(limit), text, "", None)
        assert "".join(chunks[0]) == text and all(len(c) <= limit for c in chunks[0]) and chunks[1] == chunks[2] == [""]
    windows = values(spark, lambda c: X.fixed_chunks(c, 10, 3), "abcdefghijklmnopqrstuvwxyz", "", "short")
    assert windows == [["abcdefghij", "hijklmnopq", "opqrstuvwx", "vwxyz"], [""], ["short"]]
    packed = values(spark, X.paragraph_chunks(12), "aaa\n\nbbb\n\n" + "c" * 30)
    assert packed[0] == ["aaa\n\nbbb", "c" * 12, "c" * 12, "c" * 6]
    assert values(spark, X.halves(), "One two. Three four five", "abcdef", "x") == [["One two. ", "Three four five"], ["abc", "def"], None]
    assert values(spark, X.lossless_chunks(14), 'He said "no." Then he\n\n\nleft.') == [['He said "no." ', "Then he\n\n\n", "left."]]


def test_mail_and_html(spark):
    assert values(spark, X.strip_quoted, "hello\n> old\nOn Monday X wrote:\nmore", "plain") == ["hello", "plain"]
    assert values(spark, X.html_to_text, "<p>a&amp;b</p><script>x<y</script><b>c</b>") == ["a&bc"]
    assert values(spark, X.redact, "password = abc, TOKEN: x y") == ["password = [REDACTED] TOKEN: [REDACTED] y"]
    assert values(spark, X.redact, "Authorization: Bearer1 x", "api_key=k") == ["Authorization: [REDACTED] x", "api_key=k"]
    front = values(spark, X.split_frontmatter, "---\ntitle: 'x: y'\nb: 1\ntitle: z\n---\n\nbody", "none", "---\nopen")
    assert front[0]["known"] == {"title": "z"} and front[0]["other"] == ["b: 1"] and front[0]["body"] == "body"
    assert front[1]["body"] == "none" and front[2]["body"] == "---\nopen"


def test_blank(spark):
    assert values(spark, X.is_empty, None, "", " \t\n\u2003", "x") == [True, True, True, False]
    assert values(spark, X.lines, "a\t\n\t\n b") == [["a", "b"]]


def test_markers_and_lists(spark):
    assert values(spark, lambda c: X.marker_at(c, "safety data"), "The Safety\n data sheet", "none") == [4, -1]
    assert values(spark, X.deadline_excerpt, "pagare entro 30 giorni " + "x" * 200, "no " * 200) == ["pagare entro 30 giorni " + "x" * 79, ("no " * 100).strip()]
    assert values(spark, X.as_list, '["a","b"]', "a, ,b", None) == [["a", "b"], ["a", "b"], []]
    assert values(spark, X.headings, "# One\ntext\n##  Two") == [["One", "Two"]]
    assert values(spark, lambda c: X.key_numbers(c, [r"\d+%"]), "5% and 7% and 5%") == [["5%", "7%"]]
    assert values(spark, lambda c: X.safe_text(c, 8), " a  b ", "abcdefghijk") == ["a b", "abcdef …"]
    assert values(spark, lambda c: X.human_size(c.cast("long")), "10", "2048", "5242880") == ["10 B", "2.0 KB", "5.0 MB"]


def test_character_references(spark):
    import html

    texts = ["a &amp; b &lt;c&gt; &agrave;&#8217;&#x27;&#128;&#0;", "&nope; & x &#99999999; &#xD800; &#x1F600;", "&&amp;lt; &NotEqualTilde; &#x2014", "plain", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.unescape(F.col("t"))).collect()] == [html.unescape(t) for t in texts]


def test_sensitive_patterns(spark):
    cases = {"secret: x": "", "authorization=abcdefgh": "credential_assignment", "sk-" + "a" * 20: "api_key", "see /home/ann": "personal_absolute_path", "x/home/ann": "", "-----BEGIN OPENSSH PRIVATE KEY-----": "private_key", "-----BEGIN DSA PRIVATE KEY-----": ""}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r["t"]: r["f"] for r in df.select("t", F.array_join(X.sensitive_findings(F.col("t")), "|").alias("f")).collect()} == cases


def test_strips_are_pythons(spark):
    df = spark.createDataFrame([("\n\tabc def\u00a0\x1c\n", "a\t;\u2003b ,;")], "t string, m string")
    r = df.select(X.fixed_chunks(F.col("t")).alias("c"), X.split_multi(F.col("m")).alias("m")).first()
    assert r["c"] == ["abc def"] and r["m"] == ["a", "b"]


def test_extraction_statuses(spark, tmp_path):
    from tessera.sources import extract_text

    for name, data in {"a.txt": b"one", "b.md": b"\xff\xfe", "c.csv": b"x" * 100, "d.xyz": b"?", "e.json": b"{}", "f.pdf": b"%PDF"}.items():
        (tmp_path / name).write_bytes(data)
    index = spark.createDataFrame([(f"file:{tmp_path}/e.json", "0" * 64)], "path string, sha256 string")
    got = {r["path"].rsplit("/", 1)[1]: (r["status"], r["text"]) for r in extract_text(spark, str(tmp_path), 50, index).collect()}
    assert got == {"a.txt": ("SUCCESS", "one"), "b.md": ("EXTRACTION_FAILED", None), "c.csv": ("FILE_TOO_LARGE", None), "d.xyz": ("UNSUPPORTED_FORMAT", None), "e.json": ("EXTRACTION_ABORTED_STALE_HASH", None)}


def test_norm_over_every_character(spark):
    import pandas as pd

    xs = [f"a{chr(c)}b {chr(c)}Z" for c in [*range(0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE0200)]]
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(xs)), "t": xs}))
    got = df.select("i", X.norm(F.col("t")).alias("x")).toPandas().sort_values("i")["x"].tolist()
    want = list(X.exact_norm(pd.Series(xs)))
    assert [(x, g, w) for x, g, w in zip(xs, got, want, strict=True) if g != w] == []
    assert values(spark, X.norm, "½ Ǆ ⒇ ㎯", "𝔘nion") == ["1 2 dz 20 rad s2", "union"]


def parsed_text(html):
    """What html.parser makes of a page."""
    import re
    from html.parser import HTMLParser

    class Text(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.within = [], 0

        def handle_starttag(self, tag, attrs):
            self.within += tag in ("script", "style")
            self.out.append("\n" if tag in ("br", "p", "div", "tr", "li") and not self.within else "")

        def handle_endtag(self, tag):
            self.within -= tag in ("script", "style") and self.within > 0

        def handle_data(self, data):
            self.out.append("" if self.within else data)

    p = Text()
    p.feed(html)
    return re.sub(r"\n{3,}", "\n\n", "".join(p.out)).strip()


def test_html_is_taken_from_left_to_right(spark):
    rng = random.Random(8)
    parts = ["<p>", "</p>", "<BR/>", "<br >", "<b class='a>b' id=\"x>y\">", "</b>", "<!-- <script> -->", "<!doctype html>", "<?pi x?>", "<li\n>", "<script>", "</script>", "<script src='q>'>if (a<b) x='<p>';", "</SCRIPT >", "<style/>", "<style>p{}", "</style>", "<scripty>", "<pre>", " text ", "a < b", "1<2", "&amp;", "&lt;p&gt;", "&#8217;", "AT&T", "&", "\n\n\n\n", "<!-- open", "</ >", "</3>", "<a href=", "é", "=", "<![CDATA[x]]>", "<a b=c=d>", "'", "-->", "<"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    got = values(spark, X.html_to_text, *pages)
    wrong = [(p, g, parsed_text(p)) for p, g in zip(pages, got, strict=True) if g != parsed_text(p)]
    assert len(wrong) == 0, (len(wrong), wrong[:4])
    deep = "<a " + " ".join(f"k{i}='>'" for i in range(300)) + ">x" + "<p>y" * 50_000
    assert values(spark, X.html_to_text, deep, "<script>" + "a<b " * 200_000, None) == [("x" + "\ny" * 50_000), "", None]


def test_character_references_are_the_standards(spark):
    import html
    import html.entities

    rng = random.Random(9)
    names = sorted(html.entities.html5)
    texts = [f"&{n}x" for n in names] + [f"&#{n};" for n in [*range(0, 300), 0xFDD0, 0xFFFE, 0x1FFFF, 0x10FFFE, 0x110000, 10**30]]
    parts = ["&", "amp", "notit;", "copy", "lt", ";", " ", "#", "x41", "65", "not", "AMP;", "hellip", "é", "&&", "ampamp;", "nbsp"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) for _ in range(3000)]
    got = values(spark, X.unescape, *texts)
    assert [(t, g, html.unescape(t)) for t, g in zip(texts, got, strict=True) if g != html.unescape(t)] == []
