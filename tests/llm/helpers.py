"""Small tables with nulls, empty and long texts, repeats and clashing columns."""

SF = "/root/testdata/sf0.001"


def odd_documents(spark):
    """Documents whose columns take every odd value; extra columns clash with names the operators use."""
    long_ = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 33),
        (1, "one two three four five six seven", "en", "a", 33),
        (2, "", "en", "a", 0),
        (3, None, "en", "b", None),
        (4, "   \n\t ", None, None, 6),
        (None, "a text without an id that goes on for a while", "en", "b", 10),
        (None, None, None, None, None),
        (5, long_, "en", None, len(long_)),
        (6, "one two three four five six seven", "de", "c", 33),
        (7, "short", "de", "c", 5),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["key", "fp", "size", "part", "v", "root", "length", "digest", "target", "toxicity", "gone", "gid", "gfp", "maybe", "held", "h", "turn"]
    clash += ["copies", "passes", "last", "source_of", "lines_dropped", "emptied", "_fp", "_source", "_n", "_maybe", "_copies", "_passes", "_last", "_id"]
    return df.selectExpr("*", *[f"'x' AS {c}" for c in clash])


def none_of(df):
    return df.limit(0)
