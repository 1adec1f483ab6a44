"""Operator 9: URL filters by a character language-model ratio.

Rules over host and path judge the URLs they fit.  The URLs that rules accept or reject train two variable-order
Markov models over characters: counts of (context, next character) of every order up to a limit, gathered from all
judged rows, kept exactly in a distributed table of the different grams (a character with those before it), and blended
from low to high order (Witten-Bell smoothing).  A URL that no rule fits is blocked where the length-normalised
log-likelihood difference, accepted minus rejected, is under a threshold.  The threshold is calibrated on judged URLs
that the models were not trained on, one in HELD by hash of the URL: of their scores, binned, the cut that errs least,
each class counted alike; without such URLs of both classes it is 0, where both models find a URL equally likely.

Defined results: a null URL or one without :// has empty host and path and, with nothing to score, is allowed; equal
URLs get equal verdicts; an empty table gives an empty result; if rules judge no URL that trains, or only one way, no
model tells the classes apart and unjudged URLs are allowed; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, table

#: (verdict, host suffix, path prefix), as the contract gives them
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 5
BINS = 400
HELD = 5
#: bound on the grams whose ratios are broadcast; it spares shuffles and decides nothing
FREQUENT = 1 << 16
#: ratios are whole numbers of 1 / FIXED
FIXED = float(1 << 36)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ://."""
    rest = F.when(url.contains("://"), F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_fit(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for said, suffix, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(suffix + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _grams(url: Column, order: int) -> Column:
    """For each character and the end of the url: the order characters before it (marks before the start) and itself."""
    marked = F.concat(F.lit("\x02" * order), url, F.lit("\x03"))
    # one pass over the url: each match takes one character and captures the gram that begins there
    return F.regexp_extract_all(marked, F.lit(rf"(?s)(?=(.{{{order + 1}}}))."), F.lit(1))


def gather_grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, n (how often it occurs), n0 and n1 (how often in rejected and accepted rows) over every row of urls (url,
    accepted 0/1 or null).  A row a different gram, so the table grows with what there is to count."""
    each = urls.select("accepted", F.explode(_grams(F.col("url"), order)).alias("gram"))
    of = [F.count(F.when(F.col("accepted") == c, 1)).alias(f"n{c}") for c in (0, 1)]
    return materialize(each.groupBy("gram").agg(F.count("*").alias("n"), *of), "grams")


def gram_ratios(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, ratio: log likelihood of a gram's last character after the others, accepted minus rejected, in FIXED
    units.  Order by order, each different ending of the grams is joined to its context's counts (how often it occurs,
    and before how many different characters) and to the probability at the order below.  An ending or context has at
    most as many rows in a join as there are characters."""
    below = None
    for k in range(order + 1):
        ending = F.substring("gram", order + 1 - k, k + 1)
        now = grams.groupBy(ending.alias("ending")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        now = now.withColumn("context", F.substring("ending", 1, k))
        totals = [F.sum(f"n{c}").alias(f"t{c}") for c in (0, 1)]
        kinds = [F.greatest(F.count(F.when(F.col(f"n{c}") > 0, 1)), F.lit(1)).alias(f"k{c}") for c in (0, 1)]
        after = now.join(now.groupBy("context").agg(*totals, *kinds), "context")
        if below is None:
            after = after.withColumns({"b0": F.lit(1 / 256.0), "b1": F.lit(1 / 256.0)})
        else:
            lower = below.select(F.col("ending").alias("shorter"), F.col("p0").alias("b0"), F.col("p1").alias("b1"))
            after = after.withColumn("shorter", F.substring("ending", 2, k)).join(lower, "shorter")
        p = [((F.col(f"n{c}") + F.col(f"k{c}") * F.col(f"b{c}")) / (F.col(f"t{c}") + F.col(f"k{c}"))).alias(f"p{c}") for c in (0, 1)]
        below = materialize(after.select("ending", *p), "order")
    ratio = F.round((F.log("p1") - F.log("p0")) * FIXED).cast("long")
    return below.select(F.col("ending").alias("gram"), ratio.alias("ratio"))


def url_scores(urls: DataFrame, grams: DataFrame, order: int = ORDER) -> DataFrame:
    """row, score: the mean of the ratios of a url's grams.  The grams that make up at least one in FREQUENT are joined
    where the urls are, the others by a shuffle; both joins are exact, and sums of whole numbers don't depend on order."""
    ratios = materialize(gram_ratios(grams, order).join(grams.select("gram", "n"), "gram"), "ratios")
    total = ratios.agg(F.sum("n")).first()[0]
    often = F.broadcast(ratios.filter(F.col("n") * FREQUENT >= total).select("gram", "ratio"))  # at most FREQUENT rows
    each = urls.select("row", F.explode(_grams(F.col("url"), order)).alias("gram"))
    rare = each.join(often, "gram", "left_anti").join(ratios.select("gram", "ratio"), "gram")
    both = [x.groupBy("row").agg(F.sum("ratio").alias("s"), F.count("*").alias("c")) for x in (each.join(often, "gram"), rare)]
    total = both[0].unionByName(both[1]).groupBy("row").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    return total.select("row", (F.col("s") / F.col("c") / FIXED).alias("score"))


def calibrate(scores: DataFrame, bins: int = BINS) -> float:
    """The threshold on score (of accepted and rejected rows) with the least sum of both classes' error rates."""
    bounds = scores.agg(F.min("score"), F.max("score")).first()
    low, high = bounds[0] or 0.0, bounds[1] or 0.0
    width = max(high - low, 1e-9) / bins
    got = scores.groupBy(F.floor((F.col("score") - low) / width).alias("bin"), "accepted").count().collect()
    n = np.zeros((2, bins + 2))
    for r in got:
        n[r["accepted"], int(r["bin"])] += r["count"]
    if not n.sum(axis=1).all():
        return 0.0
    share = n / np.maximum(n.sum(axis=1, keepdims=True), 1)
    wrong = np.concatenate([[0], np.cumsum(share[1])]) + 1 - np.concatenate([[0], np.cumsum(share[0])])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return low + width * float(best[len(best) // 2])


def judge(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """page_id, url, host, path, rule, verdict and score (null where no model was asked)."""
    base = pages.select("page_id", "url")
    host, path = split_url(F.col("url"))
    base = base.withColumn("host", host).withColumn("path", path)
    rule, said = rule_fit(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("said", said)
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "ruled")
    kept = F.pmod(F.xxhash64("url"), F.lit(HELD)) == 0  # equal URLs are on the same side
    both = base.filter(F.col("said").isNotNull() & ~kept).select("said").distinct().count() == 2
    if not both:
        return base.select("page_id", "url", "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    ruled = F.col("said").isNotNull()
    asked = ruled | (F.col("host") != "") | (F.col("path") != "")
    urls = base.filter(asked).select("row", "url", F.when(ruled & ~kept, (F.col("said") == "allow").cast("int")).alias("accepted"), (~ruled | kept).alias("scored"))
    scores = url_scores(urls.filter("scored"), gather_grams(urls, order), order).withColumnRenamed("score", "_score")
    base = materialize(base.join(scores, "row", "left"), "scored")
    judged = base.filter("said is not null and _score is not null")
    threshold = calibrate(judged.select(F.col("_score").alias("score"), (F.col("said") == "allow").cast("int").alias("accepted")))
    base = base.withColumn("score", F.when(F.col("said").isNull(), F.col("_score")))
    verdict = F.coalesce("said", F.when(F.col("score") < F.lit(threshold), "block").otherwise("allow"))
    return base.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"), "score")


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")
