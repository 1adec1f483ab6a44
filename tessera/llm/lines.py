"""Operator 8: line deduplication by a deletion-neighbourhood join.

Every non-blank line of every document is a candidate; the earliest by (doc_id, line number) stays.  Equal lines meet by
a 128-bit hash.  The edit bound is one edit in MIN_CHARS characters: shorter lines go only for equal ones (every "1."
is within an edit of every "2."); lines from MIN_CHARS on also go if an earlier line is within one edit (Levenshtein):
both lines emit their variants with one character deleted as hashed keys, equal keys are joined and the edit distance is
verified on the texts.

Lines with a near twin agree outside one of SEGMENTS stretches, wherever they are cut.  So lines first emit a key for
each stretch, of all that lies outside it, first with two and then with eight stretches; lines that share no such key
have no twin, and the others emit variants only for deletions within stretches whose key they share.  That loses no
pair.  Two lines of one length that differ in place p share the variant without p, and all lines that share it differ in
that place alone, so each is compared with the earliest of them; a line that is itself the variant of longer ones is
compared with each of these.  No other pairs are made.

Joins on lines, keys and variants have one row of a key on one side, so a line that is in very many documents makes no
square; its rows on the other side are one key's, which Spark's adaptive execution splits over tasks.

A line goes if an earlier line is equal or within the bound, whether or not that one stays itself.

Defined results: null and empty texts have no lines and stay as they are; blank lines stay and are no candidates; null
doc_ids come last; rows alike in doc_id and text keep the same lines; an empty table gives an empty result; other
columns are kept (n_chars, if there, is counted anew).  Lines are what stands between newlines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Bloom, batches, bound_batches, materialize, might_hold, mix64, release, table, unused

MIN_CHARS = 16
SEGMENTS = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
FINGERPRINT = "unhex(md5(text))"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 17)
        for i, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


class Hashed:
    """Polynomial hashes of any stretch of a text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        up, self.down = _powers(self.n)
        self.upto = np.zeros(self.n + 1, np.uint64)
        np.cumsum(codes * up[: self.n], out=self.upto[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.upto[b] - self.upto[a]) * self.down[a]


def outside_keys(h: Hashed, start: np.ndarray, n: np.ndarray, segments: int) -> np.ndarray:
    """For lines at start of lengths n: keys [line, 2 * segments] of what lies outside each stretch, for a twin as long
    or longer (the line's own length is the pair's lesser, m) and for a shorter one (m is one less)."""
    out = np.zeros((len(n), 2 * segments), np.uint64)
    for longer in (0, 1):
        m = n - longer
        for i in range(segments):
            a, b = m * i // segments, m * (i + 1) // segments
            left, right = h.of(start, start + a), h.of(start + n - (m - b), start + n)
            mark = (m * segments + i).astype(np.uint64)
            out[:, longer * segments + i] = mix64(mix64(left + mark) ^ (right + np.uint64(segments)))
    return out


def variants(text: str, shared: list[int], segments: int = SEGMENTS) -> Iterator[tuple[int, int]]:
    """(key, place) of the line itself (place -1) and without each character of the stretches whose keys it shares."""
    h, places, own = Hashed(text), set(), False
    n = h.n
    for s in shared:
        longer, i = divmod(s, segments)
        m = n - longer
        own |= not longer
        places.update(range(m * i // segments, n - (m - m * (i + 1) // segments)))
    if own:
        yield int(mix64(h.upto[-1:] ^ mix64(np.array([n], np.uint64))).view(np.int64)[0]), -1
    if places:
        p = np.fromiter(sorted(places), np.int64)
        v = h.upto[p] + (h.upto[n] - h.upto[p + 1]) * _INVERSE
        keys = mix64(v ^ mix64(np.array([n - 1], np.uint64))).view(np.int64)
        yield from zip(keys.tolist(), p.tolist(), strict=True)


def _digest(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def _chunks(text: str, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first line number, lines) of at most about most characters: a long text isn't hashed at once."""
    held, size, first, no = [], 0, 0, 0
    for line in text.split("\n"):
        held.append(line)
        size += len(line) + 1
        no += 1
        if size >= most:
            yield first, held
            held, size, first = [], 0, no
    if held:
        yield first, held


LINES = pa.schema(
    [("doc_id", pa.int64()), ("fp", pa.binary()), ("line_no", pa.int32()), ("digest", pa.binary()), ("n", pa.int32()), ("keys", pa.list_(pa.int64()))]
)


class _Lines:
    """Columns of LINES, made for many lines at a time."""

    def __init__(self, min_chars: int):
        self.min_chars = min_chars
        self.clear()

    def clear(self) -> None:
        self.lines, self.doc, self.fp, self.no, self.chars = [], [], [], [], 0

    def add(self, doc, fp: bytes, first: int, lines: list[str]) -> None:
        self.lines += lines
        self.doc += [doc] * len(lines)
        self.fp += [fp] * len(lines)
        self.no += range(first, first + len(lines))
        self.chars += sum(map(len, lines)) + len(lines)

    def batch(self) -> pa.RecordBatch:
        lines = self.lines
        at = [i for i, x in enumerate(lines) if x and not x.isspace()]
        at_ = np.array(at, np.int64)
        size = np.fromiter(map(len, lines), np.int64, len(lines))
        start = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
        keys = outside_keys(Hashed("\n".join(lines)), start[at_], size[at_], 2).view(np.int64)
        long_ = size[at_] >= self.min_chars
        offsets = np.concatenate([[0], np.cumsum(np.where(long_, keys.shape[1], 0))]).astype(np.int32)
        columns = [
            pa.array([self.doc[i] for i in at], pa.int64()), pa.array([self.fp[i] for i in at], pa.binary()), pa.array(np.array(self.no, np.int32)[at_]), pa.array([_digest(lines[i]) for i in at], pa.binary()),
            pa.array(size[at_].astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[long_].ravel())),
        ]
        self.clear()
        return pa.RecordBatch.from_arrays(columns, schema=LINES)


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, fp (of the text), line_no, digest, n and two-stretch keys (from min_chars on) of each non-blank line."""

    def run(frames):
        held = _Lines(min_chars)
        for frame in frames:
            for doc, fp, text in zip(*(frame.column(i).to_pylist() for i in range(3)), strict=True):
                for first, lines in _chunks(text or ""):
                    held.add(doc, fp, first, lines)
                    if held.chars >= 1 << 18:
                        yield held.batch()
        if held.lines:
            yield held.batch()
        release()

    held = docs.select(F.col("doc_id").cast("long"), F.expr(FINGERPRINT).alias("fp"), "text").filter("text is not null")
    return held.mapInArrow(run, "doc_id long, fp binary, line_no int, digest binary, n int, keys array<long>")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "line_no")


def _shared(keys: DataFrame) -> DataFrame:
    """The rows of keys (key, digest, ...) whose key another digest has too."""
    twice = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    return keys.join(twice, "key")


def near_twins(docs: DataFrame, texts: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """digest, keeper: pairs of lines within one edit whose keeper is the earlier one.  texts: a row a different line
    (digest, first, keys)."""
    spark = docs.sparkSession
    keys = texts.select("digest", F.explode("keys").alias("key"))
    suspects = materialize(_shared(keys).select("digest").distinct(), "suspects")
    bloom = Bloom.build(suspects.select(F.xxhash64("digest").alias("k")), "k")
    held = spark.sparkContext.broadcast(bloom.packed())  # of fixed size; it spares the shuffle of other lines
    schema = pa.schema([("digest", pa.binary()), ("line", pa.string())])

    def read(frames):
        mine = Bloom.unpack(held.value)
        for frame in frames:

            def rows(frame=frame):
                seen = set()
                for text in frame.column(0).to_pylist():
                    lines = [x for x in text.split("\n") if len(x) >= min_chars and not x.isspace()]
                    digests = [_digest(x) for x in lines]
                    if digests:
                        # as Spark's xxhash64 of a binary column, seed 42
                        h = np.fromiter((xxhash.xxh64_intdigest(d, 42) for d in digests), np.uint64, len(digests))
                        for i in np.flatnonzero(mine.has(h)):
                            if digests[i] not in seen:
                                seen.add(digests[i])
                                yield digests[i], lines[i]

            yield from batches(schema, rows(), limit=4 << 20, weigh=lambda r: 64 + 2 * len(r[1]))
        release()

    lines = docs.select("text").filter("text is not null").mapInArrow(read, "digest binary, line string")
    lines = lines.join(suspects, "digest", "left_semi").groupBy("digest").agg(F.first("line").alias("line"))
    lines = materialize(lines.join(texts.select("digest", "first"), "digest"), "suspect_lines")

    closer = pa.schema([("digest", pa.binary()), ("place", pa.int32()), ("key", pa.int64())])

    def cut(frames):
        for frame in frames:

            def rows(frame=frame):
                for d, x in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                    k = outside_keys(Hashed(x), np.zeros(1, np.int64), np.array([len(x)]), SEGMENTS)[0].view(np.int64)
                    yield from ((d, i, key) for i, key in enumerate(k.tolist()))

            yield from batches(closer, rows(), limit=4 << 20)
        release()

    near = lines.select("digest", "line").mapInArrow(cut, "digest binary, place int, key long")
    near = _shared(near).groupBy("digest").agg(F.collect_set("place").alias("places"))  # at most 2 * SEGMENTS
    near = near.join(lines, "digest").select("digest", "line", "places")
    emitted = pa.schema([("digest", pa.binary()), ("variant", pa.int64()), ("place", pa.int32())])

    def emit(frames):
        for frame in frames:

            def rows(frame=frame):
                for d, x, p in zip(*(frame.column(i).to_pylist() for i in range(3)), strict=True):
                    yield from ((d, v, at) for v, at in variants(x, p))

            yield from batches(emitted, rows(), limit=4 << 20)
        release()

    found = near.mapInArrow(emit, "digest binary, variant long, place int")
    found = materialize(found.join(lines.select("digest", "first"), "digest"), "variants")
    # one length: those that share a variant and its place, with the earliest of them
    same = found.filter("place >= 0")
    hubs = same.groupBy("variant", "place").agg(F.min(F.struct("first", "digest")).alias("h"), F.count("*").alias("c"))
    same = same.join(hubs.filter("c > 1"), ["variant", "place"]).filter(F.col("digest") != F.col("h.digest"))
    same = same.select("digest", F.col("h.digest").alias("keeper"))
    # lengths that differ by one: the line that is the variant, with those it is a variant of; the earlier one keeps
    own = found.filter("place = -1").select("variant", F.col("digest").alias("od"), F.col("first").alias("of"))
    longer = same_variant = found.filter("place >= 0").join(own, "variant").filter(F.col("digest") != F.col("od"))
    longer = longer.filter(F.col("of") < F.col("first")).select("digest", F.col("od").alias("keeper"))
    shorter = same_variant.groupBy("od").agg(F.min(F.struct("first", "digest")).alias("h"), F.first("of").alias("of"))
    shorter = shorter.filter(F.col("h.first") < F.col("of")).select(F.col("od").alias("digest"), F.col("h.digest").alias("keeper"))
    pairs = same.unionByName(longer).unionByName(shorter).distinct()
    a = lines.select("digest", F.col("line").alias("la"))
    b = lines.select(F.col("digest").alias("keeper"), F.col("line").alias("lb"))
    return pairs.join(a, "digest").join(b, "keeper").filter(F.levenshtein("la", "lb", 1) >= 0).select("digest", "keeper")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """(dropped, lines): doc_id, fp and the numbers of the lines that go; and the table of all lines."""
    lines = materialize(line_table(docs, min_chars), "lines")
    texts = lines.groupBy("digest").agg(F.min(_place()).alias("first"), F.count("*").alias("n"), F.first("keys").alias("keys"))
    texts = materialize(texts, "line_texts")
    near = materialize(near_twins(docs, texts, min_chars).select("digest").distinct().withColumn("near", F.lit(True)), "near")
    decided = texts.join(near, "digest", "left").filter("near or n > 1").select("digest", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select("doc_id", "fp", "line_no", "digest").join(decided, "digest")
    gone = gone.filter(F.col("near") | (_place() != F.col("first"))).select("doc_id", "fp", "line_no").distinct()
    per = gone.groupBy("doc_id", "fp").agg(F.collect_list("line_no").alias("gone"))  # at most a document's lines
    return materialize(per, "dropped"), lines


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with texts without the lines that go, and two more columns, lines_dropped and emptied (no line that isn't
    blank is left of a text that had one), with underscores before names that docs has itself.  Texts that lose nothing
    aren't shuffled."""
    gone, _ = dropped_lines(docs, min_chars)
    bound_batches(docs.sparkSession)
    bloom = Bloom.build(gone.select(F.xxhash64("doc_id", "fp").alias("k")), "k")
    fp, maybe, gid, gfp, lost, dropped, emptied = unused(docs.columns, "fp", "maybe", "gid", "gfp", "gone", "lines_dropped", "emptied")
    held = docs.withColumn(fp, F.expr(FINGERPRINT))
    held = held.withColumn(maybe, might_hold(bloom, docs.sparkSession, F.xxhash64(F.col("doc_id").cast("long"), fp)))
    g = gone.select(F.col("doc_id").alias(gid), F.col("fp").alias(gfp), F.col("gone").alias(lost))
    sure = held.filter(~F.col(maybe)).withColumn(lost, F.lit(None).cast("array<int>"))
    doubt = held.filter(F.col(maybe)).join(g, F.col("doc_id").cast("long").eqNullSafe(F.col(gid)) & (F.col(fp) == F.col(gfp)), "left")
    both = sure.unionByName(doubt.drop(gid, gfp))

    def rest(texts, numbers):
        out = []
        for text, no in zip(texts, numbers, strict=True):
            if text is not None and no is not None:
                no = set(no)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in no)
            out.append(text)
        return pd.Series(out, dtype=object)

    text = F.pandas_udf(rest, "string")(F.col("text"), F.col(lost))
    both = both.withColumn("text", F.when(F.col(lost).isNull(), F.col("text")).otherwise(text))
    both = both.withColumn(dropped, F.coalesce(F.size(lost), F.lit(0)).cast("long"))
    both = both.withColumn(emptied, (F.col(dropped) > 0) & ~F.col("text").rlike(r"[^\s]"))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text")).otherwise(F.col("n_chars")))
    return both.select(*docs.columns, dropped, emptied)


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "lines_dropped", F.length("text").cast("long").alias("chars_kept"), F.md5("text").alias("text_md5"), "emptied"
    )


SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(range(len(p))) AS i, unnest(p) AS x
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)),
c AS (SELECT * FROM l WHERE regexp_matches(x, '[^\\s]')),
u AS (SELECT x, min(doc_id * 1000000 + i) AS first, length(x) AS n FROM c GROUP BY x),
k AS (
  SELECT x, first, n, m, h, CASE h WHEN 0 THEN left(x, CAST(m // 2 AS INT)) ELSE right(x, CAST(m - m // 2 AS INT)) END AS half
  FROM (SELECT *, unnest([n, n - 1]) AS m FROM u WHERE n >= {MIN_CHARS}), (VALUES (0), (1)) AS s(h)),
near AS (
  SELECT DISTINCT b.x FROM k a JOIN k b ON a.m = b.m AND a.h = b.h AND a.half = b.half AND a.first < b.first
  WHERE levenshtein(a.x, b.x) <= 1),
gone AS (
  SELECT doc_id, i FROM c JOIN u USING (x)
  WHERE first <> doc_id * 1000000 + i OR x IN (SELECT x FROM near)),
kept AS (
  SELECT l.doc_id, string_agg(x, chr(10) ORDER BY l.i) AS t FROM l ANTI JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY 1),
n AS (SELECT doc_id, count(*) AS dropped FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(dropped, 0) AS BIGINT) AS lines_dropped,
       CAST(length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t, '') END) AS BIGINT) AS chars_kept,
       md5(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t, '') END) AS text_md5,
       coalesce(dropped, 0) > 0 AND NOT regexp_matches(coalesce(t, ''), '[^\\s]') AS emptied
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN n ON d.doc_id = n.doc_id"""
