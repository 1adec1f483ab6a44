"""Operator 6: near-duplicate documents by ProbMinHash.

A document is the multiset of its five-word shingles, weighted by how often they occur.  In ProbMinHash each shingle is
a Poisson process whose rate is its weight: its arrivals, drawn from its hash, hit random registers, a register keeps
the earliest arrival's shingle, and a shingle stops once its next arrival comes after every register's.  Two
signatures agree in a register with a probability equal to the probability Jaccard similarity of the documents.

Equal texts are one vertex, so no pair of copies is ever made.  Half of the registers are cut into bands of five, 25 of
them: vertices of similarity 0.8 share a bucket with probability 0.99995.  In rounds, each member of a bucket is
verified, on the shingles themselves, against a few hubs of it, and what reaches 0.8 is joined into classes; hubs have
then met their whole bucket and leave it, and so do buckets of one class.  When hubs no longer join much, what is left
meets in blocks, where signatures of members of different classes are compared register by register, all 250 of them,
and pairs that agree in 0.7 of the registers (four standard deviations under 0.8) are verified on the shingles at once.  There is no
bound on buckets, on partners or on rounds.  A hub's pairs grow with its bucket; only texts of different classes that
still share a bucket meet each other.

Defined results: a null text is like no other; texts without words are alike only if equal; texts of fewer than five
words are one shingle; null doc_ids count as greatest in choosing a class's id, which is null if all its ids are; equal
rows are in one class; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Bloom, batches, components, materialize, might_hold, mix64, release, table, unused

WORDS = 5
SIMILAR = 0.8
ROWS = 5
BANDS = 25
REGISTERS = 250
PLAUSIBLE = 0.7
#: shingles that are described at a time
SLICE = 100_000
#: hubs of a bucket in a round; bytes of a block
HUBS = 1
BLOCK = 1 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CACHE = 100_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()


def forget() -> None:
    """Ends a partition: idle workers hold no words and no buffers."""
    _HASHES.clear()
    release()


_MULTIPLIERS = [np.uint64(int.from_bytes(xxhash.xxh64_digest(f"place {i}"), "big") | 1) for i in range(64)]


def shingle_hashes(text: str, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles' hashes (ascending) and counts."""
    # words are hashed as they are found: a long text's words aren't held
    w = np.fromiter((_HASHES[x.group()] for x in _WORD.finditer(text)), np.uint64) if len(text) > 1 << 20 else np.fromiter(
        map(_HASHES.__getitem__, _WORD.findall(text)), np.uint64
    )
    n = len(w)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n < k:
        k = n
    acc = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        acc += w[i : i + n - k + 1] * _MULTIPLIERS[i]
    return np.unique(mix64(acc), return_counts=True)


def prob_min_hash(sets: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """Signatures (a row each, m shingle hashes) of weighted sets that aren't empty."""
    e = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([c for _, c in sets]).astype(np.float64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    first = np.full(len(sets) * m, np.inf)
    sig = np.zeros(len(sets) * m, np.uint64)
    for at in range(0, len(e), SLICE):  # registers keep the earliest arrival, so shingles may come in slices
        _arrivals(e[at : at + SLICE], rate[at : at + SLICE], doc[at : at + SLICE], first, sig, m)
    return sig.reshape(-1, m)


def _arrivals(e: np.ndarray, rate: np.ndarray, doc: np.ndarray, first: np.ndarray, sig: np.ndarray, m: int) -> None:
    """Lets shingles e of the documents numbered doc arrive in the registers."""
    now, turn = np.zeros(len(e)), 0
    while len(e):
        k = max(1, min(64, 8192 // len(e)))  # few shingles left: several arrivals of each at a time
        turns = np.arange(turn + 1, turn + k + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        draw = mix64(e[None] + turns)
        wait = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        times = now + np.cumsum(wait, axis=0)
        at = doc * m + (mix64(draw ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(m)).astype(np.int64)
        before = first[at]
        np.minimum.at(first, at.ravel(), times.ravel())
        won = (first[at] == times) & (times < before)
        sig[at[won]] = np.broadcast_to(e, at.shape)[won]
        now, turn = times[-1], turn + k
        go = now < first.reshape(-1, m).max(axis=1)[doc]  # later arrivals change nothing
        e, rate, doc, now = e[go], rate[go], doc[go], now[go]


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    out = np.zeros((len(sig), sig.shape[1] // rows), np.uint64)
    for b in range(out.shape[1]):
        h = np.full(len(sig), b + 1, np.uint64)
        for i in range(rows):
            h = mix64(h * np.uint64(0x100000001B3) + sig[:, b * rows + i])
        out[:, b] = h
    return out


def probability_jaccard(a: tuple, b: tuple) -> float:
    """The sum over common shingles i of 1 / sum over k of max(a_k / a_i, b_k / b_i)."""
    (ea, ca), (eb, cb) = a, b
    every = np.union1d(ea, eb)
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, ea)] = ca
    wb[np.searchsorted(every, eb)] = cb
    with np.errstate(divide="ignore"):
        ratio = np.where(wb > 0, wa / np.where(wb > 0, wb, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    ratio, wa, wb = ratio[order], wa[order], wb[order]
    # where a_k / b_k > a_i / b_i the a share is the larger one, else the b share
    above = np.concatenate([np.cumsum(wa[::-1])[::-1], [0.0]])
    below = np.concatenate([[0.0], np.cumsum(wb)])
    both = (wa > 0) & (wb > 0)
    cut = np.searchsorted(ratio, ratio[both], side="right")
    return float((1 / (above[cut] / wa[both] + below[cut] / wb[both])).sum())


FINGERPRINT = "unhex(md5(text))"


def signatures(docs: DataFrame, rows: int = ROWS, bands: int = BANDS, registers: int = REGISTERS) -> DataFrame:
    """doc_id, fp (of the text), bands and sig (a byte of each register) of every document; no bands for texts without
    words.  Texts are described SLICE shingles at a time, a longer one by itself."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])

    def described(held):
        sig = prob_min_hash([x for _, _, x in held], registers)
        keys, low = band_hashes(sig[:, : rows * bands], rows), mix64(sig).astype(np.uint8)
        for (doc, fp, _), k, x in zip(held, keys, low, strict=True):
            yield doc, fp, k.view(np.int64), x.tobytes()

    def run(frames):
        def each():
            held, size = [], 0
            for frame in frames:
                for doc, fp, text in zip(*frame.columns, strict=True):
                    x = shingle_hashes(text.as_py() or "")
                    if not len(x[0]):
                        yield doc.as_py(), fp.as_py(), [], b""
                        continue
                    held.append((doc.as_py(), fp.as_py(), x))
                    size += len(x[0])
                    if size >= SLICE or len(held) >= 1024:
                        yield from described(held)
                        held, size = [], 0
            if held:
                yield from described(held)

        yield from batches(schema, each(), limit=4 << 20, weigh=lambda r: 300 + 8 * len(r[2]))
        forget()

    held = docs.select(F.col("doc_id").cast("long"), F.expr(FINGERPRINT).alias("fp"), "text")
    return held.mapInArrow(run, "doc_id long, fp binary, bands array<long>, sig binary")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """v, shingles, counts of the wanted (column v) texts.  A filter of fixed size keeps other texts out of the shuffle;
    the join that follows is exact."""
    key = F.xxhash64(F.col("v"))
    bloom = Bloom.build(wanted.select(key.alias("k")), "k")
    texts = docs.select(F.expr(FINGERPRINT).alias("v"), "text").filter("text is not null")
    texts = texts.filter(might_hold(bloom, docs.sparkSession, F.xxhash64("v")))
    schema = pa.schema([("v", pa.binary()), ("shingles", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))])

    def run(frames):
        for frame in frames:
            seen = set()  # copies within a batch are described once

            def rows(frame=frame, seen=seen):
                for v, text in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                    if v not in seen:
                        seen.add(v)
                        e, c = shingle_hashes(text)
                        yield v, e.view(np.int64), c.astype(np.int32)

            yield from batches(schema, rows(), limit=4 << 20, weigh=lambda r: 32 + 12 * len(r[1]))
        forget()

    sets = texts.mapInArrow(run, "v binary, shingles array<long>, counts array<int>")
    # copies meet here, most of them already dropped; only one set of each is kept by the partial aggregate
    sets = sets.join(wanted.select("v").distinct(), "v", "left_semi")
    return materialize(sets.groupBy("v").agg(F.first("shingles").alias("shingles"), F.first("counts").alias("counts")), "sets")


def similar(pairs: DataFrame, sets: DataFrame, at_least: float = SIMILAR) -> DataFrame:
    """pairs (h, v) with a column alike: whether their similarity reaches at_least."""
    mine = pairs.join(sets.select("v", F.col("shingles").alias("sv"), F.col("counts").alias("cv")), "v")
    mine = mine.join(sets.select(F.col("v").alias("h"), F.col("shingles").alias("sh"), F.col("counts").alias("ch")), "h")

    def run(frames):
        for frame in frames:
            cols = [frame.column(i) for i in range(6)]
            alike = []
            for i in range(frame.num_rows):
                sv, cv, sh, ch = (np.asarray(cols[j][i].values) for j in range(2, 6))
                a, b = (sv.view(np.uint64), cv), (sh.view(np.uint64), ch)
                small, large = sorted((len(sv), len(sh)))
                alike.append(bool(probability_jaccard(a, b) >= at_least - 1e-12) if small else large == 0)
            yield pa.RecordBatch.from_arrays([cols[0], cols[1], pa.array(alike)], names=["h", "v", "alike"])
        release()

    return mine.select("h", "v", "sv", "cv", "sh", "ch").mapInArrow(run, "h binary, v binary, alike boolean")


def classes(docs: DataFrame, at_least: float = SIMILAR, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, fp, class_id (least doc_id of its class) of every document."""
    signed = materialize(signatures(docs, rows, bands), "signatures")
    texts = signed.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    texts = materialize(texts, "texts")
    keys = texts.select(F.col("fp").alias("v"), F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = keys.join(shared, "key").withColumn("degree", F.sum("n").over(Window.partitionBy("v")))
    members = materialize(members.select("key", "v", "degree", F.col("v").alias("root")), "members")
    if members.isEmpty():
        own = texts.select("fp", F.col("rep").alias("class_id"))
    else:
        label = _link(docs, members, texts.select(F.col("fp").alias("v"), "sig", F.col("bands").alias("keys")), at_least)
        rooted = texts.select("fp", "rep")
        if label is not None:
            rooted = rooted.join(label, texts["fp"] == label["v"], "left").withColumn("root", F.coalesce("root", "fp"))
        else:
            rooted = rooted.withColumn("root", F.col("fp"))
        rooted = materialize(rooted.select("fp", "rep", "root"), "rooted")
        least = rooted.groupBy("root").agg(F.min("rep").alias("class_id"))
        own = rooted.join(least, "root").select("fp", "class_id")
    own = own.withColumnRenamed("fp", "_fp")
    out = signed.join(own, F.col("fp") == F.col("_fp"), "left")
    return out.select("doc_id", "fp", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def _hub_round(members: DataFrame, turn: int, hubs: int) -> DataFrame:
    """The members of buckets of several roots, each with its bucket's hubs (v, root).  One order of all vertices gives
    the hubs, so that buckets of the same texts have the same: in the first round by degree (the sum of the sizes of a
    vertex's buckets, greatest where most of what is near it is too), then at random."""
    order = [F.xxhash64(F.lit(turn), F.lit(i), F.col("v")) for i in range(hubs)]
    if not turn:
        order = [F.struct(-F.col("degree"), F.col("v"))]
    hub = [F.min(F.struct(o.alias("o"), F.col("v").alias("v"), F.col("root").alias("root"))) for o in order]
    per = members.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), *[h.alias(f"h{i}") for i, h in enumerate(hub)])
    per = per.filter("r0 <> r1").select("key", F.array(*[F.struct(f"h{i}.v", f"h{i}.root") for i in range(len(hub))]).alias("hubs"))
    return materialize(members.join(per, "key"), "met")


def _merge(label: DataFrame | None, joined: DataFrame | None) -> DataFrame | None:
    """label (v, root) after roots were joined to others (joined: v, root of those that are roots no more)."""
    if label is None or joined is None:
        return label if joined is None else joined
    j = joined.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
    moved = label.join(j, F.col("root") == F.col("_v"), "left").select("v", F.coalesce("_root", "root").alias("root"))
    return materialize(moved.unionByName(joined), "label")


def _link(docs: DataFrame, members: DataFrame, signed: DataFrame, at_least: float, plausible: float = PLAUSIBLE) -> DataFrame | None:
    """v, root of the vertices that were joined to others.  members: key, v, degree, root of the buckets.

    In a round every member of a bucket is verified against a few hubs of it, roots are contracted along what is alike,
    and hubs, which have met all of their bucket, leave it.  Buckets whose members have one root are done.  When hubs
    no longer join much, the rest meets in blocks."""
    sets = shingle_sets(docs, members.select("v").distinct())
    label, turn = None, 0
    while True:
        met = _hub_round(members, turn, HUBS)
        each = met.select("v", "root", F.explode("hubs").alias("hub")).filter("root <> hub.root")
        pairs = each.select(F.least("v", "hub.v").alias("h"), F.greatest("v", "hub.v").alias("v")).distinct()
        if turn:
            sets = materialize(sets.join(met.select("v").distinct(), "v", "left_semi"), "sets")
        said = materialize(similar(pairs, sets, at_least), "compared")
        count = said.agg(F.count("*"), F.count(F.when(F.col("alike"), 1))).first()
        if not count[0]:
            return label
        left = met.filter(~F.exists("hubs", lambda h: h["v"] == F.col("v"))).select("key", "v", "degree", "root")
        if count[1]:
            joined = _contract(said.filter("alike").select("h", "v"), met)
            label = _merge(label, joined)
            j = joined.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
            left = left.join(j, F.col("root") == F.col("_v"), "left").select("key", "v", "degree", F.coalesce("_root", "root").alias("root"))
        members = materialize(left, "members")
        turn += 1
        if count[1] * 10 < count[0]:
            break
    mixed = members.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("key")
    held = members.join(mixed, "key").select("key", "v", "root")
    held = materialize(held.join(signed, "v").join(sets, "v"), "open")
    if held.isEmpty():
        return label
    new = materialize(meet_in_blocks(held, plausible * at_least / SIMILAR, at_least), "linked")
    return label if new.isEmpty() else _merge(label, _contract(new, held))


def _contract(alike: DataFrame, rooted: DataFrame) -> DataFrame:
    """v, root of the roots that are joined to others by alike (h, v); rooted: v, root."""
    of = rooted.select("v", "root").distinct()
    ends = alike.join(of.select("v", F.col("root").alias("b")), "v")
    ends = ends.join(of.select(F.col("v").alias("h"), F.col("root").alias("a")), "h")
    return components(ends.select("a", "b"))


def _blocks(held: DataFrame, size: int = BLOCK) -> DataFrame:
    """key, mark, blk, held: the members (v, root, sig, keys, shingles, counts) of each bucket in blocks of about size
    bytes; a root with many members has blocks of its own, marked with it."""
    held = held.withColumn("bytes", 512 + 12 * F.size("shingles"))
    per = held.groupBy("key", "root").agg(F.sum("bytes").alias("n")).withColumn("own", F.col("n") * 4 >= size)
    pool = per.filter("not own").groupBy("key").agg(F.sum("n").alias("pool"))
    per = per.join(pool, "key", "left").select("key", "root", "own", F.ceil(F.when(F.col("own"), F.col("n")).otherwise(F.col("pool")) / size).alias("k"))
    dealt = held.join(per, ["key", "root"]).withColumn("blk", F.pmod(F.xxhash64("v"), F.col("k")))
    mark = F.when(F.col("own"), F.col("root")).otherwise(F.lit(b""))
    return dealt.groupBy("key", mark.alias("mark"), "blk").agg(F.collect_list(F.struct("v", "root", "sig", "keys", "shingles", "counts")).alias("held"))


class _Members:
    """A block's members in arrays."""

    def __init__(self, cell):
        v, root, sig, keys, shingles, counts = (cell.values.field(i) for i in range(6))
        self.v, self.root, n = v.to_pylist(), root.to_pylist(), len(v)
        self.sig = np.frombuffer(b"".join(sig.to_pylist()), np.uint8).reshape(n, -1)
        self.keys = np.asarray(keys.flatten()).reshape(n, -1)
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in shingles])])
        self.shingles, self.counts = np.asarray(shingles.flatten()).view(np.uint64), np.asarray(counts.flatten())
        self.plain = np.array([self.counts[a:b].max(initial=1) == 1 for a, b in zip(self.at, self.at[1:], strict=False)])

    def set(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        where = slice(self.at[i], self.at[i + 1])
        return self.shingles[where], self.counts[where]


def _alike(a: _Members, i: int, b: _Members, partners: np.ndarray, at_least: float) -> np.ndarray:
    """Which of b's partners member i of a is similar to."""
    mine, _ = a.set(i)
    plain = partners[b.plain[partners]] if a.plain[i] else partners[:0]
    out = {}
    if len(plain):  # sets: all partners at once
        theirs = np.concatenate([b.set(j)[0] for j in plain])
        size = np.array([b.at[j + 1] - b.at[j] for j in plain])
        common = np.isin(theirs, mine, assume_unique=False)
        n = np.add.reduceat(common, np.concatenate([[0], np.cumsum(size)[:-1]]))
        out.update(zip(plain.tolist(), n >= (at_least - 1e-12) * (size + len(mine) - n), strict=True))
    return np.array([out[j] if j in out else probability_jaccard(a.set(i), b.set(j)) >= at_least - 1e-12 for j in partners.tolist()], bool)


def _links(a: _Members, b: _Members, key: int, plausible: float, at_least: float) -> Iterator[tuple[int, int]]:
    """Places in a and b of similar members that join different roots; what is joined here isn't compared again."""
    numbers = {x: i for i, x in enumerate(dict.fromkeys(a.root + b.root))}
    ra, rb = (np.fromiter((numbers[x] for x in y.root), np.int64, len(y.root)) for y in (a, b))
    for at in range(0, len(ra), 16):
        agree = (a.sig[at : at + 16, None, :] == b.sig[None]).mean(axis=2, dtype=np.float32) >= plausible
        for x in np.flatnonzero(agree.any(axis=1)):
            i = at + int(x)
            partners = np.flatnonzero(agree[x] & (rb != ra[i]))
            if not len(partners):
                continue
            first = np.argmax(a.keys[i] == b.keys[partners], axis=1)  # a pair is compared in the first bucket it shares
            partners = partners[a.keys[i][first] == key]
            if not len(partners):
                continue
            for j in partners[_alike(a, i, b, partners, at_least)]:
                if ra[i] != rb[j]:
                    yield i, int(j)
                    old, new = rb[j], ra[i]
                    ra[ra == old] = new
                    rb[rb == old] = new


def meet_in_blocks(held: DataFrame, plausible: float, at_least: float, size: int = BLOCK) -> DataFrame:
    """h, v: similar members (key, v, root, sig, keys, shingles, counts) of a bucket that join different roots.  Members
    whose signatures agree in plausible of the registers are verified where they meet; of a pair of blocks no more
    links come out than it has roots."""
    blocks = materialize(_blocks(held, size), "blocks")
    other = blocks.select("key", F.col("mark").alias("mark2"), F.col("blk").alias("blk2"), F.col("held").alias("held2"))
    met = blocks.join(other, "key").filter("(mark < mark2 or (mark = mark2 and blk <= blk2)) and not (mark = mark2 and length(mark) > 0)")
    schema = pa.schema([("h", pa.binary()), ("v", pa.binary())])

    def run(frames):
        def pairs():
            for frame in frames:
                for r in range(frame.num_rows):
                    a, b = (_Members(frame.column(i)[r]) for i in (1, 2))
                    for i, j in _links(a, b, frame.column(0)[r].as_py(), plausible, at_least):
                        yield min(a.v[i], b.v[j]), max(a.v[i], b.v[j])

        yield from batches(schema, pairs())
        forget()

    # dealt anew, as a bucket's pairs of blocks would all follow its key
    n = blocks.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * (F.col("n") + 1) / 2)).first()[0] or 0
    return met.select("key", "held", "held2").repartition(max(8, int(n) // 8)).mapInArrow(run, "h binary, v binary").distinct()


def near_dedup(docs: DataFrame, at_least: float = SIMILAR) -> DataFrame:
    """One document of each class: that with the class's id, else (ids are null) any one.  Documents without text stay.
    The columns are those of docs, whatever their names."""
    decided = materialize(classes(docs, at_least), "classes")
    gone = decided.filter("fp is not null and not (doc_id <=> class_id)").select("doc_id", "fp").distinct()
    gone = materialize(gone, "gone")
    twice = decided.filter("fp is not null and doc_id <=> class_id").groupBy("class_id", "fp").count().filter("count > 1")
    twice = materialize(twice.select(F.col("class_id").alias("doc_id"), "fp"), "twice")
    out = without(docs, gone)
    if not twice.isEmpty():  # equal rows: one stays
        fp, gid, gfp = unused(docs.columns, "fp", "gid", "gfp")
        t = twice.select(F.col("doc_id").alias(gid), F.col("fp").alias(gfp))
        once = docs.withColumn(fp, F.expr(FINGERPRINT)).join(t, (F.col(fp) == F.col(gfp)) & F.col("doc_id").cast("long").eqNullSafe(F.col(gid)), "left_semi")
        out = without(out, twice).unionByName(once.dropDuplicates(["doc_id", fp]).drop(fp))
    return out


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but for those in gone (doc_id, fp).  Texts that a filter of fixed size clears aren't shuffled."""
    bloom = Bloom.build(gone.select(F.xxhash64("doc_id", "fp").alias("k")), "k")
    fp, maybe, gid, gfp = unused(docs.columns, "fp", "maybe", "gid", "gfp")
    held = docs.withColumn(fp, F.expr(FINGERPRINT))
    held = held.withColumn(maybe, might_hold(bloom, docs.sparkSession, F.xxhash64(F.col("doc_id").cast("long"), fp)))
    g = gone.select(F.col("doc_id").alias(gid), F.col("fp").alias(gfp))
    doubt = held.filter(F.col(maybe)).join(g, F.col("doc_id").cast("long").eqNullSafe(F.col(gid)) & (F.col(fp) == F.col(gfp)), "left_anti")
    return held.filter(~F.col(maybe)).unionByName(doubt).select(*docs.columns)


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", (F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))
