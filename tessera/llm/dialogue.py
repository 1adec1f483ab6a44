"""Operator 12: repair of the structure of conversations, by a rank-compressed dynamic programme.

A conversation is repaired by keeping, re-roling or deleting its rows and inserting empty ones, at least cost, so that
its roles read `(s?(ua)+)?`.  Each row is one layer of the programme, and what is done at it is one macro edit: a run of
inserts and then the row's own edit.  Written with the edits' initials (Delete, Insert, Keep, Rerole), macro edits are
the code words D, ID, IID, IIK, IIR, IK, IR, K and R, of which none begins another.  So of two audits over the same rows
the first differing word decides, and an audit may be replaced by its rank among those of its layer: the next layer's
audits compare by the rank of the layer before, then by the number of the code word.  Layers hold costs, ranks and
parent pointers; the audit is read off the pointers at the end.  Runs of over two inserts return to a state and never
pay.  The roles of the result follow from its length alone, so the audit says all there is to know of it.

A row counts only by its role's initial and its fault, 4 bits, so a conversation is a string of symbols.  Long ones are
cut into blocks of BLOCK rows.  A block is run from each of the four states that it may be entered in, with one ranking
over all of them; what it hands on are 16 costs and ranks.  These are composed along the conversation in the same way,
and each block, told by which state it is entered and left, gives its part of the audit.  So no task holds more of a
conversation than BLOCK rows, or a few bytes for each of its blocks, but for the audit itself, which is one value.

Rows are put in order by a range sort of digests, roles and turns, without texts, so one conversation may lie in many
partitions.  Duplicates are found by the least place of each role and text, joined back.  Texts are shuffled once, to
be hashed in order; a sha256 can't be divided, so one task passes over each conversation's texts, row by row.

Defined results: a null role or text is one space (so a null text is blank), and so is a null conv_id or turn in the
key of the damage; a null conv_id is a conversation; null turns come first; rows of one turn are ordered by role, then by
a digest of the text, their repeats beside them; an empty role counts as a space; rows alike in all columns are repeats
and so duplicates; a conversation without rows after damage has zeros; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, bound_batches, materialize, scratch_scope, table

BLOCK = 4096
#: Costs, and the most inserts of one run.
REROLE, DELETE, INSERT, TRUNCATED, RUN = 2, 3, 2, 1, 2
#: Macro edits in the order of their code words.
CODES = ("D", "ID", "IID", "IIK", "IIR", "IK", "IR", "K", "R")
#: States: no row yet, after the system's, after a user's, after an assistant's; the first and the last may end.
STATES = range(4)
INSERTED = {0: 2, 1: 2, 2: 3, 3: 2}  # an inserted or re-roled row takes the role that may follow
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
ROLES = {2: "user", 3: "assistant"}
INITIALS = "suao"  # o: any other
FAULTS = ("", "blank", "duplicate", "truncated")
FOLLOWS = ("su", "ua", "au")
#: White space here: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


def _steps(symbol: int) -> list[tuple[int, int, int, int]]:
    """(state before, after, cost, code) of the best macro edit from each state to each other at a row of the symbol."""
    initial, fault = INITIALS[symbol & 3], FAULTS[symbol >> 2]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for before in STATES:
        at, cost = before, 0
        for run in range(RUN + 1):
            after = {"D": (at, DELETE)}
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                after["R"] = INSERTED[at], REROLE + extra
                if at in KEPT[initial]:
                    after["K"] = KEPT[initial][at], extra
            for edit, (to, more) in after.items():
                way = cost + more, CODES.index("I" * run + edit)
                best[before, to] = min(way, best.get((before, to), way))
            at, cost = INSERTED[at], cost + INSERT
    return [(before, to, *way) for (before, to), way in best.items()]


STEPS = [_steps(x) for x in range(16)]
#: (cost, inserts) that end a conversation in a state.
ENDINGS = {0: (0, 0), 1: (2 * INSERT, 2), 2: (INSERT, 1), 3: (0, 0)}


def layers(symbols: bytes, entries: tuple[int, ...]) -> tuple[dict, list[dict]]:
    """The programme over a string of symbols from each of the entry states: {(entry, state): (cost, rank)} after the last
    row, and for each row the parents {(entry, state): (state before, code)}."""
    now, parents = {(e, e): (0, 0) for e in entries}, []
    for x in symbols:
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for before, to, cost, code in STEPS[x]:
            for e in entries:
                held = now.get((e, before))
                if held is not None:
                    way = held[0] + cost, held[1], code, before
                    if (e, to) not in best or way < best[e, to]:
                        best[e, to] = way
        # audits of a layer compare by the rank of the one they continue and the code word
        order = {k: i for i, k in enumerate(sorted({(w[1], w[2]) for w in best.values()}))}
        now = {key: (w[0], order[w[1], w[2]]) for key, w in best.items()}
        parents.append({key: (w[3], w[2]) for key, w in best.items()})
    return now, parents


def walk(parents: list[dict], entry: int, state: int) -> str:
    """The audit that the parent pointers give from the last row back."""
    words = []
    for layer in reversed(parents):
        state, code = layer[entry, state]
        words.append(CODES[code])
    return "".join(reversed(words))


def ending(held: dict[int, tuple[int, int]]) -> tuple[int, int, int]:
    """(cost, state, inserts) of the best end, of {state: (cost, rank)}."""
    cost, _, inserts, state = min((c + ENDINGS[s][0], rank, ENDINGS[s][1], s) for s, (c, rank) in held.items())
    return cost, state, inserts


def repair(symbols: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation that is one block; those of short ones, which are often alike, are kept."""
    return _short(symbols) if len(symbols) <= 32 else _repair(symbols)


def _repair(symbols: bytes) -> tuple[int, str]:
    now, parents = layers(symbols, (0,))
    cost, state, inserts = ending({s: w for (_, s), w in now.items()})
    return cost, walk(parents, 0, state) + "I" * inserts


_short = lru_cache(50_000)(_repair)


def compose(blocks: list[dict]) -> tuple[int, list[tuple[int, int]], int]:
    """Of blocks' {(entry, state): (cost, rank)} in order: the cost, each block's entry and exit state, the inserts at
    the end.  A block is a layer here, whose code words are its own audits, by rank."""
    now, parents = {0: (0, 0)}, []
    for block in blocks:
        best: dict[int, tuple[int, int, int, int]] = {}
        for (entry, state), (cost, rank) in block.items():
            if entry in now:
                way = now[entry][0] + cost, now[entry][1], rank, entry
                best[state] = min(way, best.get(state, way))
        order = {k: i for i, k in enumerate(sorted({(w[1], w[2]) for w in best.values()}))}
        now = {s: (w[0], order[w[1], w[2]]) for s, w in best.items()}
        parents.append({s: w[3] for s, w in best.items()})
    cost, state, inserts = ending(now)
    ways = []
    for layer in reversed(parents):
        ways.append((layer[state], state))
        state = layer[state]
    return cost, ways[::-1], inserts


def tally(symbols: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose initials may not follow each other."""
    initials = bytes(x & 3 for x in symbols)
    legal = sum(initials[i : i + 2] in _LEGAL for i in range(len(initials) - 1))
    faults = [sum(1 for x in symbols if x >> 2 == f) for f in (1, 2, 3)]
    return (*faults, max(len(symbols) - 1, 0) - legal)


_LEGAL = {bytes(map(INITIALS.index, p)) for p in FOLLOWS}


# -- rows -----------------------------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the rows after damage; each row's damage follows from its conversation and turn."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    rows = rows.withColumn("_kind", kind).filter("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.col("text")))


def symbols_of(damaged: DataFrame) -> DataFrame:
    """conv, place (a number by which a conversation's rows are in order), n (rows of the partition before it) and symbol
    of every damaged row."""
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    truncated = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    light = damaged.select(
        "conv_id", "turn", "role", _digest().alias("digest"), code.alias("initial"), F.when(blank, 1).when(truncated, 3).otherwise(0).alias("fault")
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    span = int(damaged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = light.repartitionByRange(span, *order).sortWithinPartitions(*order)
    # partition and row number: numbers grow with the order, and rows of a partition follow one another
    placed = materialize(placed.withColumn("place", F.monotonically_increasing_id()), "placed")
    firsts = placed.filter("fault <> 1").groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"))
    firsts = firsts.agg(F.min("place").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    told = placed.join(firsts, same, "left")
    fault = F.when((F.col("fault") != 1) & (F.col("place") > F.col("_first")), 2).otherwise(F.col("fault"))
    return told.select("conv_id", "turn", "place", (F.col("initial") + fault * 4).alias("symbol"))


def block_strings(rows: DataFrame) -> DataFrame:
    """conv_id, block (in order) and symbols, a byte a row, of every block of a conversation: at most BLOCK rows that
    follow one another."""
    each = F.array_sort(F.collect_list(F.struct("place", "symbol")))
    text = F.concat_ws("", F.transform(each, lambda x: F.lpad(F.hex(x["symbol"]), 2, "0")))
    return rows.groupBy("conv_id", F.expr(f"place div {BLOCK}").alias("block")).agg(F.unhex(text).alias("symbols"))


# -- repair ---------------------------------------------------------------------------------------------------------------

_WAY = struct.Struct("<bbqi")



def _struct(text: str) -> T.StructType:
    """A struct of fields given as 'name type, ...'; needs no session."""
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "binary": T.BinaryType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in map(str.split, text.split(","))])


WAYS = T.ArrayType(_struct("block long, entry int, state int"))


def _pack(now: dict) -> bytes:
    return b"".join(_WAY.pack(e, s, cost, rank) for (e, s), (cost, rank) in now.items())


def _unpack(ways: bytes) -> dict:
    return {(e, s): (cost, rank) for e, s, cost, rank in _WAY.iter_unpack(ways)}


@F.pandas_udf(_struct("blank long, duplicate long, truncated long, illegal long, first int, last int, ways binary"))
def summary(symbols: pd.Series) -> pd.DataFrame:
    """What a block hands on: its tallies, its first and last initials, and the cost and rank from each state to each."""
    rows = [(*tally(x), x[0] & 3, x[-1] & 3, _pack(layers(x, tuple(STATES))[0])) for x in symbols]
    return pd.DataFrame(rows, columns=["blank", "duplicate", "truncated", "illegal", "first", "last", "ways"])


@F.pandas_udf(_struct("blank long, duplicate long, truncated long, illegal long, cost long, audit string"))
def whole(symbols: pd.Series) -> pd.DataFrame:
    """A conversation of one block."""
    return pd.DataFrame([(*tally(x), *repair(x)) for x in symbols], columns=["blank", "duplicate", "truncated", "illegal", "cost", "audit"])


@F.pandas_udf(_struct("cost long, inserts int").add("ways", WAYS))
def composed(blocks: pd.Series, ways: pd.Series) -> pd.DataFrame:
    """Of a conversation's blocks in order: its cost, the inserts at its end and each block's entry and exit state."""
    rows = []
    for numbers, each in zip(blocks, ways, strict=True):
        cost, path, inserts = compose([_unpack(w) for w in each])
        rows.append((cost, inserts, [{"block": int(b), "entry": e, "state": s} for b, (e, s) in zip(numbers, path, strict=True)]))
    return pd.DataFrame(rows, columns=["cost", "inserts", "ways"])


@F.pandas_udf(T.StringType())
def part_audit(symbols: pd.Series, entry: pd.Series, state: pd.Series) -> pd.Series:
    """A block's part of the audit, given the states that it is entered and left in."""
    return pd.Series([walk(layers(x, (e,))[1], e, s) for x, e, s in zip(symbols, entry, state, strict=True)], dtype=object)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost and audit of every conversation with rows (symbols_of)."""
    blocks = materialize(block_strings(rows), "blocks")
    many = blocks.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("_n"))
    counted = blocks.join(many, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    one = counted.filter("_n = 1").withColumn("_w", whole("symbols")).select("conv_id", "_w.*")
    long_ = materialize(counted.filter("_n > 1").withColumn("_s", summary("symbols")).select("conv_id", "block", "symbols", "_s.*"), "summaries")
    if long_.isEmpty():
        return one
    inside = F.array_sort(F.collect_list(F.struct("block", "first", "last", "ways")))
    per = long_.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], inside.alias("each"))
    # neighbours across blocks
    legal = F.array(*[F.lit(INITIALS.index(p[0]) * 4 + INITIALS.index(p[1])) for p in FOLLOWS])
    pairs = F.zip_with("each", F.slice("each", 2, F.size("each")), lambda x, y: F.when(y.isNotNull() & ~F.array_contains(legal, x["last"] * 4 + y["first"]), 1).otherwise(0))
    across = F.aggregate(pairs, F.lit(0), lambda x, y: x + y)
    per = per.withColumn("illegal", F.col("illegal") + across)
    per = per.withColumn("_c", composed(F.col("each.block"), F.col("each.ways")))
    per = materialize(per.select("conv_id", "blank", "duplicate", "truncated", "illegal", "_c.*"), "composed")
    told = per.select(F.col("conv_id").alias("_conv"), F.inline("ways").alias("_block", "entry", "state"))
    told = long_.join(told, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    parts = told.select("conv_id", "block", part_audit("symbols", "entry", "state").alias("part"))
    strings = parts.groupBy(F.col("conv_id").alias("_conv")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("block", "part")))["part"], "").alias("_audit"))
    audit = F.concat("_audit", F.expr("repeat('I', inserts)"))
    long_ = per.join(strings, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*[c for c in per.columns if c not in ("inserts", "ways")], audit.alias("audit"))
    return one.unionByName(long_)


def edited_rows(audit: str) -> Iterator[tuple[str, str | None]]:
    """(edit, role) of each edit of an audit; the role is None for kept and deleted rows."""
    n = len(audit) - audit.count("D")
    state = 0 if n % 2 == 0 else None  # of an odd number the first is the system's, kept
    for edit in audit:
        if edit == "D":
            yield edit, None
        elif state is None:
            state = 1
            yield edit, None
        else:
            state = INSERTED[state]
            yield edit, None if edit == "K" else ROLES[state]


HASHES = pa.schema([("conv", pa.binary()), ("sha", pa.string())])


def _hash_rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation: its audit first, then its damaged rows in order; a row a conversation comes out."""

    def rows():
        conv, edits, sha, none = None, iter(()), None, True

        def put(role: str, text: str) -> None:
            nonlocal none
            sha.update((("" if none else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
            none = False

        def inserted() -> tuple[str, str | None] | None:
            """Passes over inserts to the next row's edit."""
            for edit, role in edits:
                if edit != "I":
                    return edit, role
                put(role, "")
            return None

        def done():
            inserted()
            return conv, sha.hexdigest()

        for frame in frames:
            for key, tag, role, text in zip(*[frame.column(i).to_pylist() for i in range(4)], strict=True):
                if tag == 0:
                    if sha is not None:
                        yield done()
                    conv, edits, sha, none = key, edited_rows(text), hashlib.sha256(), True
                    continue
                edit, new = inserted()
                if edit != "D":
                    put(role if new is None else new, text)
        if sha is not None:
            yield done()

    yield from batches(HASHES, rows())


def repaired_hashes(damaged: DataFrame, audited: DataFrame) -> DataFrame:
    """_key (of the conversation) and repaired_sha256 of every conversation with rows."""
    texts = damaged.select(conv_key(), F.lit(1).alias("tag"), "role", "text", "turn", _digest().alias("digest"))
    heads = audited.select(conv_key(), F.lit(0).alias("tag"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(None).cast(damaged.schema["turn"].dataType).alias("turn"), F.lit(None).cast("binary").alias("digest"))
    order = ["_key", "tag", F.col("turn").asc_nulls_first(), "role", "digest"]
    both = texts.unionByName(heads).repartition("_key").sortWithinPartitions(*order)
    return both.select("_key", "tag", "role", "text").mapInArrow(_hash_rows, "_key binary, repaired_sha256 string")


def conv_key() -> Column:
    """A conversation's id as bytes, none for null: one kind of key whatever the column's type."""
    return F.when(F.col("conv_id").isNull(), F.unhex(F.lit(""))).otherwise(F.concat(F.unhex(F.lit("01")), F.col("conv_id").cast("string").cast("binary"))).alias("_key")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """A row for every conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256, after damage."""
    bound_batches(conversations.sparkSession)
    damaged = damage(conversations)
    rows = materialize(symbols_of(damaged), "symbols")
    audited = materialize(audits(rows), "audits")
    turns = rows.filter("turn IS NOT NULL").select("conv_id", F.col("turn").cast("decimal(38,0)").alias("turn")).groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).try_cast("long").alias("gaps"))
    hashes = repaired_hashes(damaged, audited)
    every = conversations.select("conv_id").distinct().withColumn("_key", conv_key())
    out = every.join(hashes, "_key", "left")
    for more, name in ((audited, "_a"), (gaps, "_b")):
        out = out.join(more.withColumnRenamed("conv_id", name), F.col("conv_id").eqNullSafe(F.col(name)), "left").drop(name)
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    with scratch_scope(spark) as scope:
        return scope.keep(materialize(repair_conversations(table(spark, sf_dir, "conversations")), "repaired"))


SQL = r"""
WITH RECURSIVE
t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT)) AS bytes
  FROM conversations),
k AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295, bytes), lambda v, b: xor(v >> 8, steps[(xor(v, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM c, t),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM k WHERE kind <> 0),
o AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i
  FROM d),
f AS (
  SELECT g, i, conv_id, turn, role, text, CASE WHEN role = '' THEN ' ' ELSE left(role, 1) END AS k,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM o),
a AS (
  SELECT g, any_value(conv_id) AS conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE bad) AS illegal
  FROM (SELECT *, i > 1 AND lag(k) OVER (PARTITION BY g ORDER BY i) || k NOT IN ('su', 'ua', 'au') AS bad FROM f) GROUP BY g),
nx(a, b) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
runs(st, z, w, c) AS (
  SELECT a, a, '', 0 FROM nx UNION ALL SELECT a, b, 'I', 2 FROM nx
  UNION ALL SELECT n.a, o.b, 'II', 4 FROM nx n JOIN nx o ON n.b = o.a),
edits(e, k, a, b, c) AS (
  SELECT 'D', CAST(NULL AS VARCHAR), a, a, 3 FROM nx UNION ALL SELECT 'R', CAST(NULL AS VARCHAR), a, b, 2 FROM nx
  UNION ALL SELECT * FROM (VALUES ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0))),
dp(g, i, st, cost, audit) AS (
  SELECT g, CAST(0 AS BIGINT), 0, 0, '' FROM a
  UNION ALL
  SELECT g, i, st, min(cost), arg_min(audit, {'c': cost, 'a': audit}) FROM (
    SELECT dp.g, f.i, e.b AS st, dp.audit || r.w || e.e AS audit,
           dp.cost + r.c + e.c + CASE WHEN e.e <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS cost
    FROM dp JOIN f ON dp.g = f.g AND f.i = dp.i + 1 JOIN runs r ON r.st = dp.st
    JOIN edits e ON e.a = r.z AND (e.k IS NULL OR e.k = f.k)
    WHERE e.e = 'D' OR f.fault NOT IN ('blank', 'duplicate')) GROUP BY g, i, st),
best AS (
  SELECT dp.g, min(cost + c) AS cost, arg_min(audit || w, {'c': cost + c, 'a': audit || w}) AS audit
  FROM dp JOIN a ON dp.g = a.g AND dp.i = a.n JOIN runs r ON r.st = dp.st AND r.z IN (0, 3) GROUP BY dp.g),
w AS (
  SELECT g, j, audit[j] AS e, len(replace(left(audit, j), 'I', '')) AS i, len(replace(left(audit, j), 'D', '')) AS p,
         len(replace(audit, 'D', '')) % 2 AS odd
  FROM best, range(1, len(audit) + 1) AS r(j)),
h AS (
  SELECT w.g, string_agg(CASE WHEN e = 'K' THEN f.role WHEN (p + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                         CASE WHEN e = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY j) AS body
  FROM w LEFT JOIN f ON w.g = f.g AND w.i = f.i WHERE e <> 'D' GROUP BY w.g)
SELECT x.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN a ON x.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best ON a.g = best.g LEFT JOIN h ON a.g = h.g"""
