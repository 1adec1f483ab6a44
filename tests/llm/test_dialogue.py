import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from tests.llm.helpers import SF, none_of
from tessera.llm import dialogue as D

SPACES = re.compile(r"[\x20\x09-\x0D]*\Z")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(shown).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if text[: SPACES.search(text).start()][-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def search(rows, found):
    """The cheapest edits by plain search over whole audit strings: cost, audit, repaired rows."""

    def follows(last, initial):
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[last]

    @lru_cache(None)
    def best(i, last, run=0):
        """(cost, audit, repaired) from row i on, after a role of that initial and run inserts since the last row."""
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def then(cost, edit, new, *at):
            if sub := best(*at):
                ways.append((sub[0] + cost, edit + sub[1], new + sub[2]))

        news = [r for r in ("user", "assistant") if follows(last, r[0])]
        for role in news if run < 3 else ():
            then(2, "I", ((role, ""),), i, role[0], run + 1)
        if i < len(rows):
            _, role, text = rows[i]
            then(3, "D", (), i + 1, last)
            if found[i] not in ("blank", "duplicate"):
                extra = found[i] == "truncated"
                if role and follows(last, role[0]):
                    then(extra, "K", ((role, text),), i + 1, role[0])
                for new in news:
                    then(2 + extra, "R", ((new, text),), i + 1, new[0])
        return min(ways) if ways else None

    return best(0, "")


def brute(rows):
    out = set()
    for conv in {r[0] for r in rows}:
        mine = damaged([r for r in rows if r[0] == conv])
        found = faults(mine)
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [(r[1] or " ")[0] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, repaired = search(tuple(mine), found) if mine else (0, "", ())
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out.add((conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def random_rows(rng, convs, most):
    texts = ["yes.", "no", "a b?", "", " \t", "wow!  ", None, "x", "Tell me. More", "é."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "umpire"]
    rows = []
    for c in convs:
        for t in range(rng.randint(1, most)):
            turn = None if rng.random() < 0.05 else t * rng.choice([1, 1, 1, 2])
            rows.append((c, turn, rng.choice(roles[:5] if rng.random() < 0.8 else roles), rng.choice(texts)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_against_search(spark):
    rng = random.Random(5)
    rows = random_rows(rng, [*range(150), None, -4], 9)
    rows += rows[:20]  # repeated rows
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "2 AS symbol", "3 AS block", "'x' AS _key")
    got = [tuple(r) for r in D.repair_conversations(table).collect()]
    assert len(got) == 152 and set(got) == brute(rows)


def test_blocks_against_search(spark, monkeypatch):
    """Blocks of three rows, so that most conversations are composed of several."""
    monkeypatch.setattr(D, "BLOCK", 3)
    rows = random_rows(random.Random(6), range(40), 25)
    got = {tuple(r) for r in D.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_composed_blocks_are_one(size):
    rng = random.Random(size)
    for _ in range(60):
        symbols = bytes(rng.randrange(16) for _ in range(rng.randint(1, 120)))
        parts = [symbols[i : i + size] for i in range(0, len(symbols), size)]
        cost, ways, inserts = D.compose([D._unpack(D._pack(D.layers(p, tuple(D.STATES))[0])) for p in parts])
        audit = "".join(D.walk(D.layers(p, (e,))[1], e, s) for p, (e, s) in zip(parts, ways, strict=True)) + "I" * inserts
        assert (cost, audit) == D.repair(symbols)


def test_code_words():
    assert list(D.CODES) == sorted(D.CODES)
    assert not any(a != b and b.startswith(a) for a in D.CODES for b in D.CODES)


def test_very_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"row {i}.") for i in range(20_000)] + [(2, 0, "system", "only.")]
    got = {r["conv_id"]: r for r in D.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    mine = damaged([r for r in rows if r[0] == 1])
    found = faults(mine)
    symbols = bytes(D.INITIALS.index(r[1][0]) + 4 * D.FAULTS.index(f) for r, f in zip(mine, found, strict=True))
    cost, audit = D.repair(symbols)
    assert (got[1]["cost"], got[1]["audit"]) == (cost, audit) and len(audit) > 4 * D.BLOCK
    assert got[1]["truncated"] == found.count("truncated") and got[1]["blank"] == found.count("blank")


def test_odd_and_empty(spark):
    rows = [(None, None, None, None), (None, None, None, None), (5, None, "user", "x" * 200_000), (6, 2**62, "user", "a."), (6, -(2**62), "assistant", "b."), (7, 3, "", "z."), (7, 3, "", "z.")]
    table = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in D.repair_conversations(table).collect()} == brute(rows)
    assert D.repair_conversations(none_of(table)).count() == 0
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = [(c, 0, "user", "a.") for c in gone]
    got = D.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in got} == {(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in gone}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in D.op12_conversation_repair(spark, SF).collect()} == brute(rows)
