import itertools
import os
import random

import pytest

from tessera.operators import ledger as L
from tessera.streaming import ledgers as S

SCHEMA = "run_id long, seq long, event_type string, at timestamp"


def events(rng, runs=12):
    kinds = [*L.RUN_STATES, "HUMAN_DECISION"]
    usual = ["RUN_CREATED", "RUN_STARTED", "RUN_PAUSED", "RUN_RESUMED", "RUN_COMPLETED"]
    out = []
    for run in range(runs):
        for i in range(rng.randint(1, 9)):
            out.append((run, i + 1, usual[i % 5] if rng.random() < 0.7 else rng.choice(kinds)))
    return out


def put(spark, folder, n, rows):
    spark.createDataFrame(rows, "run_id long, seq long, event_type string, s long").selectExpr("run_id", "seq", "event_type", "timestamp_seconds(s) AS at").coalesce(1).write.mode("append").parquet(f"{folder}/b{n:04d}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


@pytest.mark.parametrize("seed", [1, 2])
def test_violations_whatever_the_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = events(rng)
    gone = rng.sample(rows, 4)  # seqs that never come: the rest waits until the watermark passes
    rows = [r for r in rows if r not in gone]
    want = {(run, s) for run, s, e in _batch(rows)}
    rng.shuffle(rows)
    rows += rows[:5]  # repeats
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [rows[i::4] for i in range(4)]
    for n, part in enumerate(parts):
        put(spark, folder, n, [(*r, 100 + i) for i, r in enumerate(part)])
    put(spark, folder, 8, [(999, 1, "RUN_CREATED", 10_000)])
    put(spark, folder, 9, [(999, 2, "RUN_STARTED", 10_001)])
    S.run_once(S.ordered_violations(stream(spark, folder), "at", "1 minute"), out, str(tmp_path / "check"))
    got = [(r["run_id"], r["seq"]) for r in S.read_committed(spark, out).collect()]
    assert sorted(got) == sorted(want)
    state = spark.read.format("statestore").load(str(tmp_path / "check"))
    assert {r["key"]["run_id"] for r in state.select("key").collect()} == {999}  # all ended runs are freed


def _batch(rows):
    """The batch check's violations, all of them."""
    for run, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        now = None
        for _, seq, event in group:
            if event in L.RUN_STATES:
                if (now, event) not in L.RUN_TRANSITIONS:
                    yield run, seq, event
                now = L.RUN_STATES[event]


def test_batch_check_agrees(spark):
    rows = events(random.Random(5), 30)
    first = {}
    for run, seq, _ in _batch(rows):
        first.setdefault(run, seq)
    df = spark.createDataFrame(rows, "run_id long, seq long, event_type string")
    assert {r["run_id"]: r["first_violation_seq"] for r in L.fsm_violations(df).collect()} == first


def test_sink_survives_a_kill_between_data_and_manifest(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for n in range(4):
        put(spark, folder, n, [(n, i, "RUN_CREATED", n) for i in range(5)])

    def kill(number):
        if number == 2:
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        S.run_once(stream(spark, folder), out, check, kill)
    assert S.resume_point(spark, out) == 2 and os.path.exists(f"{out}/data/batch=2") and not os.path.exists(f"{out}/manifest/2.json")
    assert S.read_committed(spark, out).count() == 10  # what isn't in the manifest isn't there
    S.run_once(stream(spark, folder), out, check)
    rows = [(r["run_id"], r["seq"]) for r in S.read_committed(spark, out).collect()]
    assert sorted(rows) == [(n, i) for n in range(4) for i in range(5)] and S.resume_point(spark, out) == 4
    # a batch that is committed isn't written again, even if its checkpoint is lost
    before = sorted(os.listdir(f"{out}/data/batch=1"))
    S.run_once(stream(spark, folder), out, check + "2")
    assert sorted(os.listdir(f"{out}/data/batch=1")) == before and S.read_committed(spark, out).count() == 20
