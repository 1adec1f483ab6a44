"""Checkpoints, backup health and record files on small cases; each case names what it shows."""

import datetime as dt

from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.operators import ledger as L
from tessera.operators import signals as G
from tessera.sources import read_record_files

EVENTS = "run_id string, seq long, event_type string, stage string, component struct<name: string>, input_artifacts array<string>, output_artifacts array<string>"


def _run(spark, events, artifacts=(), files=(), stages=("A", "B", "C"), asked=None):
    requested = spark.createDataFrame([("r", i, s) for i, s in enumerate(stages)], "run_id string, idx int, stage string")
    kept = spark.createDataFrame([("r", *a) for a in artifacts], "run_id string, artifact_id string, path string, size long, sha256 string")
    there = spark.createDataFrame(list(files), "path string, size long, sha256 string")
    wanted = asked and spark.createDataFrame([("r", s) for s in asked], "run_id string, stage string")
    log = spark.createDataFrame([("r", *e) for e in events], EVENTS)
    return {r["stage"]: r for r in L.checkpoints(requested, log, kept, there, wanted).collect()}


def test_conditions_come_in_order_and_name_their_artifacts(spark):
    done = (2, "STAGE_COMPLETED", "A", None, ["gone", "new", "fine"], ["long", "other", "fine"])
    kept = [("gone", "p0", 1, "h"), ("fine", "p1", 1, "h"), ("long", "p2", 1, "h"), ("other", "p3", 1, "h")]
    files = [("p1", 1, "h"), ("p2", 2, "h"), ("p3", 1, "x")]
    got = _run(spark, [(1, "STAGE_STARTED", "A", None, None, None), done], kept, files)
    assert got["A"]["failed_conditions"] == ["COMPONENT_FINGERPRINT_MISSING", "INPUT_FILE_MISSING:gone", "INPUT_NOT_REGISTERED:new", "OUTPUT_SIZE_MISMATCH:long", "OUTPUT_HASH_MISMATCH:other"]
    assert not got["A"]["valid"] and got["A"]["derived_from_seq"] == 2 and got["A"]["resume_from"] == "B"
    assert got["A"]["input_artifacts"] == ["gone", "new", "fine"] and got["A"]["checkpoint_id"] == "cp_a_complete"
    assert got["B"]["failed_conditions"] == ["STAGE_NOT_COMPLETED"] and got["B"]["stage_state"] == "NOT_STARTED" and got["B"]["derived_from_seq"] == 0
    assert got["C"]["resume_from"] is None


def test_a_skipped_stage_is_satisfied_even_after_a_completion_whose_files_are_gone(spark):
    events = [(1, "STAGE_COMPLETED", "A", None, ["gone"], []), (2, "STAGE_SKIPPED", "A", None, None, None), (3, "STAGE_SKIPPED", "Z", None, None, None)]
    got = _run(spark, events, asked=["A", "Z"])
    assert got["A"]["valid"] and got["A"]["input_artifacts"] == [] and got["A"]["checkpoint_id"] == "cp_a_skipped" and got["A"]["derived_from_seq"] == 2
    assert got["Z"]["failed_conditions"] == ["STAGE_NOT_REQUESTED"] and got["Z"]["resume_from"] is None and not got["Z"]["valid"]


def test_the_last_completion_counts_and_null_lists_are_empty(spark):
    one = ("engine",)
    events = [(1, "STAGE_COMPLETED", "A", None, ["gone"], ["gone"]), (2, "STAGE_FAILED", "A", None, None, None), (3, "STAGE_RESTARTED", "A", None, None, None), (4, "STAGE_COMPLETED", "A", one, None, [])]
    got = _run(spark, events, stages=("A", "B", "A"))
    assert got["A"]["valid"] and got["A"]["derived_from_seq"] == 4
    assert got["A"]["resume_from"] == "B" and len(got) == 2, "a stage requested twice counts where it is first"
    late = [(5, "STAGE_STARTED", "B", one, None, None)]
    assert _run(spark, late)["B"]["stage_state"] == "RUNNING"


def test_empty_tables_give_checkpoints_that_nothing_bears_out(spark):
    assert {r["failed_conditions"][0] for r in _run(spark, []).values()} == {"STAGE_NOT_COMPLETED"}
    assert _run(spark, [], stages=()) == {}


def test_backup_health(spark):
    at = lambda day: dt.datetime(2024, 1, day)
    made, tried, ok = "backup.create", "restore.check", "verified"
    rows = [
        ("pass", made, ok, at(30), "b2", True), ("pass", made, ok, at(29), "b1", False), ("pass", tried, ok, at(20), None, None),
        ("untested", made, ok, at(30), "b", True), ("untested", tried, "failed", at(30), None, None),
        ("long ago", made, ok, at(30), "b", True), ("long ago", tried, ok, at(1), None, None),
        ("old", made, ok, at(20), "b", True), ("unfit", made, ok, at(30), "b", None), ("failed", made, "failed", at(30), "b", True), ("no time", made, ok, None, "b", True),
    ]
    records = spark.createDataFrame(rows, "name string, action string, outcome string, at timestamp_ntz, backup_id string, fit boolean")
    got = {r["name"]: r for r in G.backup_health(records, "2024-01-31 00:00:00", 2 * 86400, 20).collect()}
    assert {k: r["classification"] for k, r in got.items()} == {"pass": "PASS", "untested": "DEGRADED", "long ago": "DEGRADED", "old": "FAIL", "unfit": "FAIL", "failed": "FAIL", "no time": "FAIL"}
    assert got["pass"]["latest_backup"] == "b2" and got["pass"]["backup_age"] == 86400 and got["pass"]["restore_age"] == 11.0


def test_one_unreadable_line_fails_its_file_and_a_bad_record_only_itself(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text('{"service": "a", "n": 1}\n\n{"service": "b", "n": 2}\n')
    (tmp_path / "notes.jsonl").write_text('{"service": "c", "n": 3}\n{"service": "d", "n": "many"}\n{"n": 4}\n[]\n')
    (tmp_path / "torn.jsonl").write_text('{"service": "e", "n": 5}\n{"service": "f", \n{"service"')
    (tmp_path / "empty.jsonl").write_text("")
    schema = StructType([StructField("service", StringType()), StructField("n", LongType())])
    records, notes, failed = read_record_files(spark, str(tmp_path), schema, "service IS NOT NULL")
    assert sorted(r["service"] for r in records.collect()) == ["a", "b", "c"]
    assert sorted(r["value"] for r in notes.collect()) == ['[]', '{"n": 4}', '{"service": "d", "n": "many"}']
    assert [(r["file"].rsplit("/", 1)[1], r["unreadable"]) for r in failed.collect()] == [("torn.jsonl", 2)]
