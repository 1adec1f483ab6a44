import json

from pyspark.sql import functions as F

from tessera.operators import claims as K
from tessera.operators import integrity as I
from tessera.operators import inventory as V
from tessera.operators import ledger as L
from tessera.sources import file_index, markdown_table, read_entities, read_events, read_index, scan_files
from tessera.sources import sinks


def test_fifo_is_the_multiset_minimum(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id long, c string")
    right = spark.createDataFrame([(9, "a"), (8, None), (7, None)], "id long, c string")
    got = {r["id"]: r["matched_id"] for r in I.fifo_match(left, right, ["c"]).collect()}
    assert got == {1: 9, 2: None, 3: 7, 4: None}
    assert [r["c"] for r in I.parity(left, right, ["c"]).orderBy("c").collect()] == ["a", "b"]


def test_claim_statuses(spark):
    raw = [("X", "made by", "Y", "DISPUTED", "f1", 1), ("x!", "Made-by", "y", None, "f2", 2), ("X", "made by", "Y", "odd", "f2", 3), ("Twin", "is", "Y", "VERIFIED", "f4", 4)]
    df = spark.createDataFrame([(*r, "e") for r in raw], "subject_raw string, predicate string, object_raw string, status string, file_id string, ord long, evidence_excerpt string")
    titles = spark.createDataFrame([("1", "X"), ("2", "twin"), ("3", "TWIN")], "id string, title string")
    aliases = spark.createDataFrame([("none", "none")], "alias string, name string")
    resolved = K.resolve(df, titles, aliases)
    assert {r["ord"]: r["resolution"] for r in resolved.collect()} == {1: "RESOLVED", 2: "RESOLVED", 3: "RESOLVED", 4: "PENDING_RESOLUTION"}
    one = K.consolidate(resolved.repartition(4)).collect()
    assert len(one) == 1 and one[0]["status"] == "SUPPORTED_BY_ARCHIVE" and one[0]["subject"] == "X" and one[0]["source_file_ids"] == ["f1", "f2"]


def test_qualifiers_are_part_of_a_claim(spark):
    rows = [("X", "is", "Y", "CONFIRMED", "f1", 1, "e", {"b": "1", "a": "2"}), ("X", "is", "Y", "VALID", "f2", 2, "e", {"a": "2", "b": "1"}), ("X", "is", "Y", "odd", "f3", 3, "e", None)]
    df = spark.createDataFrame(rows, "subject_raw string, predicate string, object_raw string, status string, file_id string, ord long, evidence_excerpt string, qualifiers map<string,string>")
    df = df.selectExpr("*", "'s1' AS subject_id", "'o1' AS object_id", "'RESOLVED' AS resolution")
    got = {r["claim_id"]: (r["status"], r["source_file_ids"]) for r in K.consolidate(df).collect()}
    import hashlib

    def ident(q):
        return "claim:" + hashlib.sha256(json.dumps(["s1", "is", "o1", q], sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    assert got == {ident({"a": "2", "b": "1"}): ("CONFIRMED", ["f1", "f2"]), ident({}): ("odd", ["f3"])}


def test_remediation_refuses_unknown_codes(spark):
    import pytest

    from tessera.operators import rules as R

    issues = spark.createDataFrame([("Z99", "MINOR", "e", "1", "t", "f", "m")], "code string, severity string, entity string, record_id string, title string, field string, message string")
    with pytest.raises(Exception, match="no remedy for Z99"):
        R.remediation(issues).collect()
    with pytest.raises(ValueError):
        R.check_policy({"R01": ("AUTO_FIX", "LOW")})


def test_mail_notes_and_folders(spark, tmp_path):
    from tessera.sources import read_folder_objects, read_mail, read_notes, truncated_tail

    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "1.eml").write_text("From: a@x\nTo: b@x\nSubject: Été\nDate: Mon, 01 Jan 2024 10:00:00 +0000\nMessage-ID: <1@x>\n\nhello\n> old\nOn Monday X wrote:\nmore\n")
    (tmp_path / "m" / "2.eml").write_text("From: a@x\nSubject: all\nPrecedence: bulk\n\nnews\n")
    (tmp_path / "m" / "3.eml").write_text("no headers at all\n")
    got = {r["path"][-5:]: r for r in read_mail(spark, str(tmp_path / "m"), skip_bulk=True).collect()}
    assert got["1.eml"]["outcome"] == "page" and got["1.eml"]["name"].startswith("mail-lavoro/2024-01-01-ete-")
    assert got["1.eml"]["content"].endswith('message_id: "<1@x>"\n---\n\n# Été\n\n**Da:** a@x | **A:** b@x | **Data:** 2024-01-01\n\nhello\n')
    assert got["2.eml"]["outcome"] == "skipped_bulk" and got["3.eml"]["outcome"] == "not_mail"
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "a_b.md").write_text("---\nown: 1\ndate: 2020-02-02\n---\n# Head  \ntext\n\n")
    note = read_notes(spark, str(tmp_path / "n")).first()
    assert note["name"].startswith("note-lavoro/2020-02-02-head-") and note["content"].startswith('---\ntitle: "Head"\ntype: "note"') and note["content"].endswith("\nown: 1\n---\n\n# Head  \ntext\n")
    folders = spark.createDataFrame([("A",), ("B",)], "folder string")
    texts = spark.createDataFrame([("A", 'obj_id: "X1"\nname: The House\naliases:\n  - Old House\n  - Casa\n')], "folder string, text string")
    rows, aliases = read_folder_objects(spark, folders, texts, "obj_id")
    assert {tuple(r) for r in rows.collect()} == {("X1", "The House"), ("B", "B")}
    assert {tuple(r) for r in aliases.collect()} == {("old house", "the house"), ("casa", "the house")}
    (tmp_path / "t.jsonl").write_text('{"k":"a"}\n{"k":"b"}\n{"k":')
    assert tuple(truncated_tail(spark, str(tmp_path / "t.jsonl"), spark.createDataFrame([("a",)], "k string").schema).first()) == (20, 5)


def test_last_line_wins_over_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k":"x","v":1}\n' + '{"k":"y","v":1}\n' * 2000)
    (tmp_path / "b.jsonl").write_text('{"k":"x","v":2}\n')
    schema = spark.createDataFrame([("a", 1)], "k string, v long").schema
    assert {(r["k"], r["v"]) for r in read_index(spark, str(tmp_path), schema, "k").collect()} == {("x", 2), ("y", 1)}
    old = spark.createDataFrame([(3, "p", "a")], "id long, k string, v string")
    new = spark.createDataFrame([(5, "p", "b"), (6, "p", "c"), (7, "q", "d")], "id long, k string, v string")
    assert {tuple(r) for r in sinks.upsert(old, new, "k", "id").collect()} == {(3, "p", "c"), (7, "q", "d")}
    for _ in range(3):
        sinks.append_rotating(new, str(tmp_path / "log"), 50)
    assert spark.read.json(str(tmp_path / "log")).count() == 3 and spark.read.json(str(tmp_path / "log.1")).count() == 3


def test_corroboration_needs_different_urls(spark):
    claims = spark.createDataFrame([("c1", "SUPPORTED_BY_WEB", ["a", "b"]), ("c2", "SUPPORTED_BY_WEB", ["a", "c"])], "claim_id string, status string, source_file_ids array<string>")
    sources = spark.createDataFrame([("a", "http://x.org/p?1"), ("b", "https://www.x.org/p/"), ("c", "http://y.org")], "file_id string, url string")
    assert {r["claim_id"]: r["status"] for r in K.corroborate(claims, sources).collect()} == {"c1": "SUPPORTED_BY_WEB", "c2": "VERIFIED"}


def test_chain_and_fsm(spark):
    import hashlib

    rows, before = [], L.GENESIS
    for i, e in enumerate(["RUN_CREATED", "RUN_STARTED", "RUN_CREATED", "RUN_COMPLETED"], 1):
        own = hashlib.sha256(f"{before}|{e}".encode()).hexdigest()
        rows.append((1, i, i, e, before, own))
        before = own
    df = spark.createDataFrame(rows, "run_id long, seq long, sequence long, event_type string, previous_hash string, record_hash string")
    assert L.chain_faults(df, ["run_id"], ["event_type"]).count() == 0
    bent = df.withColumn("event_type", F.when(F.col("seq") == 2, "RUN_FAILED").otherwise(F.col("event_type")))
    assert [r["fault"] for r in L.chain_faults(bent, ["run_id"], ["event_type"]).collect()] == ["record_hash"]
    assert [tuple(r) for r in L.fsm_violations(df).collect()] == [(1, 3)]


def test_retention_keeps_the_last_set(spark):
    sets = spark.createDataFrame([(1, "2020-01-01"), (2, "2024-01-01")], "id long, d string").select("id", F.to_date("d").alias("created_on"))
    assert [r["id"] for r in V.expired(sets, "2024-02-01").collect()] == [1]
    assert V.expired(sets, "2026-02-01").count() == 0


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text('{"k":"a","v":1}\n{"k":"b","v":2}\n{"k":"a","v":3}\n')
    schema = spark.createDataFrame([("a", 1)], "k string, v long").schema
    assert {(r["k"], r["v"]) for r in read_index(spark, str(tmp_path / "i.jsonl"), schema, "k").collect()} == {("a", 3), ("b", 2)}
    (tmp_path / "e.jsonl").write_text('{"k":"a","v":1}\nnot json\n{"k":"b","v":2}\n{"k":"c"')
    events, faults = read_events(spark, str(tmp_path / "e.jsonl"), schema)
    assert [r["k"] for r in events.orderBy("ord").collect()] == ["a", "b"] and [r["value"] for r in faults.collect()] == ["not json"]
    (tmp_path / "rows.json").write_text(json.dumps({"x": [{"id": "1"}, {"title": "t"}]}))
    assert [r["id"] for r in read_entities(spark, str(tmp_path / "rows.json"), "id: string, title: string").orderBy("id").collect()] == ["1", "x:00001"]
    (tmp_path / "r.md").write_text("# R\n| A | B |\n|---|---|\n| 1 | x |\n| 2 | y |\n")
    assert [tuple(r) for r in markdown_table(spark, str(tmp_path / "r.md"), ["a", "b"]).collect()] == [("1", "x"), ("2", "y")]
    (tmp_path / "f").mkdir()
    for n in ("p.txt", "q.txt"):
        (tmp_path / "f" / n).write_text("same")
    index = file_index(scan_files(spark, str(tmp_path / "f"))).collect()
    assert len(index) == 1 and len(index[0]["paths"]) == 2
    new = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v long")
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    assert [r["k"] for r in sinks.changed_only(new, old, "k", ["v"]).collect()] == ["b"]
    assert {tuple(r) for r in sinks.upsert(old, new.filter("k = 'b'"), "k").collect()} == {("a", 1), ("b", 3)}
    sinks.write_canonical(new, "k", str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"k":"a","v":1}', '{"k":"b","v":3}']
