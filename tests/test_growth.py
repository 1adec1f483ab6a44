"""What decides how a query's cost grows: how often its plan repeats work, and what its shuffles carry."""

import re
from hashlib import sha256

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera import scratch
from tessera.functions import text as X
from tessera.operators import claims as K
from tessera.operators import ledger
from tessera.operators import rules as R
from tessera.plans import registry


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_chain_takes_each_record_apart_once(spark):
    rows = spark.createDataFrame([("a", '{"sequence":1,"previous_hash":"x","record_hash":"y"}'), ("a", "no")], "who string, record string")
    faults = ledger.audit_chain_faults(rows, ["who"])
    assert plan(faults).count("from_json(") == 1
    assert sorted((r["sequence"] or 0, r["fault"]) for r in faults.collect()) == [(0, "unreadable"), (1, "previous_hash")]


def test_html_text_keeps_references_without_a_semicolon_as_its_sql_does(spark, tmp_path):
    pages = ["<title>a &amp</title><p>b &amp; c</p>", "x &lt y", "cut &am", "&copy", None, "<p>&#39;&#39</p>"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["text"] for r in registry.QUERIES["html_text"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == dict(con.execute(registry.ORACLE_SQL["html_text"]).fetchall())
    assert got[0] == "a &amp\nb & c"


@pytest.fixture
def shuffled(spark):
    """No broadcasts and no coalescing, so that a row's partition shows where the last shuffle sent it."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest(df) -> float:
    n = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    return max(n) / sum(n)


def test_aliases_of_one_name_dont_bring_their_claims_to_one_task(spark, shuffled):
    raw = spark.range(400).select(F.lit("p1").alias("subject_raw"), F.concat(F.lit("alias "), "id").alias("object_raw"))
    rows = spark.createDataFrame([("P1", "p1"), ("N1", "one name")], "id string, title string")
    aliases = raw.select(F.col("object_raw").alias("alias"), F.lit("one name").alias("name"))
    out = K.resolve(raw, rows, aliases)
    assert out.filter("object_id = 'N1' and subject_id = 'P1' and resolution = 'RESOLVED'").count() == 400
    assert largest(out) < 0.5


def pages(spark, n: int):
    entities = spark.range(n).select(F.concat(F.lit("e "), "id").alias("name"), F.lit("part").alias("entity_type"))
    claims = spark.range(n).select(F.concat(F.lit("c"), "id").alias("claim_id"), F.col("id").alias("ord"), F.lit("made by").alias("predicate"), F.concat(F.lit("e "), "id").alias("subject"), F.lit("x").alias("object"), F.lit("VERIFIED").alias("status"))
    rows = entities.select(F.col("name").alias("id"), "entity_type", F.col("name").alias("title"), F.create_map(F.lit("maker"), F.lit("x")).alias("fields"), F.lit(1).alias("ord"))
    hints = spark.createDataFrame([("part", "field", "made by", None, "maker", None, 2)], "entity_type string, layer string, predicate string, anchor string, key string, target_type string, turn int")
    schema = spark.createDataFrame([("part", "maker", "Maker")], "entity_type string, key string, property string")
    return entities, claims, rows, hints, schema


def test_operations_without_a_target_dont_meet_in_one_task(spark, shuffled):
    entities, claims, rows, hints, schema = pages(spark, 400)
    out = K.entity_operations(entities, claims, rows, hints, schema)
    assert out.filter("layer = 'field' and action = 'KEEP'").count() == 400
    assert "?" in plan(out) and "row_number" not in plan(out)


def test_candidate_pages_work_out_their_operations_once(spark):
    required = spark.createDataFrame([("part", "maker")], "entity_type string, key string")
    out = K.fan_out(*pages(spark, 3), required, [])
    assert plan(out).count("Generate explode") == 1
    assert [tuple(r) for r in out.select("match", "gate", "operations").distinct().collect()] == [("EXISTS_AND_MATCHES", "READY_FOR_NOTION", 0)]


def test_a_patch_works_out_its_claims_once(spark):
    claims = spark.createDataFrame([("c1", "e", "made by", "x", "VERIFIED", ["f", "g"]), ("c2", "e", "made by", "y", "VERIFIED", [])], "claim_id string, subject_id string, predicate string, object string, status string, source_file_ids array<string>")
    claims = claims.groupBy("claim_id").agg(*[F.first(c).alias(c) for c in claims.columns[1:]])
    fields = spark.createDataFrame([("made by", "maker", "Maker", "property")], "name string, key string, property string, kind string")
    current = spark.createDataFrame([("e", "maker", "", None)], "entity_id string, key string, value string, list array<string>")
    index = spark.createDataFrame([("f", ["a"]), ("g", [])], "file_id string, paths array<string>")
    out = K.patch(claims, fields, current, index)
    assert len(re.findall(r"(?:LogicalRDD|LocalRelation) \[claim_id", plan(out))) == 1
    assert {r["claim_id"]: r["action"] for r in out.collect()} == {"c1": "ADD", "c2": "CONFLICT"}


def _checkpoint_tables(spark, n: int):
    requested = spark.range(n).select(F.concat(F.lit("r"), "id").alias("run_id"), F.lit(1).alias("idx"), F.lit("A").alias("stage"))
    ids = F.array(F.lit("x"), F.lit("y"))
    events = requested.select("run_id", F.lit(2).alias("seq"), F.lit("STAGE_COMPLETED").alias("event_type"), "stage", F.struct(F.lit("engine").alias("name")).alias("component"), ids.alias("input_artifacts"), F.array().cast("array<string>").alias("output_artifacts"))
    artifacts = requested.select("run_id", F.explode(ids).alias("artifact_id")).withColumns({"path": F.col("artifact_id"), "size": F.lit(1).cast("long"), "sha256": F.lit("h")})
    return requested, events, artifacts, spark.createDataFrame([("x", 1, "h"), ("y", 1, "other")], "path string, size long, sha256 string")


def test_tasks_of_checkpoints_dont_grow_with_the_table(spark, shuffled, monkeypatch):
    monkeypatch.setattr(scratch, "TASK_ROWS", 20)
    out = ledger.checkpoints(*_checkpoint_tables(spark, 1000))
    assert largest(out) < 0.05
    assert out.filter("failed_conditions = array('INPUT_HASH_MISMATCH:y')").count() == 1000


def test_an_artifact_registered_twice_is_the_first_row_by_path_size_and_digest(spark):
    values = [None, "a", "b", "c"], [None, 1, 2, 3]
    kinds = [(p, s, h) for p in ("p", "q", "z", None) for s in values[1] for h in values[0]]
    pairs = [(f"r{i}-{j}", "x", *a) for i, a in enumerate(kinds) for j in range(i, len(kinds)) for a in (kinds[i], kinds[j])]
    there = {"p": (2, "b"), "q": (2, None), "y": (1, "a")}
    rows = spark.createDataFrame(pairs, "run_id string, artifact_id string, path string, size long, sha256 string")
    runs = rows.select("run_id").distinct()
    events = runs.select("run_id", F.lit(1).alias("seq"), F.lit("STAGE_COMPLETED").alias("event_type"), F.lit("A").alias("stage"), F.struct(F.lit("e").alias("name")).alias("component"), F.array(F.lit("x")).alias("input_artifacts"), F.lit(None).cast("array<string>").alias("output_artifacts"))
    listing = spark.createDataFrame([(p, *v) for p, v in there.items()], "path string, size long, sha256 string")
    got = {r["run_id"]: r["failed_conditions"] for r in ledger.checkpoints(runs.select("run_id", F.lit(0).alias("idx"), F.lit("A").alias("stage")), events, rows, listing).collect()}
    held = {}
    for run, _, *row in pairs:
        held.setdefault(run, []).append(row)
    for run, registered in held.items():
        path, size, digest = min(registered, key=lambda r: [(v is not None, v or "" if k != 1 else v or 0) for k, v in enumerate(r)])
        f = there.get(path)
        why = "FILE_MISSING" if f is None else "SIZE_MISMATCH" if size != f[0] or size is None else "HASH_MISMATCH" if digest is None or digest != f[1] else None
        assert got[run] == ([f"INPUT_{why}:x"] if why else []), registered


def test_a_date_by_itself_needs_no_cutting_and_reads_as_before(spark):
    want = {"2024-1-5": "2024-01-05", "05/1/2024": "2024-01-05", "2024-02-31": "2024-01-01", "31/2/2024": "2024-01-01", "0000-01-01": "0000-01-01", "1/1/0000": "0000-01-01", "2024-1-5\n": "2024-01-05", " 5/1/2024 ": "2024-01-05", "2024-01-05T10:00": "2024-01-05", "2024-13-01": "2024-01-01", "0999-03-04": "0999-03-04", "soon": None, "": None, None: None}
    rows = spark.createDataFrame([(v,) for v in want], "v string").select("v", X.parse_date(F.col("v")).cast("string").alias("d"))
    assert {r["v"]: r["d"] for r in rows.collect()} == want


def test_the_audit_normalises_a_text_once(spark):
    cfg = R.Config(entities={"work": R.Entity(fields={"note": R.Field()})}, placeholders=("to do",), promotional=("Été",), vague=("of",), generated=("and", "the"))
    said = "The séa and the land of the long été are one thing here. "
    bodies = [said * 3 + "End", "x" * 41 + ". " + said, said.upper() + "To-do!\n" + said, "　 . ? ", "Land. of\x1c the! and", None, "ﬁt ⒈ of. " + "½ of the and " * 9]
    rows = [("work", f"w{i}", f"t{i}", {"note": b and b[:60]}, b) for i, b in enumerate(bodies)]
    corpus = spark.createDataFrame(rows, "entity string, id string, title string, fields map<string,string>, body string")
    both = R.text_rules(corpus, cfg)
    assert "translate(" not in plan(both), "issues and sentences come from one written table"
    codes = [R.text_rules(corpus, cfg, (c,)) for c in (*R.TEXT_CODES, "Q07")]
    apart = sorted(tuple(r) for one in codes for r in one.collect())
    assert sorted(map(tuple, both.collect())) == apart and {r[0] for r in apart} == {*R.TEXT_CODES, "Q07"}


def test_discovery_looks_at_a_name_once_for_each_predicate_and_side(spark):
    claims = spark.createDataFrame([(" É b ", "made-by", "x", 3), ("É b", "made by", "", 1), ("e B", "Made By", None, 2), ("e B", "Made By", "Prime", 5)], "subject_raw string, predicate string, object_raw string, ord long")
    hints = spark.createDataFrame([("made by", "subject", "thing")], "predicate string, anchor string, entity_type string")
    rows = spark.createDataFrame([("row", "X", 1)], "entity_type string, title string, ord int")
    out = K.discover(claims, rows, hints, "prime")
    assert sorted((r["name"], r["ord"], r["type_source"], r["entity_type"]) for r in out.collect()) == [("e B", 2, "hinted_not_confirmed", "thing"), ("x", 3, "matched_existing_row", "row"), ("É b", 1, "hinted_not_confirmed", "thing")]
    steps = plan(out).split("\n")
    names = next(i for i, line in enumerate(steps) if "Generate stack(" in line)
    grouped = max(i for i, line in enumerate(steps[:names]) if "Aggregate [name" in line)
    assert not any("translate(" in line for line in steps[grouped : names + 1])


def test_the_merged_index_brings_short_ids_together_and_hashes_them_where_shown(spark):
    steps = plan(registry.QUERIES["merged_index"](spark, "/root/testdata/sf0.001")).split("\n")
    merged = next(i for i, line in enumerate(steps) if "Window [" in line)
    assert any("sha2(" in line for line in steps[:merged]) and not any("sha2(" in line for line in steps[merged:])


def test_sentences_normalise_as_their_text_does(spark):
    odd = "".join(map(chr, [*range(0x80), *range(0xA0, 0x250), *range(0x2000, 0x2200), 0x1F110, 0x1D518]))
    said = [odd, odd * 2 + ".\x01 x", "é" * 41 + "?\n　" + "ß" * 41 + "! \x1c" + "a" * 40 + " . B", "a.\x01 b", "one\x01two. . \u0085three", "", None, "ﬁt ⒈ of. ½"]
    rows = spark.createDataFrame(list(enumerate(said)), "i int, t string")
    got = [r["s"] for r in rows.select("i", X.normal_sentences()(F.col("t")).alias("s")).orderBy("i").collect()]
    assert [r["n"] for r in got] == list(X.exact_norm(pd.Series(said)))
    for text, r in zip(said, got, strict=True):
        parts = re.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+", text or "")
        long_ = [n for p, n in zip(parts, X.exact_norm(pd.Series(parts)), strict=True) if len(p.strip(X.STRIPPED)) > 40]
        assert [bytes(k) for k in r["keys"]] == [sha256(n.encode()).digest() for n in long_]
    spaces = spark.range(0x110000).filter("id not between 55296 and 57343").select("id", F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("x"))
    assert "".join(r["x"] for r in spaces.filter(F.length(X.strip(F.col("x"))) == 0).orderBy("id").collect()) == "".join(sorted(X.STRIPPED))


def test_the_audit_matches_no_pattern_at_each_word_and_looks_for_inverses_only_where_there_are_any(spark):
    assert "[^a-z0-9]+" not in plan(spark.range(1).select(X.norm(F.col("id"))))
    corpus = spark.createDataFrame([("a", "1", "A", {"b": ["2"], "c": ["2"]}, 1), ("b", "2", "B", {"a": ["1"]}, 2)], "entity string, id string, title string, relations map<string,array<string>>, ord int")
    cfg = R.Config(entities={"a": R.Entity(relations={"b": R.Relation("b", inverse="a"), "c": R.Relation("b")}), "b": R.Entity(relations={"a": R.Relation("a", inverse="b")})})
    out = R.relation_rules(corpus, cfg)
    assert out.count() == 0
    assert re.search(r"_rel#\d+ IN \(a,b\)", plan(out))


def above(df, step: str) -> list[str]:
    """The steps of the physical plan that take what a step makes, nearest first."""
    lines = re.findall(r"^(?:[ :]*[:+]- )?(?:\*\(\d+\) )?[A-Z][a-z].*", df._jdf.queryExecution().executedPlan().toString(), re.M)
    at = next(i for i, line in enumerate(lines) if re.search(step, line))
    out, deep = [], re.search(r"\w|\*", lines[at]).start()
    for line in lines[at - 1 :: -1] if at else []:
        found = re.search(r"\w|\*", line)
        if found and found.start() < deep:
            out.append(line)
            deep = found.start()
    return out


CONSOLIDATED = r"keys?=\[subject_id#\w+, _key#\w+"


@pytest.mark.parametrize("name", ["body_candidates", "body_markdown", "web_verification", "claims_patch", "claims_corroborate"])
def test_claims_are_not_dealt_out_again_once_they_are_consolidated(spark, shuffled, name):
    steps = above(registry.QUERIES[name](spark, "/root/testdata/sf0.001"), CONSOLIDATED)
    assert steps and not any("Exchange" in step for step in steps)


def test_operations_are_not_dealt_out_as_rows(spark, shuffled):
    """entity_operations deals its claims out twice, by either text; candidate pages deal out sums of operations."""
    queries = {name: registry.QUERIES[name](spark, "/root/testdata/sf0.001") for name in ("entity_operations", "multi_candidates")}
    assert not any("Exchange" in step for step in above(queries["entity_operations"], "Generate explode"))
    assert sum("Exchange" in step for step in above(queries["entity_operations"], CONSOLIDATED)) == 2
    steps = above(queries["multi_candidates"], "Generate explode")
    first = next(i for i, step in enumerate(steps) if "Exchange" in step)
    assert any("Aggregate(" in step for step in steps[:first])


def test_operations_of_odd_names(spark):
    """A claim of one name on both sides is one operation of each entity called so; a row without an id is no target."""
    entities = spark.createDataFrame([("A", "part"), ("a!", "part"), ("A", "supplier"), ("b", "supplier")], "name string, entity_type string")
    rows = spark.createDataFrame([("part", "P", "a", {"maker": "x", "other": "y"}, 1), ("supplier", None, "b", None, 1), ("supplier", "S", "c", None, 2)], "entity_type string, id string, title string, fields map<string,string>, ord int")
    claims = spark.createDataFrame([("c1", 1, "made by", "A", "a", "VERIFIED"), ("c2", 2, "sold by", "a", "b", "VERIFIED"), ("c3", 3, "sold by", "a", "C", "VERIFIED"), ("c4", 4, "sold by", "a", None, "VERIFIED"), ("c5", 5, "made by", None, "x", "VERIFIED")], "claim_id string, ord int, predicate string, subject string, object string, status string")
    hints = spark.createDataFrame([("part", "field", "made by", None, "maker", None, 1), ("part", "relation", "sold by", "object", "shops", "supplier", 2)], "entity_type string, layer string, predicate string, anchor string, key string, target_type string, turn int")
    schema = spark.createDataFrame([("part", "shops", "Shops"), ("part", "maker", "Maker")], "entity_type string, key string, property string")
    got = sorted(tuple(r) for r in K.entity_operations(entities, claims, rows, hints, schema).select("claim_id", "name", "entity_type", "layer", F.coalesce("action", F.lit("")), F.coalesce("reason", F.lit(""))).collect())
    lost, known = ("relation", "CONFLICT", "RELATION_TARGET_ID_NOT_RESOLVED"), ("relation", "CONFLICT", "RELATION_WRITE_NOT_SUPPORTED")
    per = {"c1": ("field", "CONFLICT", "FIELD_VALUE_MISMATCH"), "c2": lost, "c3": known, "c4": lost}
    want = [(c, n, "part", *p) for c, p in per.items() for n in ("A", "a!")] + [(c, "A", "supplier", "body", "", "") for c in per] + [("c2", "b", "supplier", "body", "", "")]
    assert got == sorted(want)


def test_claims_that_hold_what_is_known_of_their_files_need_no_index(spark):
    claims = spark.createDataFrame([("c1", "e", 1, "made by", "s", "x", "VERIFIED", ["f", "g"]), ("c2", "e", 2, "made by", "s", "y", "SUPPORTED_BY_WEB", ["g", "h"]), ("c3", "d", 3, "said", "s", "z", "VERIFIED", [])], "claim_id string, subject_id string, ord int, predicate string, subject string, object string, status string, source_file_ids array<string>")
    index = spark.createDataFrame([("f", ["a"]), ("g", []), ("h", ["b", "c"])], "file_id string, paths array<string>")
    told = spark.createDataFrame([("c1", True, "a", True, ["u", "u"]), ("c2", True, None, False, ["u", "v"]), ("c3", None, None, None, None)], "claim_id string, located boolean, source_path string, from_web boolean, urls array<string>")
    held = claims.join(told, "claim_id")
    fields = spark.createDataFrame([("made by", "maker", "Maker", "property")], "name string, key string, property string, kind string")
    current = spark.createDataFrame([("e", "maker", "x", None), ("e", "maker", "y", None), ("e", "other", "x", None)], "entity_id string, key string, value string, list array<string>")
    bodies = spark.createDataFrame([("e", "text")], "entity_id string, body string")
    sources = spark.createDataFrame([("f", "http://u/"), ("g", "https://www.U"), ("h", "v?q")], "file_id string, url string")

    def rows(df, *names):
        return sorted((tuple(r) for r in df.select(*names or df.columns).collect()), key=repr)

    assert rows(K.patch(held, fields, current)) == rows(K.patch(claims, fields, current, index)) == [("c1", "UPDATE", None, "Maker"), ("c2", "CONFLICT", "UNSUPPORTED_STATUS_OR_MISSING_PROVENANCE", "Maker"), ("c2", "CONFLICT", "UNSUPPORTED_STATUS_OR_MISSING_PROVENANCE", "Maker"), ("c3", "CONFLICT", "UNSUPPORTED_STATUS_OR_MISSING_PROVENANCE", None)]
    assert rows(K.body_candidates(held, bodies, None, "h")) == rows(K.body_candidates(claims, bodies, index, "h").select(K.body_candidates(held, bodies, None, "h").columns))
    assert rows(K.summarize_verification(held)) == rows(K.summarize_verification(claims, index.filter("file_id = 'f'"))) == [("d", "NOT_EXECUTED", "", ""), ("e", "EXECUTED", "made by", "")]
    assert rows(K.corroborate(held), "claim_id", "status") == rows(K.corroborate(claims, sources), "claim_id", "status") == [("c1", "VERIFIED"), ("c2", "VERIFIED"), ("c3", "VERIFIED")]
    assert rows(K.urls_of_files(sources)) == [("f", ["u"]), ("g", ["u"]), ("h", ["v"])]


def test_operations_of_skipped_types_are_not_worked_out(spark, monkeypatch):
    asked, work = [], K.entity_operations
    monkeypatch.setattr(K, "entity_operations", lambda entities, *a: asked.append(entities) or work(entities, *a))
    entities, *others = pages(spark, 2)
    required = spark.createDataFrame([("part", "maker")], "entity_type string, key string")
    both = entities.unionByName(spark.createDataFrame([("e 0", "shop"), ("e 1", None)], "name string, entity_type string"))
    got = {(r["name"], r["entity_type"]): (r["operations"], r["skipped"]) for r in K.fan_out(both, *others, required, ["shop"]).collect()}
    assert {r["entity_type"] for r in asked[0].collect()} == {"part", None}
    assert got[("e 0", "part")] == (0, None) and got[("e 0", "shop")] == (None, "REQUIRES_EXISTING_LINK_NOT_FOUND")
