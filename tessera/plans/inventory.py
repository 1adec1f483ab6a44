"""Inventory, planning, ledger and health queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import inventory as V
from tessera.operators import ledger as L

from .adapters import Source, with_ctes

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None, *ctes: str):
    def keep(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = with_ctes(sql, *ctes) if ctes else sql
        return fn

    return keep


query("content_groups", "SELECT sha256, string_agg(path, '|' ORDER BY path) AS paths, count(*) AS n FROM resources GROUP BY sha256", "resources")(lambda s: V.content_groups(s["resources"]))
query("exact_duplicates", "SELECT sha256, count(*) AS n, min(path) AS first_path FROM resources GROUP BY sha256 HAVING count(*) > 1", "resources")(lambda s: V.exact_duplicates(s["resources"]))
query(
    "import_dedup",
    "SELECT doc_id, CASE WHEN sha256 NOT IN (SELECT sha256 FROM resources WHERE doc_id % 4 = 0) AND row_number() OVER (PARTITION BY sha256 ORDER BY doc_id) = 1 THEN 'resource_imported' ELSE 'resource_seen_again' END AS outcome FROM resources",
    "resources",
)(lambda s: V.import_outcome(s["resources"], s["resources"].withColumn("sha256", F.when(F.col("doc_id") % 4 == 0, F.col("sha256"))).filter("sha256 is not null"), "doc_id").select("doc_id", "outcome"))


@query("oid_allocate", "SELECT doc_id, p || '-' || lpad(CAST(base + row_number() OVER (PARTITION BY kind ORDER BY doc_id) AS VARCHAR), 6, '0') AS oid FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'Resource' ELSE 'Core' END AS kind, CASE WHEN lang = 'en' THEN 'RES' ELSE 'COR' END AS p, CASE WHEN lang = 'en' THEN 5000 ELSE 10 END AS base FROM documents)")
def oid_allocate(s: Source):
    sequences = s.spark.createDataFrame([("Resource", "RES", 5000), ("Core", "COR", 10)], "object_type string, prefix string, last_value long")
    rows = s.t("documents").select("doc_id", F.when(F.col("lang") == "en", "Resource").otherwise("Core").alias("kind"))
    return V.allocate(rows, sequences, "kind", "doc_id").select("doc_id", "oid")


query(
    "master_compare",
    "SELECT doc_id, CASE WHEN sha256 IN (SELECT sha256 FROM resources WHERE doc_id % 3 = 0) THEN 'EXACT MATCH' WHEN upper(filename) IN (SELECT upper(filename) FROM resources WHERE doc_id % 5 = 0) THEN 'SAME NAME' ELSE 'UNKNOWN — INDEX INCOMPLETE' END AS comparison FROM resources",
    "resources",
)(lambda s: V.compare_master(s["resources"], s["resources"].select(F.when(F.col("doc_id") % 3 == 0, F.col("sha256")).alias("sha256"), F.when(F.col("doc_id") % 5 == 0, F.upper("filename")).alias("filename")), False).select("doc_id", "comparison"))
query("master_none", "SELECT doc_id, 'NOT CHECKED' AS comparison FROM resources", "resources")(lambda s: V.compare_master(s["resources"], None, True).select("doc_id", "comparison"))
query("extension_histogram", "SELECT extension, count(*) AS n FROM resources GROUP BY 1 ORDER BY n DESC, extension", "resources")(lambda s: V.histogram(s["resources"], "extension"))
query("plan_moves", "SELECT path, 'in/' || path AS destination, CASE WHEN path LIKE '%/../%' THEN 'unsafe path' WHEN count(*) OVER (PARTITION BY 'in/' || path) > 1 THEN 'destination twice' END AS problem FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN split_part(path, '/', 1) || '/../x' WHEN doc_id % 10 = 1 THEN split_part(path, '/', 1) || '/same' ELSE path END AS path FROM resources)", "resources")(
    lambda s: V.plan_moves(s["resources"].select(F.expr("CASE WHEN doc_id % 10 = 0 THEN concat(split(path, '/')[0], '/../x') WHEN doc_id % 10 = 1 THEN concat(split(path, '/')[0], '/same') ELSE path END AS path")), "in").select("path", "destination", "problem")
)


@query("verify_moves", "SELECT count(*) AS planned, CAST(count_if(doc_id % 7 > 0) AS BIGINT) AS moved, CAST(0 AS BIGINT) AS changed, CAST(count_if(doc_id % 7 = 0) AS BIGINT) AS remaining, 'PARTIAL' AS outcome FROM resources", "resources")
def verify_moves(s: Source):
    """Every seventh file stays where it was."""
    r = s["resources"].select("doc_id", "path", "sha256")
    there = F.when(F.col("doc_id") % 7 > 0, F.concat_ws("/", F.lit("in"), "path")).otherwise(F.col("path"))
    return V.verify_moves(r.withColumn("destination", F.concat_ws("/", F.lit("in"), "path")), r.select(there.alias("path"), "sha256"))


_ALLOWED = ["01_BIO", "02_OPERE", V.UNRESOLVED_FOLDER]
_PROPOSED = """(SELECT doc_id, path AS source_relpath, sha256, CASE doc_id % 8 WHEN 1 THEN '../x' WHEN 2 THEN 'elsewhere' WHEN 3 THEN 'TEMP_IMPORT' WHEN 4 THEN 'TEMP_IMPORT' ELSE '01_BIO' END AS d, CASE doc_id % 8 WHEN 3 THEN 'UNRESOLVED' ELSE 'PROPOSED' END AS st, CASE doc_id % 8 WHEN 5 THEN 'SURE' ELSE 'HIGH' END AS conf, CASE doc_id % 8 WHEN 6 THEN '  ' ELSE ' because ' END AS why FROM resources)"""


def _proposals(s: Source):
    return s["resources"].select(
        "doc_id", F.col("path").alias("source_relpath"), F.expr("CASE doc_id % 8 WHEN 1 THEN '../x' WHEN 2 THEN 'elsewhere' WHEN 3 THEN 'TEMP_IMPORT' WHEN 4 THEN 'TEMP_IMPORT' ELSE '01_BIO' END AS destination_directory"),
        F.expr("CASE doc_id % 8 WHEN 3 THEN 'UNRESOLVED' ELSE 'PROPOSED' END AS status"), F.expr("CASE doc_id % 8 WHEN 5 THEN 'SURE' ELSE 'HIGH' END AS confidence"), F.expr("CASE doc_id % 8 WHEN 6 THEN '  ' ELSE ' because ' END AS reason"),
    )


_SETTLED = f"""(SELECT doc_id, source_relpath, sha256, CASE WHEN bad IS NULL THEN d ELSE 'TEMP_IMPORT' END AS destination_directory, CASE WHEN bad IS NULL THEN st ELSE 'UNRESOLVED' END AS status, CASE WHEN bad IS NULL THEN conf ELSE 'LOW' END AS confidence, coalesce(bad, trim(why)) AS reason
FROM (SELECT *, CASE WHEN doc_id % 8 = 1 THEN 'LLM_DESTINATION_INVALID' WHEN doc_id % 8 IN (2, 4, 5, 6) THEN 'LLM_ITEM_INVALID' END AS bad FROM {_PROPOSED}))"""


def _settled(s: Source):
    return V.settle_proposals(_proposals(s), s["resources"].select(F.col("path").alias("source_relpath"), "sha256"), _ALLOWED)


query("normalize_proposals", f"SELECT source_relpath, destination_directory, destination_directory || '/' || source_relpath AS destination_relpath, status, confidence, reason FROM {_SETTLED}", "resources")(lambda s: _settled(s).drop("sha256"))
query("proposal_faults", "SELECT CASE WHEN doc_id % 9 = 0 THEN 'no/' || path ELSE path END AS source_relpath, CASE WHEN doc_id % 9 = 0 THEN 'UNEXPECTED' ELSE 'DUPLICATE' END AS fault FROM resources WHERE doc_id % 9 IN (0, 1) UNION ALL SELECT path, 'OMITTED' FROM resources WHERE doc_id % 9 = 0", "resources")(
    lambda s: V.proposal_faults(s["resources"].select(F.explode(F.expr("CASE doc_id % 9 WHEN 0 THEN array(concat('no/', path)) WHEN 1 THEN array(path, path) ELSE array(path) END")).alias("source_relpath")), s["resources"].select(F.col("path").alias("source_relpath")))
)


def _items(s: Source):
    at = _settled(s).join(s["resources"].select("path", "doc_id"), F.col("source_relpath") == F.col("path"))
    bent = F.when(F.col("doc_id") % 10 == 1, "x/y").otherwise(F.col("destination_relpath"))
    return at.select(
        F.concat(F.lit("N"), F.lpad((F.col("doc_id") + F.when(F.col("doc_id") % 10 == 2, 1).otherwise(0)).cast("string"), F.greatest(F.lit(4), F.length(F.col("doc_id").cast("string"))), F.lit("0"))).alias("id"), F.col("doc_id").alias("turn"), "source_relpath",
        F.when(F.col("doc_id") % 10 == 3, "short").otherwise(F.col("sha256")).alias("source_sha256"), "destination_directory", bent.alias("destination_relpath"), "status", F.when(F.col("doc_id") % 10 == 4, "SURE").otherwise(F.col("confidence")).alias("confidence"), "reason",
    )


query(
    "plan_faults",
    f"""SELECT 'N' || lpad(CAST(doc_id + CASE WHEN m = 2 THEN 1 ELSE 0 END AS VARCHAR), CAST(greatest(4, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') AS id, fault FROM (SELECT doc_id, doc_id % 10 AS m, CASE WHEN doc_id % 10 = 2 THEN 'id' WHEN doc_id % 10 = 1 AND n > 1 THEN 'duplicate' WHEN doc_id % 10 = 1 THEN 'source path lost' WHEN status = 'UNRESOLVED' AND (doc_id % 10 = 4 OR confidence <> 'LOW') THEN 'unresolved' WHEN doc_id % 10 = 4 THEN 'confidence' WHEN doc_id % 10 = 3 THEN 'sha256' END AS fault
FROM {_SETTLED}, (SELECT count_if(doc_id % 10 = 1) AS n FROM resources)) WHERE fault IS NOT NULL""",
    "resources",
)(lambda s: V.plan_faults(_items(s), _ALLOWED))
query("plan_summary", f"SELECT count(*) AS source_files, CAST(count_if(status = 'PROPOSED') AS BIGINT) AS proposed, CAST(count_if(status = 'UNRESOLVED') AS BIGINT) AS unresolved, CAST(0 AS BIGINT) AS operations_applied FROM {_SETTLED}", "resources")(lambda s: V.plan_summary(_settled(s)))
query("collected_files", "SELECT path, CASE WHEN doc_id % 50 = 0 THEN 'problem: denied' WHEN doc_id % 20 = 3 THEN 'problem: symlink skipped' WHEN doc_id % 7 = 0 THEN 'folder' ELSE 'file' END AS outcome FROM resources", "resources")(
    lambda s: V.collected(s["resources"].select("path", F.expr("CASE WHEN doc_id % 20 = 3 THEN 'link' WHEN doc_id % 7 = 0 THEN 'folder' ELSE 'file' END AS kind"), F.expr("CASE WHEN doc_id % 50 = 0 THEN 'denied' END AS error")))
)
query("stale_properties", "SELECT CAST(doc_id AS VARCHAR) AS page_id, 'lang' AS property, lang AS bundle_value, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'xx' END AS live_value FROM documents WHERE doc_id % 5 < 2 AND doc_id % 3 > 0")(
    lambda s: V.stale_properties(s.t("documents").select(F.expr("CASE WHEN doc_id % 3 > 0 THEN cast(doc_id AS string) END AS page_id"), F.lit("lang").alias("property"), F.col("lang").alias("value")), s.t("documents").select(F.col("doc_id").cast("string").alias("page_id"), F.expr("CASE WHEN doc_id % 5 = 0 THEN 'other' ELSE 'lang' END AS property"), F.expr("CASE WHEN doc_id % 5 = 1 THEN 'xx' ELSE lang END AS value")))
)
query("property_payload", "SELECT doc_id, CASE WHEN lang = 'en' THEN 'select' WHEN lang = 'fr' THEN 'people' END AS kind, CASE WHEN lang = 'en' THEN NULL WHEN lang = 'fr' THEN 'UNSUPPORTED_NOTION_TYPE:people' ELSE 'UNSUPPORTED_NOTION_TYPE:None' END AS skipped FROM documents WHERE doc_id % 3 < 2")(
    lambda s: V.property_payload(s.t("documents").select("doc_id", F.col("lang").alias("property"), F.expr("CASE doc_id % 3 WHEN 0 THEN 'ADD' WHEN 1 THEN 'UPDATE' ELSE 'CONFLICT' END AS action")), s.spark.createDataFrame([("en", "select"), ("fr", "people")], "property string, type string")).select("doc_id", "kind", "skipped")
)
query("markdown_blocks", "SELECT doc_id AS page_id, CAST(unnest([0, 1, 2]) AS INTEGER) AS no, unnest(['heading_2', 'heading_3', 'bulleted_list_item']) AS type, unnest([lang, source, '- ' || CAST(n_chars AS VARCHAR)]) AS content FROM documents")(
    lambda s: V.markdown_blocks(s.t("documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("## "), "lang", F.lit("\n\n### "), "source", F.lit("\n- - "), F.col("n_chars").cast("string"), F.lit("\n \n")).alias("markdown")))
)


query(
    "artifact_availability",
    "SELECT id, stream, CASE WHEN path IS NULL THEN 'not_recorded' WHEN path IN (SELECT 'out/' || CAST(o_custkey % 600 AS VARCHAR) FROM orders) THEN 'available' ELSE 'unavailable' END AS availability FROM (SELECT id, 'stdout' AS stream, stdout_path AS path FROM runs UNION ALL SELECT id, 'stderr', stderr_path FROM runs)",
    "runs",
)(lambda s: V.artifact_availability(s["runs"], s.t("orders").select(F.concat(F.lit("out/"), (F.col("o_custkey") % 600).cast("string")).alias("path"))))
query("retention", "SELECT o_orderkey FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-01-01') > 90")(lambda s: V.expired(s.t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("created_on")), "1998-01-01").select("o_orderkey"))
query("cache_misses", "SELECT doc_id FROM documents d WHERE sha256(CAST(doc_id AS VARCHAR) || '|' || lang || '|' || source) NOT IN (SELECT sha256(CAST(doc_id AS VARCHAR) || '|en|' || source) FROM documents WHERE doc_id % 2 = 0)")(
    lambda s: V.cache_misses(s.t("documents"), s.t("documents").filter("doc_id % 2 = 0").select(F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), F.lit("en"), "source"), 256).alias("cache_key")), ["doc_id", "lang", "source"]).select("doc_id")
)
query("first_per_content", "SELECT sha256, min(doc_id) AS doc_id FROM resources GROUP BY 1", "resources")(lambda s: V.first_per_key(s["resources"], "sha256", "doc_id").select("sha256", "doc_id"))
query("merge_index", "SELECT n.file_id, n.paths, coalesce(o.first_seen, n.first_seen) AS first_seen FROM (SELECT sha256 AS file_id, min(path) AS paths, CAST(2 AS BIGINT) AS first_seen FROM resources GROUP BY 1) n LEFT JOIN (SELECT DISTINCT sha256 AS file_id, CAST(1 AS BIGINT) AS first_seen FROM resources WHERE doc_id % 2 = 0) o USING (file_id)", "resources")(
    lambda s: V.merge_index(s["resources"].select(F.when(F.col("doc_id") % 2 == 0, F.col("sha256")).otherwise("gone").alias("file_id"), F.lit(1).cast("long").alias("first_seen")).distinct(), s["resources"].groupBy(F.col("sha256").alias("file_id")).agg(F.min("path").alias("paths"), F.lit(2).cast("long").alias("first_seen")))
)
query("legacy_counts", "SELECT a.source AS domain, a.lang AS extension, a.n, a.n - coalesce(b.n, 0) AS change FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2) a LEFT JOIN (SELECT source, lang, count(*) AS n FROM documents WHERE doc_id % 3 = 0 GROUP BY 1, 2) b ON a.source = b.source AND a.lang = b.lang")(
    lambda s: V.legacy_counts(s.t("documents").select(F.col("source").alias("domain"), F.col("lang").alias("extension")), s.t("documents").filter("doc_id % 3 = 0").groupBy(F.col("source").alias("domain"), F.col("lang").alias("extension")).agg(F.count("*").alias("n")))
)

# ledgers
_seq = "SELECT run_id, seq + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS seq, event_id FROM ledger"
query("ledger_sequence", f"SELECT run_id, seq, expected FROM (SELECT *, CAST(row_number() OVER (PARTITION BY run_id ORDER BY seq, event_id) AS BIGINT) AS expected FROM ({_seq})) WHERE seq <> expected", "ledger")(
    lambda s: L.sequence_faults(s["ledger"].withColumn("seq", F.col("seq") + F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)))
)
_STATE = "CASE {} " + " ".join(f"WHEN '{e}' THEN '{v}'" for e, v in {**L.RUN_STATES, **L.STAGE_STATES}.items()) + " END"
_EVENTS = ", ".join(f"'{e}'" for e in L.RUN_STATES)
_ALLOWED_STEPS = ", ".join(f"'{a or ''}>{e}'" for a, e in L.RUN_TRANSITIONS)
_VIOLATIONS = f"SELECT run_id, min(seq) AS first_violation_seq FROM (SELECT *, {_STATE.format('lag(event_type) OVER (PARTITION BY run_id ORDER BY seq)')} AS before FROM ledger WHERE event_type IN ({_EVENTS})) WHERE coalesce(before, '') || '>' || event_type NOT IN ({_ALLOWED_STEPS}) GROUP BY run_id"
query("fsm_violations", _VIOLATIONS, "ledger")(lambda s: L.fsm_violations(s["ledger"]))
_RUN_STATE = f"SELECT run_id, {_STATE.format('arg_max(event_type, seq)')} AS state, max(seq) AS last_seq FROM ledger WHERE event_type IN ({_EVENTS}) GROUP BY run_id"
query("run_state", _RUN_STATE, "ledger")(lambda s: L.run_state(s["ledger"]))
query(
    "recovery_class",
    f"SELECT r.run_id, CASE WHEN r.run_id % 10 = 7 THEN 'RUNNING' WHEN v.run_id IS NOT NULL THEN 'LEDGER_CORRUPT' WHEN state IN ('CREATED', 'RUNNING') THEN 'INTERRUPTED' ELSE state END AS canonical_state, CASE WHEN r.run_id % 10 = 7 OR v.run_id IS NOT NULL THEN 'DO_NOT_RESUME' WHEN state IN ('COMPLETED', 'ABORTED') THEN 'NO_ACTION' WHEN r.run_id % 3 = 0 THEN 'RESUME_AVAILABLE' ELSE 'FINALIZE_AVAILABLE' END AS action FROM ({_RUN_STATE}) r LEFT JOIN ({_VIOLATIONS}) v ON r.run_id = v.run_id",
    "ledger",
)(
    lambda s: (lambda e: L.recovery_class(L.run_state(e), L.fsm_violations(e), e.select(F.when(F.col("run_id") % 10 == 7, F.col("run_id")).alias("run_id")), e.select(F.when(F.col("run_id") % 3 == 0, F.col("run_id")).alias("run_id"))))(s["ledger"])
)
_STAGE_KIND = "CASE event_type WHEN 'signup' THEN 'STAGE_STARTED' WHEN 'view' THEN 'STAGE_COMPLETED' WHEN 'click' THEN 'STAGE_FAILED' WHEN 'error' THEN 'STAGE_RESTARTED' ELSE CASE WHEN event_id % 2 = 0 THEN 'STAGE_SKIPPED' ELSE 'HUMAN_DECISION' END END"
_STAGE_EVENTS = f"(SELECT event_id // 6 AS run_id, event_id % 6 + 1 AS seq, CASE WHEN event_id % 60 = 5 THEN '' ELSE 'stage ' || CAST(event_id % 2 AS VARCHAR) END AS stage, CASE WHEN event_id % 6 < 2 THEN 'STAGE_STARTED' ELSE {_STAGE_KIND} END AS event_type FROM events)"


def _stage_events(s: Source):
    return s.t("events").select(
        F.floor(F.col("event_id") / 6).alias("run_id"), (F.col("event_id") % 6 + 1).alias("seq"), F.expr("CASE WHEN event_id % 60 = 5 THEN '' ELSE concat('stage ', event_id % 2) END AS stage"),
        F.expr(f"CASE WHEN event_id % 6 < 2 THEN 'STAGE_STARTED' ELSE {_STAGE_KIND} END AS event_type"),
    )


_STAGE_STEPS = ", ".join(f"'{a or ''}>{e}'" for a, e in L.STAGE_TRANSITIONS)
_STAGE_ONLY = ", ".join(f"'{e}'" for e in L.STAGE_STATES)
query(
    "stage_fsm_violations",
    f"SELECT run_id, stage, min(seq) AS first_violation_seq FROM (SELECT *, {_STATE.format('lag(event_type) OVER (PARTITION BY run_id, stage ORDER BY seq)')} AS before FROM {_STAGE_EVENTS} WHERE event_type IN ({_STAGE_ONLY})) WHERE stage = '' OR coalesce(before, '') || '>' || event_type NOT IN ({_STAGE_STEPS}) GROUP BY run_id, stage",
)(lambda s: L.stage_violations(_stage_events(s)))
query("stage_states", f"SELECT run_id, stage, {_STATE.format('arg_max(event_type, seq)')} AS state FROM {_STAGE_EVENTS} WHERE event_type IN ({_STAGE_ONLY}) GROUP BY run_id, stage")(lambda s: L.stage_states(_stage_events(s)))
query(
    "event_faults",
    "SELECT event_id // 4 AS run_id, seq, fault FROM (SELECT event_id, event_id % 4 + 1 + CASE WHEN event_id % 32 = 3 THEN 5 ELSE 0 END AS seq, CASE WHEN event_id % 29 = 0 THEN 'schema' WHEN event_id % 32 = 3 THEN 'seq' WHEN event_id % 23 = 0 THEN 'actor' WHEN event_id % 19 = 0 THEN 'event_type' WHEN event_id % 17 = 0 AND event_id % 34 > 0 THEN 'component' END AS fault FROM events) WHERE fault IS NOT NULL",
)(
    lambda s: L.event_faults(
        s.t("events").select(F.floor(F.col("event_id") / 4).alias("run_id"), (F.col("event_id") % 4 + 1 + F.when(F.col("event_id") % 32 == 3, 5).otherwise(0)).alias("seq"), "event_id", F.expr("CASE WHEN event_id % 29 = 0 THEN 'v0' ELSE 'v1' END AS schema"),
            F.expr("CASE WHEN event_id % 23 = 0 THEN 'nobody' ELSE 'worker' END AS actor"), F.expr("CASE WHEN event_id % 19 = 0 THEN 'RUN_LOST' ELSE 'RUN_STARTED' END AS event_type"), F.expr("CASE WHEN event_id % 17 = 0 THEN named_struct('git_dirty', true, 'source_hash', CASE WHEN event_id % 34 = 0 THEN 'h' END) END AS component")), "v1", ("worker",),
    )
)
_QUEUE_KIND = "CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 33 = 0 THEN 'lost' ELSE 'new' END WHEN event_id % 3 = 1 THEN CASE WHEN event_type = 'error' THEN 'approved' ELSE 'processing' END WHEN event_type = 'view' THEN 'classified' WHEN event_type = 'click' THEN 'failed' WHEN event_type = 'error' THEN 'archived' ELSE 'retryable_error' END"
_QUEUE = f"(SELECT event_id // 3 AS item, event_id % 3 + 1 AS seq, {_QUEUE_KIND} AS state, CASE WHEN event_id % 5 > 1 AND event_id % 3 = 2 OR event_id % 31 = 0 THEN 'broke' END AS error, CASE WHEN event_id % 37 = 0 THEN 1.5 ELSE value / 1000 END AS confidence, CASE WHEN event_id % 2 = 0 THEN 'a/b' END AS destination FROM events)"
query(
    "queue_fsm_violations",
    f"SELECT item, seq, fault FROM (SELECT item, seq, CASE WHEN state = 'lost' THEN 'state' WHEN coalesce(before, '') || '>' || state NOT IN ({', '.join(repr((a or '') + '>' + b) for a, b in L.QUEUE_TRANSITIONS)}) THEN 'transition' WHEN state IN ('failed', 'retryable_error') THEN CASE WHEN error IS NULL THEN 'error missing' WHEN confidence NOT BETWEEN 0 AND 1 THEN 'confidence' END WHEN error IS NOT NULL THEN 'error' WHEN confidence NOT BETWEEN 0 AND 1 THEN 'confidence' WHEN state IN ('approved', 'archived') AND destination IS NULL THEN 'destination' END AS fault FROM (SELECT *, lag(state) OVER (PARTITION BY item ORDER BY seq) AS before FROM {_QUEUE})) WHERE fault IS NOT NULL",
)(
    lambda s: L.queue_violations(s.t("events").select(F.floor(F.col("event_id") / 3).alias("item"), (F.col("event_id") % 3 + 1).alias("seq"), F.expr(f"{_QUEUE_KIND} AS state"), F.expr("CASE WHEN event_id % 5 > 1 AND event_id % 3 = 2 OR event_id % 31 = 0 THEN 'broke' END AS error"), F.expr("CASE WHEN event_id % 37 = 0 THEN 1.5D ELSE value / 1000 END AS confidence"), F.expr("CASE WHEN event_id % 2 = 0 THEN 'a/b' END AS destination")))
)


def _stages(s: Source):
    status = F.when(F.col("l_returnflag") == "N", "COMPLETED").when(F.col("l_returnflag") == "A", "SKIPPED").otherwise("FAILED")
    return s.t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"), F.min("l_quantity").alias("q")).select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").cast("long").alias("idx"), F.concat(F.lit("stage "), F.col("l_linenumber").cast("string")).alias("stage"), status.alias("status"), (F.col("q") > 5).alias("valid"),
    )


_STAGES = "(SELECT l_orderkey AS run_id, CAST(l_linenumber AS BIGINT) AS idx, 'stage ' || CAST(l_linenumber AS VARCHAR) AS stage, CASE min(l_returnflag) WHEN 'N' THEN 'COMPLETED' WHEN 'A' THEN 'SKIPPED' ELSE 'FAILED' END AS status, min(l_quantity) > 5 AS valid FROM lineitem GROUP BY l_orderkey, l_linenumber)"
query("stage_projection", f"SELECT run_id, arg_max(stage, idx) FILTER (WHERE status <> 'FAILED') AS last_completed, arg_min(stage, idx) FILTER (WHERE status = 'FAILED') AS current_stage FROM {_STAGES} GROUP BY run_id")(lambda s: L.stage_projection(_stages(s)))
query("resume_point", f"SELECT run_id, min(idx) AS resume_idx FROM {_STAGES} WHERE status = 'FAILED' OR NOT valid GROUP BY run_id")(lambda s: L.resume_point(_stages(s)))
query("checkpoint_failures", "SELECT doc_id AS checkpoint, path, CASE WHEN doc_id % 6 = 0 THEN 'FILE_MISSING' WHEN doc_id % 6 = 1 THEN 'SIZE_MISMATCH' ELSE 'HASH_MISMATCH' END AS failure FROM resources WHERE doc_id % 6 < 3", "resources")(
    lambda s: L.checkpoint_failures(s["resources"].select(F.col("doc_id").alias("checkpoint"), "path", F.col("size_bytes").alias("size"), "sha256"), s["resources"].filter("doc_id % 6 > 0").select("path", F.expr("size_bytes + CASE WHEN doc_id % 6 = 1 THEN 1 ELSE 0 END AS size"), F.expr("CASE WHEN doc_id % 6 = 2 THEN 'x' ELSE sha256 END AS sha256")))
)
_CHAIN = "(SELECT who, sequence, event_type, CASE WHEN id % 101 = 0 THEN 'bad' ELSE sha256(CAST(id AS VARCHAR)) END AS previous_hash, id FROM (SELECT user_id AS who, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS sequence, event_type, event_id AS id FROM events))"


@query("hash_chain", f"SELECT who, sequence, CASE WHEN previous_hash <> lag(record_hash, 1, repeat('0', 64)) OVER (PARTITION BY who ORDER BY sequence) THEN 'previous_hash' ELSE 'ok' END AS fault FROM (SELECT *, sha256(previous_hash || '|' || event_type) AS record_hash FROM {_CHAIN}) QUALIFY fault <> 'ok'")
def hash_chain(s: Source):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    e = s.t("events").select(F.col("user_id").alias("who"), F.row_number().over(w).cast("long").alias("sequence"), "event_type", F.expr("CASE WHEN event_id % 101 = 0 THEN 'bad' ELSE sha2(cast(event_id AS string), 256) END AS previous_hash"))
    e = e.withColumn("record_hash", F.sha2(F.concat_ws("|", "previous_hash", "event_type"), 256))
    return L.chain_faults(e, ["who"], ["event_type"])


query("freshness", "SELECT service, ended_at, CASE WHEN status <> 'OK' OR ended_at + INTERVAL 1 DAY < TIMESTAMP '2024-01-15 00:00:00' THEN 'DEGRADED' ELSE 'PASS' END AS classification FROM (SELECT event_type || CAST(user_id % 7 AS VARCHAR) AS service, ts AS ended_at, CASE WHEN value < 40 THEN 'OK' ELSE 'ERROR' END AS status, row_number() OVER (PARTITION BY event_type || CAST(user_id % 7 AS VARCHAR) ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1")(
    lambda s: L.freshness(_ops(s), "2024-01-15 00:00:00", 86400)
)


def _ops(s: Source):
    return s.t("events").select(
        F.concat("event_type", (F.col("user_id") % 7).cast("string")).alias("service"), F.col("ts").alias("ended_at"), F.when(F.col("value") < 40, "OK").otherwise("ERROR").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("fresh_until"), F.col("event_id").alias("ord"),
    )


query("overall_state", "SELECT CASE WHEN bool_or(value >= 40) THEN 'degraded' ELSE 'ready' END AS state FROM events")(lambda s: L.overall_state(s.t("events").select(F.when(F.col("value") >= 40, "DEGRADED").otherwise("PASS").alias("classification"))))
query("status_pivot", "SELECT service_oid, CAST(count_if(status = 'OK') AS BIGINT) AS n_ok, CAST(count_if(status = 'ERROR') AS BIGINT) AS n_error, CAST(count_if(status = 'CANCELLED') AS BIGINT) AS n_cancelled FROM runs GROUP BY 1", "runs")(lambda s: L.status_pivot(s["runs"], "service_oid", "status", ["OK", "ERROR", "CANCELLED"]))
_ID = "'{}-' || md5(CAST(id AS VARCHAR))"
query(
    "record_violations",
    f"SELECT CASE WHEN id % 10 = 5 THEN 'R' ELSE {_ID.format('RUN')} END AS run_id, reason FROM (SELECT id, CASE WHEN id % 13 = 0 THEN 'fields' WHEN id % 17 = 0 THEN 'schema_version' WHEN status = 'CANCELLED' AND id % 3 = 0 THEN 'status or error code' WHEN id % 10 = 5 THEN 'run_id' WHEN id % 10 = 6 THEN 'correlation_id' WHEN id % 19 = 0 THEN 'summary' END AS reason FROM runs) WHERE reason IS NOT NULL",
    "runs",
)(lambda s: L.record_violations(_records(s)))


def _records(s: Source):
    ident = F.md5(F.col("id").cast("string"))
    return s["runs"].select(
        F.when(F.col("id") % 17 == 0, 2).otherwise(1).alias("schema_version"), F.when(F.col("id") % 10 == 5, "R").otherwise(F.concat(F.lit("RUN-"), ident)).alias("run_id"), F.when(F.col("id") % 10 == 6, F.upper(ident)).otherwise(F.concat(F.lit("COR-"), ident)).alias("correlation_id"),
        F.lit("backup").alias("service"), F.when((F.col("status") == "CANCELLED") & (F.col("id") % 3 == 0), "LOST").otherwise(F.col("status")).alias("status"), F.lit("none").alias("error_code"), F.col("run_at").alias("started_at"), F.col("run_at").alias("ended_at"), F.col("run_at").alias("fresh_until"),
        F.when(F.col("id") % 13 > 0, 0).alias("return_code"), F.array(F.lit("run")).alias("command"), F.when(F.col("id") % 19 == 0, F.repeat(F.lit("x"), 4097)).otherwise("fine").alias("summary"), F.array().cast("array<string>").alias("artifacts"), F.lit("RUNBOOK-NONE").alias("runbook"),
    )


from tessera.operators import signals as G  # noqa: E402

query("pipeline_roll_up", "SELECT source, count(*) AS n, CAST(count_if(n_chars < 1000) AS BIGINT) AS attention FROM documents GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*), CAST(count_if(n_chars < 1000) AS BIGINT) FROM documents")(
    lambda s: G.roll_up(s.t("documents").select("source", F.when(F.col("n_chars") < 1000, "FAILED").otherwise("SUCCESS").alias("status")), "source", "status", ["FAILED"])
)
query("backup_freshness", "SELECT event_type AS name, max(ts) FILTER (WHERE value < 10) AS created_at, CASE WHEN max(ts) FILTER (WHERE value < 10) IS NULL OR max(ts) FILTER (WHERE value < 10) + INTERVAL 900 SECOND < TIMESTAMP '2024-01-15 00:00:00' THEN 'DEGRADED' ELSE 'PASS' END AS classification FROM events GROUP BY 1")(
    lambda s: G.backup_freshness(s.t("events").select(F.col("event_type").alias("name"), F.col("ts").alias("created_at"), (F.col("value") < 10).alias("verified")), "2024-01-15 00:00:00", 900)
)
query(
    "chunk_aggregate",
    """SELECT user_id AS file_id, bool_or(value > 30) AS present, round(max(value), 6) AS p_max, bool_or(event_type = 'view') AS phrase_any,
arg_max(props, (CASE WHEN event_type = 'view' THEN 1 ELSE 0 END, value, -event_id)) FILTER (WHERE value > 30) AS excerpt, any_value(d) AS domain, any_value(votes) AS votes, count(*) AS chunks
FROM events JOIN (SELECT user_id AS u, arg_min(event_type, (-n, event_type)) AS d, max(n) AS votes FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1) ON u = user_id GROUP BY 1""",
)(lambda s: G.aggregate_chunks(s.t("events").select(F.col("user_id").alias("file_id"), F.col("event_id").alias("chunk"), (F.col("value") > 30).alias("positive"), F.col("value").alias("p"), (F.col("event_type") == "view").alias("phrase"), F.col("props").alias("excerpt"), F.col("event_type").alias("domain"))).withColumn("p_max", F.round("p_max", 6)))
query(
    "template_gate",
    "SELECT doc_id, CASE WHEN strpos(lower(text), 'licensed under') BETWEEN 1 AND 2001 THEN 'license' WHEN strpos(lower(text), 'the') BETWEEN 1 AND 21 OR source LIKE '%9%' THEN 'english' ELSE 'generic' END AS template FROM documents",
)(lambda s: s.t("documents").select("doc_id", G.template(F.col("text"), F.col("source"), F.lit(False), [("license", "licensed under", 2000, ""), ("english", "the", 20, "9")]).alias("template")))
query("signals_to_claims", "SELECT file_id, 'mentions_deadline' AS predicate, excerpt AS object_raw, 'SUPPORTED_BY_ARCHIVE' AS status FROM (SELECT CAST(event_id AS VARCHAR) AS file_id, CASE WHEN event_id % 7 > 0 THEN props END AS excerpt FROM events WHERE event_type <> 'error' AND value > 30) WHERE excerpt IS NOT NULL")(
    lambda s: G.signals_to_claims(s.t("events").select(F.col("event_id").cast("string").alias("file_id"), F.expr("CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS signal_status"), (F.col("value") > 30).alias("present"), F.expr("CASE WHEN event_id % 7 > 0 THEN props END AS excerpt")), "mentions_deadline").select("file_id", "predicate", "object_raw", "status")
)
