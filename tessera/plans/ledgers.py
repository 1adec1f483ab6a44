"""Queries of checkpoints, backups and typed page properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import properties as P
from tessera.operators import inventory as V
from tessera.operators import ledger as L
from tessera.operators import signals as G
from tessera.scratch import materialize

from .adapters import Source
from .inventory import query

#: Orders are runs and their lines stages: N completed, A skipped, R failed or still running; the seventh isn't requested.
#: A stage reads its part and writes its supplier and the next part; some parts aren't registered, not there or changed.
_STAGES = "(SELECT l_orderkey AS run_id, l_linenumber AS n, min(l_partkey) AS p, min(l_suppkey) AS k, min(l_returnflag) AS f FROM lineitem GROUP BY 1, 2)"


def _why(x: str, role: str) -> str:
    why = f"CASE WHEN {x} % 7 = 0 OR {x} NOT IN (SELECT p_partkey FROM part) THEN 'NOT_REGISTERED' WHEN {x} % 9 = 0 THEN 'FILE_MISSING' WHEN {x} % 5 = 0 THEN 'SIZE_MISMATCH' WHEN {x} % 6 = 0 THEN 'HASH_MISMATCH' END"
    return f"CASE WHEN f = 'N' THEN '{role}_' || {why} || ':P' || CAST({x} AS VARCHAR) END"


@query(
    "checkpoints",
    f"""SELECT *, failed_conditions = '' AS valid FROM (SELECT s.run_id, 'S' || CAST(s.n AS VARCHAR) AS stage, 'cp_s' || CAST(s.n AS VARCHAR) || CASE WHEN f = 'A' THEN '_skipped' ELSE '_complete' END AS checkpoint_id,
CASE WHEN f = 'A' THEN 'SKIPPED' WHEN f = 'N' THEN 'COMPLETED' WHEN p % 2 = 0 THEN 'FAILED' ELSE 'RUNNING' END AS stage_state,
CAST(CASE WHEN f = 'R' THEN 0 ELSE 2 * s.n END AS BIGINT) AS derived_from_seq, r.later AS resume_from,
CASE WHEN f = 'N' THEN 'P' || CAST(p AS VARCHAR) ELSE '' END AS inputs, CASE WHEN f = 'N' THEN 'K' || CAST(k AS VARCHAR) || ',P' || CAST(p + 1 AS VARCHAR) ELSE '' END AS outputs,
concat_ws('|', CASE WHEN s.n = 7 THEN 'STAGE_NOT_REQUESTED' END, CASE WHEN f = 'R' THEN 'STAGE_NOT_COMPLETED' END, CASE WHEN f = 'N' AND p % 11 = 0 THEN 'COMPONENT_FINGERPRINT_MISSING' END, {_why("p", "INPUT")}, {_why("(p + 1)", "OUTPUT")}) AS failed_conditions
FROM {_STAGES} s LEFT JOIN (SELECT run_id, n, 'S' || CAST(lead(n) OVER (PARTITION BY run_id ORDER BY n) AS VARCHAR) AS later FROM {_STAGES} WHERE n < 7) r ON s.run_id = r.run_id AND s.n = r.n)""",
)
def checkpoints(s: Source):
    lines = s.t("lineitem").groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("n")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("k"), F.min("l_returnflag").alias("f"))
    lines = materialize(lines, "lines")  # read for stages, events and artifacts
    lines = lines.withColumn("stage", F.concat(F.lit("S"), F.col("n").cast("string")))
    part = lambda c: F.concat(F.lit("P"), c.cast("string"))
    first = F.when(F.col("f") == "A", "STAGE_SKIPPED").otherwise("STAGE_STARTED")
    then = F.when(F.col("f") == "N", "STAGE_COMPLETED").when((F.col("f") == "R") & (F.col("p") % 2 == 0), "STAGE_FAILED")
    component = F.struct(F.when(F.col("p") % 11 > 0, "engine").alias("name"))
    outputs = F.array(F.concat(F.lit("K"), F.col("k").cast("string")), part(F.col("p") + 1))
    event = lambda no, kind: F.struct((F.col("n") * 2 - 1 + no).alias("seq"), kind.alias("event_type"), component.alias("component"), F.array(part(F.col("p"))).alias("input_artifacts"), outputs.alias("output_artifacts"))
    skip = F.when(F.col("f") == "A", 1).otherwise(0)
    events = lines.select("run_id", "stage", F.explode(F.array(event(skip, first), event(F.lit(1), then))).alias("e")).select("run_id", "stage", "e.*").filter("event_type IS NOT NULL")

    parts = s.t("part").select(F.col("p_partkey").alias("x"), F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("path"), F.col("p_size").cast("long").alias("size"), F.sha2("p_name", 256).alias("sha256"))
    suppliers = s.t("supplier").select(F.col("s_suppkey").alias("x"), F.concat(F.lit("supplier/"), F.col("s_suppkey").cast("string")).alias("path"), F.lit(1).cast("long").alias("size"), F.sha2("s_name", 256).alias("sha256"))
    own = lines.select("run_id", F.explode(F.array("p", F.col("p") + 1)).alias("x")).join(parts, "x").filter("x % 7 > 0")
    own = own.select("run_id", part(F.col("x")).alias("artifact_id"), "path", (F.col("size") + F.when(F.col("x") % 5 == 0, 1).otherwise(0)).alias("size"), F.when(F.col("x") % 6 == 0, "changed").otherwise(F.col("sha256")).alias("sha256"))
    made = lines.select("run_id", F.col("k").alias("x")).join(suppliers, "x").select("run_id", F.concat(F.lit("K"), F.col("x").cast("string")).alias("artifact_id"), "path", "size", "sha256")
    listing = parts.filter("x % 9 > 0").unionByName(suppliers).drop("x")
    out = L.checkpoints(lines.filter("n < 7").select("run_id", F.col("n").alias("idx"), "stage"), events, own.unionByName(made), listing, lines.select("run_id", "stage"))
    lists = {n: F.array_join(c, d) for n, c, d in (("inputs", "input_artifacts", ","), ("outputs", "output_artifacts", ","), ("failed_conditions", "failed_conditions", "|"))}
    return out.withColumns(lists).drop("input_artifacts", "output_artifacts")


_BACKUPS = "(SELECT user_id % 100 AS name, event_id % 3 < 2 AS made, value < 20 AS verified, ts AS t, event_id, event_id % 5 > 0 AS fit FROM events)"
_AGE = "date_diff('microsecond', {}, TIMESTAMP '2024-01-31 00:00:00') / 1e6"
query(
    "backup_health",
    f"""SELECT name, CASE WHEN b IS NULL OR {_AGE.format("b.t")} > 1000000 OR NOT b.fit THEN 'FAIL' WHEN r IS NULL OR {_AGE.format("r")} / 86400 > 10 THEN 'DEGRADED' ELSE 'PASS' END AS classification, CAST(b.event_id AS VARCHAR) AS latest_backup,
CAST(trunc({_AGE.format("b.t")}) AS BIGINT) AS backup_age, CAST(trunc({_AGE.format("r")} / 86400) AS BIGINT) AS restore_days
FROM (SELECT name, max({{'t': t, 'event_id': event_id, 'fit': fit}}) FILTER (WHERE made AND verified) AS b, max(t) FILTER (WHERE NOT made AND verified) AS r FROM {_BACKUPS} GROUP BY name)""",
)(
    lambda s: G.backup_health(
        s.t("events").select((F.col("user_id") % 100).alias("name"), F.when(F.col("event_id") % 3 < 2, "backup.create").otherwise("restore.check").alias("action"), F.when(F.col("value") < 20, "verified").otherwise("failed").alias("outcome"), F.col("ts").alias("at"), F.col("event_id").alias("backup_id"), (F.col("event_id") % 5 > 0).alias("fit")),
        "2024-01-31 00:00:00", 1000000, 10,
    ).select("name", "classification", F.col("latest_backup").cast("string").alias("latest_backup"), "backup_age", F.col("restore_age").cast("long").alias("restore_days"))
)

#: Each document sets one property of its source's page, whose type goes by its id; the ninth type can't be written.
_KINDS = (*P.WRITABLE, "people")
_VALUE = """CASE doc_id % 9 WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN CASE WHEN doc_id % 4 = 0 THEN 'many' ELSE CAST(doc_id AS {string}) || '.5' END WHEN 3 THEN source
WHEN 4 THEN source || ', ' || lang || ' / more' WHEN 5 THEN '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS {string}), 2, '0') WHEN 6 THEN 'https://example.org/' || CAST(doc_id AS {string}) WHEN 7 THEN CASE WHEN doc_id % 2 = 0 THEN ' TRUE' ELSE 'no' END ELSE lang END"""
_TYPED = f"(SELECT doc_id, source, lang, [{', '.join(repr(k) for k in _KINDS)}][doc_id % 9 + 1] AS kind, {_VALUE.format(string='VARCHAR')} AS value FROM documents)"
_ODD = "(kind = 'people' OR kind = 'number' AND value = 'many')"


def _operations(s: Source):
    kind = F.get(F.array(*map(F.lit, _KINDS)), (F.col("doc_id") % 9).cast("int"))
    d = s.t("documents").select("doc_id", "source", kind.alias("property"), F.expr(_VALUE.format(string="STRING")).alias("value"), F.when(F.col("doc_id") % 2 == 0, "ADD").otherwise("UPDATE").alias("action"))
    schema = s.spark.createDataFrame([(k, k) for k in _KINDS], "property string, type string")
    return V.property_payload(d.withColumn("page_id", F.coalesce("source", F.lit(""))), schema)


_CASES = """CASE kind WHEN 'title' THEN CAST(json_object('title', json_array(json_object('type', 'text', 'text', json_object('content', value)))) AS VARCHAR)
WHEN 'rich_text' THEN CAST(json_object('rich_text', json_array(json_object('type', 'text', 'text', json_object('content', value)))) AS VARCHAR)
WHEN 'number' THEN '{"number":' || value || '}' WHEN 'select' THEN '{"select":{"name":"' || value || '"}}'
WHEN 'multi_select' THEN '{"multi_select":[{"name":"' || source || '"},{"name":"' || lang || '"},{"name":"more"}]}'
WHEN 'date' THEN '{"date":{"start":"' || value || '"}}' WHEN 'url' THEN '{"url":"' || value || '"}' WHEN 'checkbox' THEN CASE WHEN value = 'no' THEN '{"checkbox":false}' ELSE '{"checkbox":true}' END END"""
query("payload_json", f"SELECT doc_id, CASE WHEN NOT {_ODD} THEN {_CASES} END AS payload, CASE WHEN kind = 'people' THEN 'UNSUPPORTED_NOTION_TYPE:people' WHEN {_ODD} THEN 'INVALID_VALUE:number' END AS skipped FROM {_TYPED}")(lambda s: _operations(s).select("doc_id", "payload", "skipped"))
#: What was written is read back: the SQL knows the values, not the JSON.
query("payload_round_trip", f"SELECT doc_id, CASE kind WHEN 'checkbox' THEN CASE WHEN value = 'no' THEN 'false' ELSE 'true' END WHEN 'multi_select' THEN source || ', ' || lang || ', more' ELSE value END AS value FROM {_TYPED} WHERE NOT {_ODD}")(
    lambda s: _operations(s).filter("skipped IS NULL").select("doc_id", P.decoded_text(P.typed(F.col("kind"), F.col("payload"))).alias("value"))
)
query("page_payloads", f"SELECT page_id, '{{' || string_agg('\"' || kind || '\":' || payload, ',' ORDER BY kind) || '}}' AS properties FROM (SELECT coalesce(source, '') AS page_id, kind, {_CASES} AS payload FROM {_TYPED} WHERE NOT {_ODD} QUALIFY row_number() OVER (PARTITION BY coalesce(source, ''), kind ORDER BY doc_id DESC) = 1) GROUP BY 1")(
    lambda s: V.page_payloads(_operations(s), "doc_id")
)
