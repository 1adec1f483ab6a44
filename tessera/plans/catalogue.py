"""Catalogue, integrity and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import catalogue as C
from tessera.operators import integrity as I

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


for _n, _t, _k in (("objects_by_type", "objects", "type"), ("objects_by_status", "objects", "status"), ("relations_by_type", "relations", "relation_type"), ("events_by_type", "log", "event_type"), ("resources_by_status", "resources", "status"), ("runs_by_status", "runs", "status")):
    query(_n, f"SELECT {_k}, count(*) AS n FROM {_t} GROUP BY {_k}", _t)(lambda s, t=_t, k=_k: C.count_by(s[t], k))

query("objects_list", "SELECT * FROM objects ORDER BY oid", "objects")(lambda s: s["objects"].orderBy("oid"))
query("object_get", "SELECT * FROM objects WHERE oid = 'PER-000007'", "objects")(lambda s: C.lookup(s["objects"], "oid", "PER-000007"))
query("relations_list", "SELECT * FROM relations ORDER BY id", "relations")(lambda s: s["relations"].orderBy("id"))
query("relations_of", "SELECT * FROM relations WHERE source_oid = 'SYS-000003' OR target_oid = 'SYS-000003'", "relations")(lambda s: C.relations_of(s["relations"], "SYS-000003"))
query("resources_list", "SELECT resource_oid, path, filename, extension, size_bytes, status FROM resources", "resources")(lambda s: s["resources"].select("resource_oid", "path", "filename", "extension", "size_bytes", "status"))
query("queue_list", "SELECT * FROM queue ORDER BY import_id DESC", "queue")(lambda s: s["queue"].orderBy(F.desc("import_id")))
query("queue_pending", "SELECT import_id, source_path FROM queue WHERE status = 'pending' OR review_status = 'pending_review'", "queue")(lambda s: C.pending(s["queue"]).select("import_id", "source_path"))
query("queue_pending_count", "SELECT count(*) AS n FROM queue WHERE status = 'pending' OR review_status = 'pending_review'", "queue")(lambda s: C.pending(s["queue"]).agg(F.count("*").alias("n")))
query("service_runs", "SELECT 'service' AS source, id AS run_id, service_oid, run_at, status FROM runs", "runs")(lambda s: s["runs"].select(F.lit("service").alias("source"), F.col("id").alias("run_id"), "service_oid", "run_at", "status"))
query("events_of_object", "SELECT id, event_at, event_type, description FROM log WHERE oid = 'PER-000011'", "log")(lambda s: C.events_of(s["log"], "PER-000011").select("id", "event_at", "event_type", "description"))

TIMELINE = "SELECT log.id, log.oid, o.type AS object_type, o.name AS object_name, event_at, event_type, description FROM log LEFT JOIN objects o ON log.oid = o.oid"
_columns = ["id", "oid", "object_type", "object_name", "event_at", "event_type", "description"]
query("timeline_view", TIMELINE, "log", "objects")(lambda s: C.timeline_view(s["log"], s["objects"]).select(*_columns))


@query("timeline_latest", TIMELINE + " ORDER BY event_at DESC, id DESC LIMIT 10", "log", "objects")
def timeline_latest(s: Source):
    # the latest rows first, so the join sees ten
    return C.timeline_view(C.latest(s["log"], 10), s["objects"]).select(*_columns)


query("relation_view", "SELECT r.id, relation_type, source_oid, a.name AS source_name, target_oid, b.name AS target_name FROM relations r LEFT JOIN objects a ON source_oid = a.oid LEFT JOIN objects b ON target_oid = b.oid", "relations", "objects")(
    lambda s: C.relation_view(s["relations"], s["objects"]).select("id", "relation_type", "source_oid", "source_name", "target_oid", "target_name")
)
query("resource_view", "SELECT resource_oid, path, o.name AS object_name, r.status FROM resources r LEFT JOIN objects o ON resource_oid = o.oid", "resources", "objects")(lambda s: C.resource_view(s["resources"].drop("sha256"), s["objects"]).select("resource_oid", "path", "object_name", "status"))
query("service_registry", "SELECT service_oid, o.name AS service_name, count(*) AS n, max(run_at) AS last_run FROM runs JOIN objects o ON service_oid = o.oid WHERE o.type = 'Service' GROUP BY 1, 2", "runs", "objects")(
    lambda s: s["runs"].groupBy("service_oid").agg(F.count("*").alias("n"), F.max("run_at").alias("last_run")).join(s["objects"].filter("type = 'Service'").select(F.col("oid").alias("service_oid"), F.col("name").alias("service_name")), "service_oid")
)


def _search_sql(q: str) -> str:
    def section(no, kind, ident, name, fields, table):
        hit = " ".join(f"WHEN instr(lower(coalesce({f}, '')), '{q}') > 0 THEN '{f}:' || coalesce({f}, '')" for f in fields)
        return f"SELECT {no} AS section, '{kind}' AS kind, CAST({ident} AS VARCHAR) AS ident, {name} AS name, CASE {hit} END AS detail FROM {table}"

    parts = [
        section(1, "object", "oid", "name", ["oid", "type", "name", "status"], "objects"),
        section(2, "resource", "resource_oid", "filename", ["filename", "path", "extension", "status"], "resources"),
        section(3, "event", "id", "event_type", ["event_type", "description", "oid"], "log"),
        section(4, "relation", "id", "source_oid || '->' || target_oid", ["relation_type", "source_oid", "target_oid"], "relations"),
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE detail IS NOT NULL"


for _n, _q in (("search", "sign"), ("search_oid", "000012"), ("search_relation", "part_of")):
    query("catalog_" + _n, _search_sql(_q), "objects", "resources", "log", "relations")(lambda s, q=_q: C.search(s["objects"], s["resources"].drop("sha256"), s["log"], s["relations"], q))

query("identity_compare", "SELECT coalesce(a.oid, b.oid) AS oid, CASE WHEN b.oid IS NULL THEN 'left' WHEN a.oid IS NULL THEN 'right' ELSE 'both' END AS side FROM (SELECT DISTINCT oid FROM log) a FULL JOIN (SELECT oid FROM objects WHERE type = 'Person' AND status = 'inactive') b ON a.oid = b.oid", "log", "objects")(
    lambda s: C.compare_keys(s["log"], s["objects"].filter("type = 'Person' and status = 'inactive'"), "oid")
)
query("first_events_per_object", "SELECT id, oid FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY event_at, id) AS rn FROM log) WHERE rn <= 3", "log")(lambda s: C.first_of_group(s["log"], ["oid"], [F.asc("event_at"), F.asc("id")], 3).select("id", "oid"))

# integrity
query("orphans", "SELECT id, log.oid FROM log WHERE NOT EXISTS (SELECT 1 FROM objects o WHERE o.oid = log.oid AND o.status = 'active')", "log", "objects")(lambda s: I.orphans(s["log"], "oid", s["objects"].filter("status = 'active'"), "oid").select("id", "oid"))
_bent = "SELECT CASE WHEN oid LIKE '%3' THEN lower(oid) WHEN oid LIKE '%4' THEN replace(oid, 'PER', 'XXX') WHEN oid LIKE '%5' THEN replace(oid, 'SRV', 'RES') ELSE oid END AS oid, type FROM objects"
query("oid_violations", f"SELECT oid, type, reason FROM (SELECT *, CASE WHEN NOT regexp_matches(oid, '^[A-Z]{{3}}-[0-9]{{6}}$') OR oid LIKE '%-000000' THEN 'grammar' WHEN left(oid, 3) NOT IN ('COR','PER','PLG','RES','SRV','SYS') THEN 'prefix' WHEN type <> CASE left(oid, 3) WHEN 'COR' THEN 'Core' WHEN 'PER' THEN 'Person' WHEN 'PLG' THEN 'Plugin' WHEN 'RES' THEN 'Resource' WHEN 'SRV' THEN 'Service' ELSE 'System' END THEN 'type' END AS reason FROM ({_bent})) WHERE reason IS NOT NULL", "objects")(
    lambda s: I.oid_violations(s["objects"].withColumn("oid", F.expr("CASE WHEN oid LIKE '%3' THEN lower(oid) WHEN oid LIKE '%4' THEN replace(oid, 'PER', 'XXX') WHEN oid LIKE '%5' THEN replace(oid, 'SRV', 'RES') ELSE oid END")))
)
_active = "(SELECT * FROM objects WHERE status = 'active')"
query("oid_continuity", f"SELECT left(oid, 3) AS prefix, min(CAST(substr(oid, 5) AS BIGINT)) AS lo, max(CAST(substr(oid, 5) AS BIGINT)) AS hi, count(*) AS n, max(CAST(substr(oid, 5) AS BIGINT)) - min(CAST(substr(oid, 5) AS BIGINT)) + 1 - count(DISTINCT oid) AS gaps, count(*) - count(DISTINCT oid) AS duplicates FROM {_active} GROUP BY 1", "objects")(lambda s: I.oid_continuity(s["objects"].filter("status = 'active'")))
query("oid_gaps", f"SELECT prefix, number FROM (SELECT left(oid, 3) AS prefix, unnest(generate_series(min(CAST(substr(oid, 5) AS BIGINT)), max(CAST(substr(oid, 5) AS BIGINT)))) AS number FROM {_active} GROUP BY 1) x WHERE NOT EXISTS (SELECT 1 FROM {_active} o WHERE left(o.oid, 3) = prefix AND CAST(substr(o.oid, 5) AS BIGINT) = number)", "objects")(lambda s: I.oid_gaps(s["objects"].filter("status = 'active'")))


@query("sequence_highwater", "SELECT type AS object_type, CAST(100 AS BIGINT) AS last_value, max(CAST(substr(oid, 5) AS BIGINT)) AS used FROM objects GROUP BY type HAVING max(CAST(substr(oid, 5) AS BIGINT)) > 100", "objects")
def sequence_highwater(s: Source):
    sequences = s["objects"].select(F.col("type").alias("object_type")).distinct().withColumn("last_value", F.lit(100).cast("long"))
    return I.sequence_highwater(sequences, s["objects"])


query("unique_keys", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")(lambda s: I.duplicates(s.t("events"), ["user_id", "event_type"]))
query("typed_references", "SELECT id, source_oid FROM relations WHERE NOT EXISTS (SELECT 1 FROM objects o WHERE o.oid = source_oid AND o.type = 'Person')", "relations", "objects")(lambda s: I.typed_references(s["relations"], "source_oid", s["objects"], "Person").select("id", "source_oid"))
query("self_relations", "SELECT n_nationkey FROM nation WHERE n_nationkey = n_regionkey")(lambda s: I.self_relations(s.t("nation").withColumns({"source_oid": F.col("n_nationkey"), "target_oid": F.col("n_regionkey")})).select("n_nationkey"))
query("superseded_twice", "SELECT supersedes_event_id AS event_id, count(*) AS n FROM log WHERE supersedes_event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT id, 1 FROM log WHERE supersedes_event_id = id", "log")(lambda s: I.superseded_twice(s["log"]))
query("missing_identities", "SELECT 'PER-' || lpad(CAST(o_custkey + 2 AS VARCHAR), 6, '0') AS oid, 'Person' AS type FROM orders EXCEPT SELECT oid, type FROM objects", "objects")(
    lambda s: I.missing_identities(s.t("orders").select(F.concat(F.lit("PER-"), F.lpad((F.col("o_custkey") + 2).cast("string"), 6, "0")).alias("oid"), F.lit("Person").alias("type")).distinct(), s["objects"])
)

# reconciliation
query("parity_guard", "SELECT a.who, a.kind, left_n, coalesce(right_n, 0) AS right_n FROM (SELECT who, kind, count(*) AS left_n FROM left_log GROUP BY 1, 2) a LEFT JOIN (SELECT who, kind, count(*) AS right_n FROM right_log GROUP BY 1, 2) b ON a.who IS NOT DISTINCT FROM b.who AND a.kind IS NOT DISTINCT FROM b.kind WHERE coalesce(right_n, 0) < left_n", "left_log", "right_log")(lambda s: I.parity(s["left_log"], s["right_log"], ["who", "kind"]))
_FIFO = "SELECT a.id, b.id AS matched_id FROM (SELECT *, row_number() OVER (PARTITION BY who, kind ORDER BY id) AS rn FROM left_log) a LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY who, kind ORDER BY id) AS rn FROM right_log) b ON a.who IS NOT DISTINCT FROM b.who AND a.kind IS NOT DISTINCT FROM b.kind AND a.rn = b.rn"
query("fifo_match", _FIFO, "left_log", "right_log")(lambda s: I.fifo_match(s["left_log"], s["right_log"], ["who", "kind"]))
query("fifo_unmatched", f"SELECT id FROM ({_FIFO}) WHERE matched_id IS NULL", "left_log", "right_log")(lambda s: I.fifo_match(s["left_log"], s["right_log"], ["who", "kind"]).filter("matched_id is null").select("id"))


@query("map_and_match", "SELECT l.id, CASE WHEN l.id IN (2, 4) THEN 'excluded' WHEN l.who > 6 THEN 'unmapped' WHEN matched_id IS NOT NULL THEN 'matched' ELSE 'pending' END AS state, matched_id FROM left_log l LEFT JOIN (SELECT a.id, b.id AS matched_id FROM (SELECT *, row_number() OVER (PARTITION BY who, kind ORDER BY id) AS rn FROM left_log WHERE who <= 6) a JOIN (SELECT *, row_number() OVER (PARTITION BY who, kind ORDER BY id) AS rn FROM right_log) b ON a.who = b.who AND a.kind IS NOT DISTINCT FROM b.kind AND a.rn = b.rn) m ON l.id = m.id", "left_log", "right_log")
def map_and_match(s: Source):
    mapping = s.spark.range(7).select(F.col("id").alias("who"), F.col("id").alias("service"))
    right = s["right_log"].withColumn("service", F.col("who"))
    return I.map_and_match(s["left_log"], right, mapping, "who", ["service", "kind"], [2, 4])


query("evidence_gap", f"SELECT id, matched_id FROM ({_FIFO}) WHERE matched_id IS NOT NULL AND id % 6 > 0", "left_log", "right_log")(
    lambda s: (lambda p: I.evidence_gap(s["left_log"], s["right_log"], ["who", "kind"], p.select(F.col("id").alias("left_id"), (F.col("matched_id") + F.when(F.col("id") % 6 == 0, 0).otherwise(1)).alias("right_id"))))(I.fifo_match(s["left_log"], s["right_log"], ["who", "kind"]).filter("matched_id is not null"))
)
query(
    "identity_audit",
    "SELECT coalesce(l.oid, o.oid) AS oid, CASE WHEN o.oid IS NULL THEN 'json_only' WHEN l.oid IS NULL THEN 'catalogue_only' ELSE 'both' END AS state, coalesce(l.type = 'System' AND l.oid LIKE 'SYX%', false) AS elsewhere FROM (SELECT CASE WHEN type = 'System' THEN 'SYX' || substr(oid, 4) ELSE oid END AS oid, type FROM objects WHERE type <> 'Service' AND type <> 'Resource') l FULL JOIN (SELECT * FROM objects WHERE type <> 'Core' AND type <> 'Resource') o ON l.oid = o.oid",
    "objects",
)(
    lambda s: I.identity_audit(s["objects"].filter("type not in ('Service', 'Resource')").withColumn("oid", F.when(F.col("type") == "System", F.concat(F.lit("SYX"), F.substring("oid", 4, 99))).otherwise(F.col("oid"))), s["objects"].filter("type not in ('Core', 'Resource')"))
)


def _plugins(s: Source):
    """Plugins are nations, their services suppliers of the nation; every fifth plugin has no object."""
    ident = F.concat(F.lit("PLG-"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 6, "0"))
    n = s.t("nation")
    meta = n.select(ident.alias("plugin_oid"), F.lower("n_name").alias("slug"), F.lit("1.0").alias("version"))
    own = n.select(F.when(F.col("n_nationkey") % 5 > 0, ident).alias("oid"), F.lit("Plugin").alias("type"), F.col("n_name").alias("name"), F.lit("active").alias("status")).filter("oid is not null")
    links = s["relations"].filter("relation_type = 'located_in' and source_oid like 'SRV%'").select(F.regexp_replace("target_oid", "SYS", "PLG").alias("plugin_oid"), F.col("source_oid").alias("service_oid"))
    return meta, s["objects"].unionByName(own), links


_PLG = "'PLG-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 6, '0')"
query("plugin_registry", f"SELECT {_PLG} AS plugin_oid, lower(n_name) AS slug, n_name AS object_name FROM nation WHERE n_nationkey % 5 > 0")(lambda s: (lambda m, o, _: C.plugin_registry(m, o).select("plugin_oid", "slug", "object_name"))(*_plugins(s)))
query("plugin_lookup", f"SELECT {_PLG} AS plugin_oid, lower(n_name) AS slug FROM nation WHERE upper(n_name) = (SELECT upper(n_name) FROM nation WHERE n_nationkey = 7)")(
    lambda s: C.plugin(_plugins(s)[0], s.t("nation").filter("n_nationkey = 7").first()["n_name"].swapcase()).select("plugin_oid", "slug")
)
query("plugin_services", f"SELECT 'PLG-' || substr(target_oid, 5) AS plugin_oid, source_oid AS service_oid, CASE WHEN n_nationkey % 5 > 0 THEN n_name END AS plugin_name, s_name AS service_name FROM relations JOIN nation ON substr(target_oid, 5) = substr({_PLG}, 5) JOIN supplier ON substr(source_oid, 5) = lpad(CAST(s_suppkey + 1 AS VARCHAR), 6, '0') WHERE relation_type = 'located_in' AND source_oid LIKE 'SRV%'", "relations")(
    lambda s: (lambda _, o, l: C.plugin_services(l, o).select("plugin_oid", "service_oid", "plugin_name", "service_name"))(*_plugins(s))
)

#: The tables that guards look at: plugins are nations (every fifth has no object), their services the nation's suppliers;
#: every seventh queue item names no resource, every 51st one that doesn't exist; some log entries supersede none.
_OBJECTS = f"(SELECT oid, type FROM objects UNION ALL SELECT {_PLG}, 'Plugin' FROM nation WHERE n_nationkey % 5 > 0)"
_SQL = {
    "log": "log", "relations": "relations", "resources": "resources", "runs": "runs", "objects": _OBJECTS,
    "plugin_metadata": f"(SELECT {_PLG} AS plugin_oid FROM nation WHERE n_nationkey % 6 > 0)",
    "plugin_services": "(SELECT 'PLG-' || substr(target_oid, 5) AS plugin_oid, source_oid AS service_oid FROM relations WHERE relation_type = 'located_in' AND source_oid LIKE 'SRV%')",
    "import_queue": "(SELECT CASE WHEN import_id % 7 = 0 THEN NULL WHEN import_id % 51 = 0 THEN 'RES-999999' ELSE 'RES-' || lpad(CAST(import_id + 1 AS VARCHAR), 6, '0') END AS resource_oid FROM queue)",
}


def _guarded(s: Source) -> dict:
    meta, objects, links = _plugins(s)
    item = F.concat(F.lit("RES-"), F.lpad((F.col("import_id") + 1).cast("string"), 6, "0"))
    queue = s["queue"].select(F.when(F.col("import_id") % 7 == 0, None).when(F.col("import_id") % 51 == 0, "RES-999999").otherwise(item).alias("resource_oid"))
    meta = meta.filter("cast(substr(plugin_oid, 5) as int) % 6 <> 1")
    return {"log": s["log"], "relations": s["relations"], "resources": s["resources"], "runs": s["runs"], "objects": objects, "plugin_metadata": meta, "plugin_services": links, "import_queue": queue}


#: Child, its key, parent, the parent's key, whether a null is a fault too.
_GUARDS = (
    ("log", "oid", "objects", "oid", True), ("log", "supersedes_event_id", "log", "id", False), ("runs", "service_oid", "objects", "oid", True), ("plugin_metadata", "plugin_oid", "objects", "oid", True),
    ("plugin_services", "plugin_oid", "plugin_metadata", "plugin_oid", True), ("plugin_services", "service_oid", "objects", "oid", True), ("relations", "source_oid", "objects", "oid", True),
    ("relations", "target_oid", "objects", "oid", True), ("resources", "resource_oid", "objects", "oid", True), ("import_queue", "resource_oid", "resources", "resource_oid", False),
)
_CHECK = "SELECT '{c}.{k}' AS \"check\", count(*) AS violations, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS classification FROM {child} c WHERE {null}NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{k}{more})"


def _check(c: str, k: str, p: str, pk: str, required: bool, more: str = "") -> str:
    return _CHECK.format(c=c, k=k, child=_SQL[c], parent=_SQL[p], pk=pk, null="" if required else f"c.{k} IS NOT NULL AND ", more=more)


query("orphan_guards", " UNION ALL ".join(_check(*g) for g in _GUARDS), "log", "relations", "resources", "runs", "queue", "objects")(
    lambda s: (lambda t: I.guards({f"{c}.{k}": I.orphans(t[c], k, t[p], pk, required) for c, k, p, pk, required in _GUARDS}))(_guarded(s))
)
_TYPED = (
    ("resources", "resource_oid", "Resource", True), ("plugin_metadata", "plugin_oid", "Plugin", True), ("plugin_services", "plugin_oid", "Plugin", True), ("plugin_services", "service_oid", "Service", True),
    ("runs", "service_oid", "Service", True), ("import_queue", "resource_oid", "Resource", False), ("relations", "source_oid", "Person", True), ("relations", "target_oid", "System", True), ("log", "oid", "Person", True),
)
query("type_guards", " UNION ALL ".join(_check(c, k, "objects", "oid", required, f" AND p.type = '{n}'") for c, k, n, required in _TYPED), "log", "relations", "resources", "runs", "queue", "objects")(
    lambda s: (lambda t: I.guards({f"{c}.{k}": I.typed_references(t[c], k, t["objects"], n, required) for c, k, n, required in _TYPED}))(_guarded(s))
)
