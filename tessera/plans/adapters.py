"""The model's tables made from the driver's, as DataFrames and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES: dict = {}
CTE: dict[str, str] = {}


def adapter(name: str, sql: str):
    def keep(fn):
        TABLES[name] = fn
        CTE[name] = sql.strip()
        return fn

    return keep


class Source:
    """Reads tables and adapters by name: Source(spark, sf_dir)["events"] or .t("orders")."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return TABLES[name](self)


def with_ctes(sql: str, *names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in names) + "\n" + sql


def oid(prefix: str, key: str):
    return F.concat(F.lit(prefix + "-"), F.lpad((F.col(key) + 1).cast("string"), 6, "0"))


def _oid(prefix: str, key: str) -> str:
    return f"'{prefix}-' || lpad(CAST({key} + 1 AS VARCHAR), 6, '0')"


@adapter(
    "objects",
    f"""
SELECT {_oid("PER", "c_custkey")} AS oid, 'Person' AS type, c_name AS name, CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status FROM customer
UNION ALL SELECT {_oid("SRV", "s_suppkey")}, 'Service', s_name, 'active' FROM supplier
UNION ALL SELECT {_oid("RES", "p_partkey")}, 'Resource', p_name, 'active' FROM part
UNION ALL SELECT {_oid("SYS", "n_nationkey")}, 'System', n_name, 'active' FROM nation
UNION ALL SELECT {_oid("COR", "r_regionkey")}, 'Core', r_name, 'active' FROM region""",
)
def objects(s: Source) -> DataFrame:
    status = F.when(F.col("c_acctbal") < 0, "inactive").otherwise("active")
    out = s.t("customer").select(oid("PER", "c_custkey").alias("oid"), F.lit("Person").alias("type"), F.col("c_name").alias("name"), status.alias("status"))
    for table, prefix, key, kind, name in (
        ("supplier", "SRV", "s_suppkey", "Service", "s_name"),
        ("part", "RES", "p_partkey", "Resource", "p_name"),
        ("nation", "SYS", "n_nationkey", "System", "n_name"),
        ("region", "COR", "r_regionkey", "Core", "r_name"),
    ):
        out = out.unionByName(s.t(table).select(oid(prefix, key).alias("oid"), F.lit(kind).alias("type"), F.col(name).alias("name"), F.lit("active").alias("status")))
    return out


@adapter(
    "relations",
    f"""
SELECT CAST(c_custkey * 3 AS BIGINT) AS id, {_oid("PER", "c_custkey")} AS source_oid, 'located_in' AS relation_type, {_oid("SYS", "c_nationkey")} AS target_oid FROM customer
UNION ALL SELECT CAST(s_suppkey * 3 + 1 AS BIGINT), {_oid("SRV", "s_suppkey")}, 'located_in', {_oid("SYS", "s_nationkey")} FROM supplier
UNION ALL SELECT CAST(n_nationkey * 3 + 2 AS BIGINT), {_oid("SYS", "n_nationkey")}, 'part_of', {_oid("COR", "n_regionkey")} FROM nation""",
)
def relations(s: Source) -> DataFrame:
    def of(table, k, add, a, b, kind, to):
        return s.t(table).select((F.col(k) * 3 + add).cast("long").alias("id"), oid(a, k).alias("source_oid"), F.lit(kind).alias("relation_type"), oid(b, to).alias("target_oid"))

    return (
        of("customer", "c_custkey", 0, "PER", "SYS", "located_in", "c_nationkey")
        .unionByName(of("supplier", "s_suppkey", 1, "SRV", "SYS", "located_in", "s_nationkey"))
        .unionByName(of("nation", "n_nationkey", 2, "SYS", "COR", "part_of", "n_regionkey"))
    )


@adapter("log", f"SELECT event_id AS id, {_oid('PER', 'user_id')} AS oid, ts AS event_at, event_type, props AS description, CASE WHEN event_id % 50 IN (0, 1) THEN (event_id // 50) * 50 END AS supersedes_event_id FROM events")
def log(s: Source) -> DataFrame:
    old = F.when((F.col("event_id") % 50).isin(0, 1), F.floor(F.col("event_id") / 50) * 50)
    return s.t("events").select(F.col("event_id").alias("id"), oid("PER", "user_id").alias("oid"), F.col("ts").alias("event_at"), "event_type", F.col("props").alias("description"), old.alias("supersedes_event_id"))


@adapter(
    "resources",
    f"""SELECT {_oid("RES", "doc_id")} AS resource_oid, source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) AS path, CAST(doc_id AS VARCHAR) || '.' || lang AS filename,
lang AS extension, n_chars AS size_bytes, sha256(text) AS sha256, CASE WHEN n_chars < 1000 THEN 'small' ELSE 'active' END AS status, doc_id FROM documents""",
)
def resources(s: Source) -> DataFrame:
    d = F.col("doc_id").cast("string")
    return s.t("documents").select(
        oid("RES", "doc_id").alias("resource_oid"), F.concat_ws("/", "source", "lang", d).alias("path"), F.concat(d, F.lit("."), "lang").alias("filename"), F.col("lang").alias("extension"),
        F.col("n_chars").alias("size_bytes"), F.sha2("text", 256).alias("sha256"), F.when(F.col("n_chars") < 1000, "small").otherwise("active").alias("status"), "doc_id",
    )


@adapter(
    "queue",
    """SELECT d.doc_id AS import_id, source || '/' || CAST(d.doc_id AS VARCHAR) AS source_path, CASE WHEN l.doc_id IS NULL THEN 'pending' ELSE 'complete' END AS status,
CASE WHEN l.doc_id IS NULL THEN 'pending_review' ELSE 'reviewed' END AS review_status, CAST(l.quality AS DOUBLE) AS confidence FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def queue(s: Source) -> DataFrame:
    labels = s.t("labels").select(F.col("doc_id").alias("_l"), "quality")
    out = s.t("documents").join(labels, F.col("doc_id") == F.col("_l"), "left")
    return out.select(
        F.col("doc_id").alias("import_id"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_path"),
        F.when(F.col("_l").isNull(), "pending").otherwise("complete").alias("status"), F.when(F.col("_l").isNull(), "pending_review").otherwise("reviewed").alias("review_status"),
        F.col("quality").cast("double").alias("confidence"),
    )


@adapter(
    "runs",
    f"""SELECT l_orderkey * 10 + l_linenumber AS id, {_oid("SRV", "l_suppkey")} AS service_oid, l_shipdate AS run_at,
CASE l_returnflag WHEN 'N' THEN 'OK' WHEN 'R' THEN 'ERROR' ELSE 'CANCELLED' END AS status,
CASE WHEN l_linenumber % 3 > 0 THEN 'out/' || CAST(l_orderkey % 500 AS VARCHAR) END AS stdout_path, CASE WHEN l_linenumber % 2 = 0 THEN 'out/' || CAST(l_orderkey % 700 AS VARCHAR) END AS stderr_path FROM lineitem""",
)
def runs(s: Source) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "N", "OK").when(F.col("l_returnflag") == "R", "ERROR").otherwise("CANCELLED")

    def at(n):
        return F.concat(F.lit("out/"), (F.col("l_orderkey") % n).cast("string"))

    return s.t("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), oid("SRV", "l_suppkey").alias("service_oid"), F.col("l_shipdate").alias("run_at"), flag.alias("status"),
        F.when(F.col("l_linenumber") % 3 > 0, at(500)).alias("stdout_path"), F.when(F.col("l_linenumber") % 2 == 0, at(700)).alias("stderr_path"),
    )


_KINDS = {
    "signup": ("RUN_INTERRUPTED", "RUN_PAUSED", "RUN_STARTED"),
    "view": ("RUN_STARTED", "RUN_FAILED", "RUN_RESUMED"),
    "click": ("RUN_STARTED", "RUN_INTERRUPTED", "RUN_RESUMED"),
    "purchase": ("RUN_STARTED", "RUN_COMPLETED", "RUN_PAUSED"),
    "error": ("RUN_ABORTED", "RUN_FAILED", "RUN_ABORTED"),
}
_KIND = f"""CASE WHEN event_id % 4 = 0 THEN CASE WHEN event_id % 44 = 0 THEN 'RUN_STARTED' ELSE 'RUN_CREATED' END WHEN event_id % 36 = 2 THEN 'HUMAN_DECISION' {" ".join(f"WHEN event_type = '{k}' AND event_id % 4 = {n} THEN '{v}'" for k, of in _KINDS.items() for n, v in enumerate(of, 1))} ELSE 'RUN_PAUSED' END"""


@adapter("ledger", f"SELECT event_id // 4 AS run_id, event_id % 4 + 1 AS seq, event_id, ts, {_KIND} AS event_type, value FROM events")
def ledger(s: Source) -> DataFrame:
    """Runs of four events each; every eleventh starts without being created, some events change no state."""
    return s.t("events").select(F.floor(F.col("event_id") / 4).alias("run_id"), (F.col("event_id") % 4 + 1).alias("seq"), "event_id", "ts", F.expr(_KIND).alias("event_type"), "value")


@adapter("left_log", "SELECT event_id AS id, user_id % 10 AS who, nullif(event_type, 'view') AS kind FROM events WHERE event_id % 2 = 0")
def left_log(s: Source) -> DataFrame:
    return s.t("events").filter("event_id % 2 = 0").select(F.col("event_id").alias("id"), (F.col("user_id") % 10).alias("who"), F.expr("nullif(event_type, 'view')").alias("kind"))


@adapter("right_log", "SELECT event_id AS id, user_id % 10 AS who, nullif(event_type, 'view') AS kind FROM events WHERE event_id % 2 = 1")
def right_log(s: Source) -> DataFrame:
    return s.t("events").filter("event_id % 2 = 1").select(F.col("event_id").alias("id"), (F.col("user_id") % 10).alias("who"), F.expr("nullif(event_type, 'view')").alias("kind"))


@adapter("titles", "SELECT 'part' AS entity_type, 'P' || CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN 'gone ' ELSE '' END || p_name || ' ' || CAST(p_partkey AS VARCHAR) AS title, p_partkey * 2 AS ord FROM part UNION ALL SELECT 'part', 'Q' || CAST(p_partkey AS VARCHAR), p_name, p_partkey * 2 + 1 FROM part WHERE p_partkey < 20 UNION ALL SELECT 'supplier', 'S' || CAST(s_suppkey AS VARCHAR), s_name, s_suppkey * 2 FROM supplier")
def titles(s: Source) -> DataFrame:
    p = s.t("part")
    key = F.col("p_partkey").cast("string")
    title = F.concat_ws(" ", F.when(F.col("p_partkey") % 3 == 0, "gone"), "p_name", key)  # every third one's title is another
    a = p.select(F.lit("part").alias("entity_type"), F.concat(F.lit("P"), key).alias("id"), title.alias("title"), (F.col("p_partkey") * 2).alias("ord"))
    b = p.filter("p_partkey < 20").select(F.lit("part").alias("entity_type"), F.concat(F.lit("Q"), key).alias("id"), F.col("p_name").alias("title"), (F.col("p_partkey") * 2 + 1).alias("ord"))
    c = s.t("supplier").select(F.lit("supplier").alias("entity_type"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("title"), (F.col("s_suppkey") * 2).alias("ord"))
    return a.unionByName(b).unionByName(c)


@adapter(
    "raw_claims",
    """SELECT sha256(CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)) AS file_id,
CASE WHEN l_linenumber = 7 THEN p_name ELSE p_name || ' ' || CAST(p_partkey AS VARCHAR) END AS subject_raw,
CASE l_returnflag WHEN 'N' THEN 'Supplied by' WHEN 'R' THEN 'Returned_to' ELSE 'made-by' END AS predicate, s_name AS object_raw,
'order ' || CAST(l_orderkey AS VARCHAR) AS evidence_excerpt,
CASE WHEN l_quantity < 10 THEN 'VERIFIED' WHEN l_quantity < 15 THEN 'CONFIRMED' WHEN l_quantity < 20 THEN NULL WHEN l_quantity < 30 THEN 'SUPPORTED_BY_WEB' WHEN l_quantity < 40 THEN 'INFERRED' WHEN l_quantity < 45 THEN 'DISPUTED' ELSE 'odd' END AS status,
CASE WHEN l_linenumber % 4 = 0 THEN '{"page":"' || CAST(l_linenumber AS VARCHAR) || '","scope":"' || l_returnflag || '"}' ELSE '{}' END AS qualifiers,
l_orderkey * 10 + l_linenumber AS ord FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag) = 1) JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
def raw_claims(s: Source, hashed: bool = True) -> DataFrame:
    """With hashed=False file_id is what its sha256 is made of: a sixth of the bytes, for plans that join it and show it last."""
    rows = claim_items(s).join(s.t("part"), F.col("l_partkey") == F.col("p_partkey")).join(s.t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return claims_of(rows.withColumns({"subject_raw": subject_of(F.col("l_linenumber") == 7), "object_raw": F.col("s_name")}), hashed)


def subject_of(named):
    """A claim's subject: the part's name, but for lines 7 with its key."""
    return F.when(named, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")))


def _file():
    return F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def claim_items(s: Source, by_file: bool = False) -> DataFrame:
    """What claims are made of: one line item for each order and line.  by_file: with file_id (not hashed), and dealt by
    it, so that what joins it by file needs no other shuffle."""
    from pyspark.sql import Window

    keys = ["l_orderkey", "l_linenumber"]
    items = s.t("lineitem").select(*keys, "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    if by_file:
        keys, items = ["file_id", *keys], items.repartition(_file()).withColumn("file_id", _file())
    one = F.row_number().over(Window.partitionBy(*keys).orderBy("l_partkey", "l_suppkey", "l_quantity", "l_returnflag"))
    return items.withColumn("_rn", one).filter("_rn = 1").drop("_rn")


def claims_of(rows: DataFrame, hashed: bool = True, *more: str) -> DataFrame:
    """Raw claims from line items with subject_raw and object_raw, and the columns that more names."""
    q = F.col("l_quantity")
    return rows.select(
        (F.sha2(_file(), 256) if hashed else _file()).alias("file_id"), "subject_raw",
        F.when(F.col("l_returnflag") == "N", "Supplied by").when(F.col("l_returnflag") == "R", "Returned_to").otherwise("made-by").alias("predicate"),
        "object_raw",
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("evidence_excerpt"),
        F.when(q < 10, "VERIFIED").when(q < 15, "CONFIRMED").when(q < 20, None).when(q < 30, "SUPPORTED_BY_WEB").when(q < 40, "INFERRED").when(q < 45, "DISPUTED").otherwise("odd").alias("status"),
        F.when(F.col("l_linenumber") % 4 == 0, F.create_map(F.lit("scope"), F.col("l_returnflag"), F.lit("page"), F.col("l_linenumber").cast("string"))).alias("qualifiers"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), *more,
    )
