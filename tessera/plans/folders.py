"""Queries over folder trees, scan plans and chains of JSON records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import folders, ledger
from tessera.sources import scan

from .adapters import Source
from .inventory import query

#: A tree of the documents: language, the source's parts, and files of which some folders have many.
_TREE = "(SELECT CASE WHEN doc_id % 23 = 0 THEN '' ELSE upper(lang) || '/' END || CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'S' || source || '/' END || CASE WHEN doc_id % 3 = 0 THEN 'deep/' || CAST(doc_id % 4 AS VARCHAR) || '/' ELSE '' END || CASE WHEN doc_id % 2 = 0 THEN 'F' ELSE 'f' END || CAST(doc_id AS VARCHAR) || '.txt' AS path, n_chars AS size_bytes FROM documents)"
_LINKS = "(SELECT upper(lang) || '/S' || source || '/link ' || CAST(doc_id AS VARCHAR) AS path, 'link ' || CAST(doc_id AS VARCHAR) || '@ [SKIPPED]' AS label FROM documents WHERE doc_id % 40 = 1)"


def _tree(s: Source):
    return s.t("documents").select(
        F.expr("CASE WHEN doc_id % 23 = 0 THEN '' ELSE upper(lang) || '/' END || CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'S' || source || '/' END || CASE WHEN doc_id % 3 = 0 THEN 'deep/' || cast(doc_id % 4 AS string) || '/' ELSE '' END || CASE WHEN doc_id % 2 = 0 THEN 'F' ELSE 'f' END || cast(doc_id AS string) || '.txt'").alias("path"),
        F.col("n_chars").alias("size_bytes"),
    )


def _links(s: Source):
    name = F.concat(F.lit("link "), F.col("doc_id").cast("string"))
    planted = s.t("documents").select(F.when(F.col("doc_id") % 40 == 1, F.concat(F.upper("lang"), F.lit("/S"), "source", F.lit("/"), name)).alias("path"), F.concat(name, F.lit("@ [SKIPPED]")).alias("label"))
    return planted.filter("path IS NOT NULL")


_ABOVE = "list_transform(range(1, len(p)), lambda i: array_to_string(p[1:i], '/'))"
_PARENT = "array_to_string(p[1:len(p) - 1], '/')"
_SPLIT = f"SELECT path, size_bytes, 0 AS problem, string_split(path, '/') AS p FROM {_TREE} UNION ALL SELECT path, NULL, 1, string_split(path, '/') FROM {_LINKS}"
query(
    "folder_sums",
    f"""SELECT folder, count(*) FILTER (WHERE problem = 0 AND folder = {_PARENT}) AS files, CAST(coalesce(sum(size_bytes) FILTER (WHERE folder = {_PARENT}), 0) AS BIGINT) AS bytes,
count(*) FILTER (WHERE problem = 0) AS all_files, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS all_bytes, count(*) FILTER (WHERE problem = 1) AS all_problems
FROM (SELECT *, unnest(list_prepend('', {_ABOVE})) AS folder FROM ({_SPLIT})) GROUP BY folder""",
)(lambda s: folders.folder_sums(_tree(s), _links(s)))

#: The tree by windows over each folder's entries, and bars by a walk down from the root.
query(
    "folder_tree",
    f"""WITH RECURSIVE f AS (SELECT path, p, {_PARENT} AS parent, p[len(p)] AS name FROM ({_SPLIT}) WHERE problem = 0),
l AS (SELECT label, {_PARENT} AS parent, p[len(p)] AS name FROM (SELECT label, string_split(path, '/') AS p FROM {_LINKS})),
d AS (SELECT DISTINCT folder FROM (SELECT unnest({_ABOVE}) AS folder FROM ({_SPLIT}))),
r AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY lower(name), name) AS n, count(*) OVER (PARTITION BY parent) AS k FROM f),
e AS (
  SELECT {_PARENT} AS parent, 0 AS kind, p[len(p)] AS name, p[len(p)] || '/' AS label, folder FROM (SELECT folder, string_split(folder, '/') AS p FROM d)
  UNION ALL SELECT parent, 1, name, name, NULL FROM r WHERE n <= 12
  UNION ALL SELECT parent, 2, name, label, NULL FROM l
  UNION ALL SELECT DISTINCT parent, 3, '', '… ' || CAST(k - 12 AS VARCHAR) || ' altri file', NULL FROM r WHERE k > 12),
o AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY kind DESC, lower(name) DESC, name DESC) = 1 AS last FROM e),
w AS (
  SELECT '' AS folder, '' AS bars
  UNION ALL SELECT o.folder, w.bars || CASE WHEN o.last THEN '    ' ELSE '│   ' END FROM w JOIN o ON o.parent = w.folder AND o.kind = 0)
SELECT o.parent AS folder, bars || CASE WHEN last THEN '└── ' ELSE '├── ' END || label AS line FROM o JOIN w ON o.parent = w.folder""",
)(lambda s: folders.tree_lines(_tree(s), _links(s)).select(F.array_join(F.transform(F.slice("ord", F.lit(1), F.size("ord") - 1), lambda x: x["key"]), "/").alias("folder"), "line"))

query(
    "scan_plan",
    "SELECT path AS rel, CASE WHEN doc_id % 9 = 1 THEN 'vanished' WHEN doc_id % 9 = 2 THEN 'new' WHEN doc_id % 9 IN (3, 4) THEN 'changed' ELSE 'unchanged' END AS plan, CASE WHEN doc_id % 9 NOT IN (1, 2, 3, 4) THEN sha256 END AS sha256 FROM resources",
    "resources",
)(
    lambda s: scan.scan_plan(
        s["resources"].select(F.when(F.col("doc_id") % 9 != 1, F.col("path")).alias("rel"), F.expr("size_bytes + CASE WHEN doc_id % 9 = 3 THEN 1 ELSE 0 END AS size_bytes"), F.expr("TIMESTAMP '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, CASE WHEN doc_id % 9 = 4 THEN 1 ELSE 0 END) AS modified_at")).filter("rel IS NOT NULL"),
        s["resources"].select(F.when(F.col("doc_id") % 9 != 2, F.col("path")).alias("rel"), "size_bytes", F.expr("TIMESTAMP '2024-01-01' AS modified_at"), "sha256").filter("rel IS NOT NULL"),
    ).select("rel", "plan", "sha256")
)

#: Records as their chain's writer makes them, keys in order; they arrive with keys in another order and with spaces.
_FIELDS = "SELECT user_id AS who, event_id AS id, event_type AS kind, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS sequence FROM events"
_BODY = """'{"detail":{"kind":"' || kind || '","list":[1,2.5,{"a":null,"é":true}]},"previous_hash":"' || previous_hash || '","sequence":' || CAST(sequence AS VARCHAR) || '}'"""
_ASCII = "replace({}, 'é', '\\u00e9')"
#: A record's previous_hash is planted: that of no record but the first one's, so each later one is a fault unless the hash is too.
query(
    "audit_chain",
    f"""WITH e AS (SELECT *, CASE WHEN sequence = 1 AND id % 5 > 0 THEN repeat('0', 64) ELSE sha256(CAST(id AS VARCHAR)) END AS previous_hash FROM ({_FIELDS})),
h AS (SELECT *, CASE WHEN id % 11 = 0 THEN 'bad' ELSE sha256({_ASCII.format(_BODY)}) END AS record_hash FROM e)
SELECT who, CASE WHEN id % 17 = 0 THEN NULL ELSE sequence END AS sequence, CASE WHEN id % 17 = 0 THEN 'unreadable' WHEN sequence <> turn THEN 'sequence' WHEN previous_hash <> before THEN 'previous_hash' WHEN record_hash = 'bad' THEN 'record_hash' END AS fault
FROM (SELECT *, CASE WHEN id % 17 > 0 THEN row_number() OVER (PARTITION BY who, id % 17 > 0 ORDER BY sequence) END AS turn, lag(record_hash, 1, repeat('0', 64)) OVER (PARTITION BY who, id % 17 > 0 ORDER BY sequence) AS before FROM h) WHERE fault IS NOT NULL""",
)(lambda s: ledger.audit_chain_faults(_records(s), ["who"]))


def _records(s: Source):
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = s.t("events").select(F.col("user_id").alias("who"), F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.row_number().over(w).cast("long").alias("sequence"))
    e = e.withColumn("previous_hash", F.expr("CASE WHEN sequence = 1 AND id % 5 > 0 THEN repeat('0', 64) ELSE sha2(cast(id AS string), 256) END"))
    body = F.concat(F.lit('{"detail":{"kind":"'), "kind", F.lit('","list":[1,2.5,{"a":null,"\\u00e9":true}]},"previous_hash":"'), "previous_hash", F.lit('","sequence":'), F.col("sequence").cast("string"), F.lit("}"))
    e = e.withColumn("hash", F.when(F.col("id") % 11 == 0, "bad").otherwise(F.sha2(body, 256)))
    shown = F.concat(F.lit('{ "sequence" : '), F.col("sequence").cast("string"), F.lit(', "record_hash":"'), "hash", F.lit('","previous_hash": "'), "previous_hash", F.lit('", "detail":{"list":[1, 2.50, {"é":true,"a":null}],\n"kind":"'), "kind", F.lit('"}}'))
    return e.select("who", F.when(F.col("id") % 17 == 0, F.concat(shown, F.lit("}"))).otherwise(shown).alias("record"))
