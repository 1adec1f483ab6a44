"""Rule engine queries: documents are works, customers people, orders events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import rules as R
from tessera.scratch import materialize

from .adapters import Source

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
AS_OF = "2024-06-30"

CONFIG = R.Config(
    entities={
        "work": R.Entity(
            fields={"source": R.Field(required=True), "lang": R.Field(required=True, weight=2), "label": R.Field(weight=2), "size": R.Field(kind="integer"), "note": R.Field()},
            relations={"author": R.Relation("person", inverse="works", required=True)},
            sources=("origin",), state="state", state_options=("Verified", "Draft"), verified_on="checked", publishable="public", confidentiality="class", unpublishable=("closed",), economic=("label",), identity=("source", "size"),
        ),
        "person": R.Entity(
            fields={"segment": R.Field(required=True), "balance": R.Field(kind="integer", weight=3), "born": R.Field(kind="year")}, relations={"works": R.Relation("work", inverse="author")}, name_like=True,
            years=("born",), year_severity="MAJOR",
        ),
        "event": R.Entity(
            fields={"start": R.Field(kind="date", required=True), "end": R.Field(kind="date")}, relations={"guest": R.Relation("person")}, sources=("origin",), span=("start", "end"), years=("start",), state="state", state_options=("Draft", "Closed"),
        ),
    },
    states={"verified": "VALID", "draft": "INCOMPLETE"},
    active_from="1993-01-01", active_to="1997-12-31", years=(1993, 2000), placeholders=("licensed under", "Mentpa"), promotional=("the", "Dér"), vague=("of", "une"), generated=("and", "der", "the"), completeness=0.7,
)
BIRTHS = ("event", "start", "guest", "born")


def _map(**pairs):
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("string"))])


def corpus(s: Source):
    """Works: the documents, by the customer of their number; people: customers; events: orders, with a customer as
    guest.  Misses are planted as values: every seventeenth work names nobody, some guests are unknown or given by title,
    some labels are a tab."""
    labels = s.t("labels").select(F.col("doc_id").alias("_l"), "quality", "toxic").groupBy("_l").agg(F.min("quality").alias("quality"), F.min("toxic").alias("toxic"))
    d = s.t("documents").join(labels, F.col("doc_id") == F.col("_l"), "left")
    works = d.select(
        F.lit("work").alias("entity"), F.concat(F.lit("w"), F.col("doc_id").cast("string")).alias("id"), F.concat(F.lit("work "), F.col("doc_id").cast("string")).alias("title"),
        _map(source=F.col("source"), lang=F.expr("nullif(lang, 'fr')"), label=F.expr("CASE WHEN quality = 1 THEN 'good' ELSE '\t' END"), size=F.expr("CASE WHEN doc_id % 11 = 0 THEN 'many' ELSE cast(n_chars AS string) END"), note=F.expr("left(text, CASE WHEN doc_id % 2 = 0 THEN 250 ELSE 150 END)")).alias("fields"),
        F.create_map(F.lit("author"), F.expr("CASE WHEN doc_id % 13 = 0 THEN cast(array() AS array<string>) WHEN doc_id % 17 = 0 THEN array('nobody') ELSE array(concat('p', doc_id % 100)) END")).alias("relations"),
        _map(origin=F.expr("CASE doc_id % 3 WHEN 0 THEN 'https://example.org/x' WHEN 1 THEN 'https://dropbox.example/x' END"), state=F.expr("CASE doc_id % 4 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Draft' WHEN 2 THEN 'odd' END"), checked=F.expr("CASE doc_id % 5 WHEN 0 THEN '2024-01-02' WHEN 1 THEN '2020-01-02' END"), public=F.expr("CASE WHEN toxic = 0 THEN 'Sì' ELSE 'false' END"), **{"class": F.expr("CASE WHEN doc_id % 6 = 0 THEN 'closed' END")}).alias("service"),
        F.col("text").alias("body"), (F.col("doc_id") * 3).alias("ord"),
    )
    people = s.t("customer").select(
        F.lit("person"), F.concat(F.lit("p"), F.col("c_custkey").cast("string")), F.expr("CASE WHEN c_custkey % 2 = 0 THEN concat('Ann Lee', cast(c_custkey % 20 AS string)) ELSE concat('Lee', cast((c_custkey + 17) % 20 AS string), ', Ann') END"),
        _map(segment=F.col("c_mktsegment"), balance=F.expr("cast(cast(c_acctbal AS bigint) AS string)"), born=F.expr("CASE WHEN c_custkey % 7 = 0 THEN '1996' ELSE 'about 1950' END")), F.create_map(F.lit("works"), F.expr("array(concat('w', c_custkey))")), _map(note=F.lit("x")), F.lit(None).cast("string"), F.col("c_custkey") * 3 + 1,
    )
    guest = F.expr("CASE o_orderkey % 10 WHEN 3 THEN cast(array() AS array<string>) WHEN 7 THEN array(concat('q', o_custkey)) WHEN 5 THEN array(concat('ANN-Lée', cast(2 * (o_custkey % 10) AS string))) ELSE array(concat('p', o_custkey)) END")
    events = s.t("orders").select(
        F.lit("event"), F.concat(F.lit("e"), F.col("o_orderkey").cast("string")), F.concat(F.lit("event "), F.col("o_orderkey").cast("string")),
        _map(start=F.expr("CASE WHEN o_orderkey % 10 = 4 THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"), end=F.expr("date_format(date_add(to_date(o_orderdate), cast(o_custkey % 7 AS int) - 2), 'd/M/yyyy')")),
        F.create_map(F.lit("guest"), guest), _map(state=F.lit("draft"), origin=F.lit("archive")), F.lit(None).cast("string"), F.col("o_orderkey") * 3 + 2,
    )
    return works.union(people).union(events)


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return keep


def _rule(codes: str, part, more: tuple = ()):
    wanted = codes.split(",")
    return lambda s: part(corpus(s)).filter(F.col("code").isin(*wanted)).select("code", "severity", "record_id", "field", *more)


_L = "(SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY 1)"
_W = f"(SELECT d.*, quality, toxic, 'w' || CAST(d.doc_id AS VARCHAR) AS rid, CASE WHEN d.doc_id % 13 = 0 THEN NULL WHEN d.doc_id % 17 = 0 THEN 'nobody' ELSE 'p' || CAST(d.doc_id % 100 AS VARCHAR) END AS author FROM documents d LEFT JOIN {_L} l ON d.doc_id = l.doc_id)"
_E = "(SELECT o_orderkey, o_custkey, 'e' || CAST(o_orderkey AS VARCHAR) AS rid, CASE WHEN o_orderkey % 10 <> 4 THEN CAST(o_orderdate AS DATE) END AS s, CAST(o_orderdate AS DATE) + CAST(o_custkey % 7 - 2 AS INTEGER) AS e FROM orders)"
_PEOPLE = "(SELECT c_custkey, 'p' || CAST(c_custkey AS VARCHAR) AS rid, CASE WHEN c_custkey % 7 = 0 THEN 1996 ELSE 1950 END AS born FROM customer)"
_P = "(SELECT rid, c_custkey * 3 + 1 AS ord, CASE WHEN c_custkey % 2 = 0 THEN 'Ann Lee' || CAST(c_custkey % 20 AS VARCHAR) ELSE 'Lee' || CAST((c_custkey + 17) % 20 AS VARCHAR) || ', Ann' END AS title, CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 1 END AS t, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 20 ELSE (c_custkey + 17) % 20 END AS f FROM " + _PEOPLE + ")"
#: the guest of an event: by id, or the last person of a title
_GUEST = f"(SELECT e.*, coalesce(p.rid, q.rid) AS guest, coalesce(p.born, q.born) AS born FROM {_E} e LEFT JOIN {_PEOPLE} p ON e.o_orderkey % 10 NOT IN (3, 5, 7) AND p.c_custkey = e.o_custkey LEFT JOIN (SELECT c_custkey % 20 AS k, max(c_custkey) AS c, 'p' || CAST(max(c_custkey) AS VARCHAR) AS rid, CASE WHEN max(c_custkey) % 7 = 0 THEN 1996 ELSE 1950 END AS born FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1) q ON e.o_orderkey % 10 = 5 AND q.k = 2 * (e.o_custkey % 10))"


def _issues(*parts: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{code}' AS code, '{severity}' AS severity, rid AS record_id, '{name}' AS field FROM {source}" for code, severity, name, source in parts)


_field, _relation, _meta, _twice = (lambda c: R.field_rules(c, CONFIG)), (lambda c: R.relation_rules(c, CONFIG)), (lambda c: R.metadata_rules(c, CONFIG, AS_OF)), (lambda c: R.duplicate_rules(c, CONFIG))
_time = lambda c: R.time_rules(c, CONFIG, AS_OF)
query("rule_S01", _issues(("S01", "BLOCKER", "lang", f"{_W} WHERE lang = 'fr'")))(_rule("S01", _field))
query("rule_S02", _issues(("S02", "MINOR", "label", f"{_W} WHERE quality IS NULL OR quality <> 1")))(_rule("S02", _field))
query("rule_S03", _issues(("S03", "MINOR", "size", f"{_W} WHERE doc_id % 11 = 0"), ("S03", "MAJOR", "start", f"{_E} WHERE s IS NULL")))(_rule("S03", _field))
query("rule_R01", _issues(("R01", "BLOCKER", "author", f"{_W} WHERE author IS NULL")))(_rule("R01", _relation))
query("rule_R02", _issues(("R02", "MAJOR", "author", f"{_W} WHERE author NOT IN (SELECT rid FROM {_PEOPLE})"), ("R02", "MAJOR", "works", f"{_PEOPLE} WHERE c_custkey NOT IN (SELECT doc_id FROM documents)"), ("R02", "MAJOR", "guest", f"{_GUEST} WHERE guest IS NULL AND o_orderkey % 10 <> 3")))(_rule("R02", _relation))
_R03 = f"SELECT rid, 'work' AS entity, 'author' AS field, author AS target, 'work ' || CAST(doc_id AS VARCHAR) AS title FROM {_W} WHERE author IN (SELECT rid FROM {_PEOPLE}) AND 'p' || CAST(doc_id AS VARCHAR) <> author UNION ALL SELECT p.rid, 'person', 'works', w.rid, n.title FROM {_PEOPLE} p JOIN {_W} w ON w.doc_id = p.c_custkey JOIN {_P} n ON n.rid = p.rid WHERE coalesce(w.author, '') <> p.rid"
query("rule_R03", f"SELECT 'R03' AS code, 'MINOR' AS severity, rid AS record_id, field FROM ({_R03})")(_rule("R03", _relation))
query("rule_R04", _issues(("R04", "MAJOR", "", f"{_W} WHERE author IS NULL AND doc_id NOT IN (SELECT c_custkey FROM customer)"), ("R04", "MAJOR", "", f"{_E} WHERE o_orderkey % 10 = 3")))(_rule("R04", _relation))
query("rule_T01", _issues(("T01", "BLOCKER", "end", f"{_E} WHERE e < s")))(_rule("T01", _time))
query("rule_T02", _issues(("T02", "MAJOR", "start", f"{_E} WHERE s < DATE '1993-01-01'"), ("T02", "MINOR", "start", f"{_E} WHERE s > DATE '1997-12-31'")))(_rule("T02", _time))
query("rule_T03", _issues(("T03", "BLOCKER", "start", f"{_GUEST} WHERE year(s) < born")))(_rule("T03", lambda c: R.time_rules(c, CONFIG, AS_OF, BIRTHS)))
query("rule_T05", _issues(("T05", "MINOR", "start", f"{_E} WHERE year(s) NOT BETWEEN 1993 AND 2000"), ("T05", "MAJOR", "born", f"{_PEOPLE} WHERE born NOT BETWEEN 1993 AND 2000")))(_rule("T05", _time))
query("rule_M01", _issues(("M01", "MAJOR", "", _PEOPLE)))(_rule("M01", _meta))
query("rule_M02", _issues(("M02", "MAJOR", "source", f"{_W} WHERE doc_id % 3 = 2")))(_rule("M02", _meta))
query("rule_M03", _issues(("M03", "INFO", "source", f"{_W} WHERE doc_id % 3 = 0")))(_rule("M03", _meta))
query("rule_M04", _issues(("M04", "MAJOR", "state", f"{_W} WHERE doc_id % 4 = 3"), ("M04", "MINOR", "state", f"{_W} WHERE doc_id % 4 = 2")))(_rule("M04", _meta))
query("rule_M06", _issues(("M06", "MINOR", "checked", f"{_W} WHERE doc_id % 4 = 0 AND doc_id % 5 > 1 OR doc_id % 5 = 1")))(_rule("M06", _meta))
query("rule_M07", _issues(("M07", "MAJOR", "public", f"{_W} WHERE toxic = 0 AND doc_id % 4 > 0"), ("M07", "MAJOR", "source", f"{_W} WHERE toxic = 0 AND doc_id % 3 = 2")))(_rule("M07", _meta))
query("rule_M08", _issues(("M08", "BLOCKER", "class", f"{_W} WHERE toxic = 0 AND doc_id % 6 = 0"), ("M08", "BLOCKER", "label", f"{_W} WHERE toxic = 0 AND quality = 1")))(_rule("M08", _meta))
_NORM = "trim(regexp_replace(regexp_replace(lower(strip_accents({})), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_BLOCKS = f"(SELECT rid, 'note' AS field, left(text, CASE WHEN doc_id % 2 = 0 THEN 250 ELSE 150 END) AS text FROM {_W} UNION ALL SELECT rid, 'body', text FROM {_W})"
_T = f"(SELECT rid, field, text, {_NORM.format('text')} AS n, field = 'body' OR length(text) > 200 AS long FROM {_BLOCKS} WHERE regexp_matches(text, '[^\\s]'))"


def _text_sql(code: str, severity: str, where: str) -> str:
    return f"SELECT '{code}' AS code, '{severity}' AS severity, rid AS record_id, field FROM {_T} WHERE {where}"


def _has(*words: str) -> str:
    return " + ".join(f"CAST(regexp_matches(n, '\\b{w}\\b') AS INT)" for w in words)


_MARKS = f"array_to_string(list_filter([{', '.join(f'''CASE WHEN regexp_matches(n, '\\b{w}\\b') THEN '{w}' END''' for w in CONFIG.generated)}], lambda x: x IS NOT NULL), ', ')"
for _code, _severity, _where in (
    ("Q01", "BLOCKER", _has("licensed under", "mentpa") + " > 0"),
    ("Q02", "MAJOR", "long AND right(regexp_replace(text, '\\s+$', ''), 1) NOT IN ('.', '!', '?', '»', '\"', '''', ')')"),
    ("Q03", "MINOR", f"long AND {_has('the', 'der')} > 0"),
    ("Q04", "MAJOR", f"long AND {_has(*CONFIG.generated)} >= 2"),
    ("Q08", "MINOR", f"long AND {_has('of', 'une')} > 0"),
):
    _message = f", 'reads as generated: ' || {_MARKS} AS message" if _code == "Q04" else ""
    query(f"rule_{_code}", _text_sql(_code, _severity, _where).replace(", field FROM", f", field{_message} FROM"))(_rule(_code, lambda c, code=_code: R.text_rules(c, CONFIG, (code,)), ("message",) if _message else ()))
_SENTENCES = f"(SELECT rid, {_NORM.format('x')} AS k FROM (SELECT rid, trim(unnest(string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))), ' ' || chr(9) || chr(10) || chr(13)) AS x FROM {_T} WHERE long) WHERE length(x) > 40)"
_Q07 = f"SELECT 'Q07' AS code, 'MINOR' AS severity, rid AS record_id, '-' AS field FROM {_SENTENCES} WHERE k IN (SELECT k FROM {_SENTENCES} GROUP BY k HAVING count(*) >= 3)"
query("rule_Q07", _Q07)(_rule("Q07", lambda c: R.text_rules(c, CONFIG, ("Q07",))))
query("rule_D01", _issues(("D01", "BLOCKER", "source,size", f"{_W} WHERE (source, CASE WHEN doc_id % 11 = 0 THEN 'many' ELSE CAST(n_chars AS VARCHAR) END) IN (SELECT (source, z) FROM (SELECT source, CASE WHEN doc_id % 11 = 0 THEN 'many' ELSE CAST(n_chars AS VARCHAR) END AS z FROM documents) GROUP BY source, z HAVING count(*) > 1)")))(_rule("D01", _twice))
query("rule_D02", f"SELECT 'D02' AS code, 'MAJOR' AS severity, a.rid AS record_id, 'title' AS field, 'same name as a later record: ' || b.title || ' (' || b.rid || ')' AS message FROM {_P} a JOIN (SELECT f, t, max(ord) AS ord, arg_max(title, ord) AS title, arg_max(rid, ord) AS rid FROM {_P} GROUP BY f, t) b ON a.f = b.f AND a.t <> b.t AND a.ord < b.ord")(_rule("D02", _twice, ("message",)))
query("rule_N", "SELECT unnest(['N01', 'N03', 'N04']) AS code, unnest(['MINOR', 'MINOR', 'MAJOR']) AS severity, '-' AS record_id, '-' AS field, unnest(['state vocabularies differ: [work:state]; [event:state]', 'source fields are named differently: origin: work, event; (none): person', 'no source field: person']) AS message, unnest([d + o, d + o + c, c]) AS records FROM (SELECT (SELECT count(*) FROM documents) AS d, (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM customer) AS c)")(_rule("N01,N03,N04", lambda c: R.corpus_rule_reach(c, CONFIG), ("message", "records")))


def linked(s: Source):
    """What the rules between records need of the corpus, written once."""
    return materialize(R.links(corpus(s), CONFIG), "links")


def _audit(c):
    return R.audit(c, CONFIG, AS_OF, BIRTHS)


_ALL = "(" + " UNION ALL ".join(f"SELECT code, severity, record_id FROM ({sql})" for name, sql in list(ORACLE_SQL.items()) if name.startswith("rule_")) + ")"
query("audit_counts", f"SELECT code, severity, count(*) AS n FROM {_ALL} GROUP BY 1, 2")(lambda s: _audit(corpus(s)).groupBy("code", "severity").agg(F.count("*").alias("n")))
_HELD = f"""(SELECT rid AS id, 'work' AS entity, CAST((source IS NOT NULL)::INT + 2 * (lang <> 'fr')::INT + 2 * coalesce((quality = 1)::INT, 0) + (doc_id % 11 = 0 OR n_chars IS NOT NULL)::INT + coalesce(regexp_matches(left(text, CASE WHEN doc_id % 2 = 0 THEN 250 ELSE 150 END), '[^\\s]')::INT, 0) + 3 * (author IS NOT NULL)::INT AS BIGINT) AS have,
CAST(10 AS BIGINT) AS all_weight, CASE doc_id % 4 WHEN 0 THEN 'VALID' WHEN 1 THEN 'INCOMPLETE' ELSE 'UNVERIFIED' END AS epistemic FROM {_W}
UNION ALL SELECT rid, 'person', 6, 6, 'UNVERIFIED' FROM {_PEOPLE}
UNION ALL SELECT rid, 'event', 2 + (o_orderkey % 10 <> 3)::INT, 3, 'INCOMPLETE' FROM {_E})"""
query(
    "scores",
    f"""SELECT entity, id, have, all_weight, epistemic, blockers, majors, minors, concat_ws('|', CASE WHEN blockers > 0 THEN 'blockers' END, CASE WHEN have < 0.7 * all_weight THEN 'completeness' END) AS reasons, blockers = 0 AND have >= 0.7 * all_weight AS exportable
FROM (SELECT h.*, coalesce(b, 0) AS blockers, coalesce(m, 0) AS majors, coalesce(n, 0) AS minors FROM {_HELD} h LEFT JOIN (SELECT record_id, CAST(count_if(severity = 'BLOCKER') AS BIGINT) AS b, CAST(count_if(severity = 'MAJOR') AS BIGINT) AS m, CAST(count_if(severity = 'MINOR') AS BIGINT) AS n FROM {_ALL} GROUP BY 1) ON record_id = id)""",
)(lambda s: (lambda c: R.scores(c, _audit(c), CONFIG))(corpus(s)).select("entity", "id", "have", "all_weight", "epistemic", "blockers", "majors", "minors", F.array_join("reasons", "|").alias("reasons"), "exportable"))
_PLAN = f"""(SELECT 'act-' || left(sha256('{{"code":"R03","entity":"' || entity || '","field":"' || field || '","message":"missing inverse: ' || target || '","record_id":"' || rid || '","severity":"MINOR","title":"' || title || '"}}' || chr(10) || CAST(turn AS VARCHAR)), 20) AS action_id, rid AS record_id, target, turn FROM ({_R03}) CROSS JOIN (SELECT unnest([1, 2]) AS turn))"""
query("remediation", f"SELECT action_id, 'AUTO_FIX' AS classification, 'LOCAL_COPY_ONLY' AS \"authorization\", 'LOW' AS risk, record_id FROM {_PLAN} WHERE turn = 1")(
    lambda s: R.remediation(R.relation_rules(linked(s), CONFIG).filter("code = 'R03'")).filter("code = 'R03'").select("action_id", "classification", "authorization", "risk", "record_id")
)
query("remediation_classes", f"SELECT classification, risk, count(*) AS n FROM {_ALL} JOIN (VALUES {', '.join(str((c, a, r)) for c, (a, r) in R.REMEDY.items())}) AS remedy(rule, classification, risk) ON code = rule GROUP BY 1, 2")(
    lambda s: R.remediation(_audit(corpus(s))).groupBy("classification", "risk").agg(F.count("*").alias("n"))
)


@query("remediation_apply", f"SELECT action_id, CASE WHEN row_number() OVER (PARTITION BY record_id, target ORDER BY action_id) = 1 THEN 'APPLIED' ELSE 'SKIPPED_ALREADY_RESOLVED' END AS status FROM {_PLAN}")
def remediation_apply(s: Source):
    """Every issue twice, so that each fix is applied once and skipped once."""
    c = linked(s)
    r03 = materialize(R.relation_rules(c, CONFIG).filter("code = 'R03'"), "missing")
    return R.apply_statuses(R.remediation(r03.unionAll(r03)), c, CONFIG)


query("remediation_left", "SELECT CAST(0 AS BIGINT) AS n")(lambda s: R.relation_rules(R.apply_inverses(linked(s), CONFIG), CONFIG).filter("code = 'R03'").agg(F.count("*").alias("n")))
query("title_forms", "SELECT 'p' || CAST(c_custkey AS VARCHAR) AS id, 'ann lee' || CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 20 ELSE (c_custkey + 17) % 20 END AS VARCHAR) AS form FROM customer")(lambda s: corpus(s).filter("entity = 'person'").select("id", X.name_form(F.col("title")).alias("form")))
