"""Text queries: each row of a table through the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X

from .adapters import Source

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def keep(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return keep


_NORM = "trim(regexp_replace(regexp_replace(lower(strip_accents({})), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
query("text_norm", f"SELECT doc_id, sha256({_NORM.format('text')}) AS norm_sha FROM documents")(lambda s: s.t("documents").select("doc_id", F.sha2(X.norm(F.col("text")), 256).alias("norm_sha")))
query(
    "text_quality",
    """SELECT doc_id, n AS lines, numeric AS numeric_lines, short AS short_lines, coalesce(numeric / nullif(n, 0), 0) AS numeric_share, coalesce(short / nullif(n, 0), 0) AS short_share, n > 0 AND (numeric / n > 0.25 OR short / n > 0.35) AS garbled
FROM (SELECT doc_id, CAST(len(l) AS BIGINT) AS n, CAST(len(list_filter(l, lambda x: regexp_matches(x, '^[\\d\\s.,/\\-+€%]+$'))) AS BIGINT) AS numeric, CAST(len(list_filter(l, lambda x: length(x) <= 5)) AS BIGINT) AS short
FROM (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\\r\\n|[\\n\\r\\x0B\\x0C]'), lambda x: trim(x, ' ' || chr(9))), lambda x: x <> '') AS l FROM documents))""",
)(lambda s: s.t("documents").select("doc_id", X.text_quality(F.col("text")).alias("q")).select("doc_id", "q.*"))
query(
    "fixed_chunks",
    """SELECT doc_id, CAST(s // 1300 AS BIGINT) AS chunk, CAST(length(substr(t, CAST(s + 1 AS BIGINT), 1500)) AS BIGINT) AS n, md5(substr(t, CAST(s + 1 AS BIGINT), 1500)) AS chunk_md5
FROM (SELECT doc_id, t, unnest(generate_series(0, greatest(length(t) - 201, 0), 1300)) AS s FROM (SELECT doc_id, trim(chr(9) || text || chr(10), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM documents))""",
)(lambda s: s.t("documents").select("doc_id", F.posexplode(X.fixed_chunks(F.concat(F.lit("\t"), "text", F.lit("\n")))).alias("chunk", "c")).select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.length("c").cast("long").alias("n"), F.md5("c").alias("chunk_md5")))


def _ends(pattern: str) -> str:
    """Where (in characters) a text may be cut by one of the patterns."""
    return f"SELECT doc_id, CAST(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS b FROM (SELECT doc_id, unnest(m) AS m, unnest(range(len(m))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '(?s).*?(?:{pattern})') AS m FROM documents))"


_CUTS = "(" + _ends("\\n\\n+") + " UNION " + _ends("[.!?。！？][\"''»”)]*\\s+") + " UNION SELECT doc_id, length(text) FROM documents WHERE text <> '')"
query(
    "lossless_chunks",
    f"""WITH RECURSIVE cuts AS MATERIALIZED {_CUTS}, step AS (
SELECT doc_id, CAST(0 AS BIGINT) AS start, CAST(CASE WHEN length(text) <= 2000 THEN length(text) ELSE coalesce((SELECT max(b) FROM cuts c WHERE c.doc_id = d.doc_id AND b <= 2000 AND b > 0), 2000) END AS BIGINT) AS stop, CAST(length(text) AS BIGINT) AS n FROM documents d WHERE text IS NOT NULL
UNION ALL SELECT s.doc_id, s.stop, CAST(coalesce((SELECT max(b) FROM cuts c WHERE c.doc_id = s.doc_id AND b <= s.stop + 2000 AND b > s.stop), s.stop + 2000) AS BIGINT), n FROM step s WHERE s.stop < n)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS BIGINT) AS chunk, CAST(length(c) AS BIGINT) AS n, md5(c) AS chunk_md5 FROM (SELECT d.doc_id, start, substr(text, start + 1, stop - start) AS c FROM step s JOIN documents d ON s.doc_id = d.doc_id)""",
)(lambda s: s.t("documents").filter("text is not null").select("doc_id", F.posexplode(X.lossless_chunks(2000)(F.col("text"))).alias("chunk", "c")).select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.length("c").cast("long").alias("n"), F.md5("c").alias("chunk_md5")))
query(
    "chunk_halves",
    f"WITH cuts AS MATERIALIZED {_CUTS} SELECT d.doc_id, CAST(coalesce(arg_min(b, (abs(b - length(text) // 2), b)) FILTER (WHERE b < length(text)), length(text) // 2) AS BIGINT) AS cut FROM documents d LEFT JOIN cuts c ON c.doc_id = d.doc_id AND b > 0 WHERE length(text) > 1 GROUP BY d.doc_id, text",
)(lambda s: s.t("documents").filter("length(text) > 1").select("doc_id", X.halves()(F.col("text")).alias("h")).select("doc_id", F.length(F.get("h", F.lit(0))).cast("long").alias("cut")))
query("paragraph_chunks", "SELECT doc_id, replace(text, chr(10) || chr(10), chr(10)) AS whole, true AS within FROM documents")(
    lambda s: s.t("documents").select("doc_id", X.paragraph_chunks(3000)(F.col("text")).alias("c"), "text").select("doc_id", F.when(F.replace(F.array_join("c", ""), F.lit("\n"), F.lit("")) == F.replace("text", F.lit("\n"), F.lit("")), F.replace("text", F.lit("\n\n"), F.lit("\n"))).alias("whole"), F.forall("c", lambda x: F.length(x) <= 3000).alias("within"))
)


_HOST = "regexp_replace(lower(regexp_extract(b, '^[^/]*', 0)), '^www\\.', '')"
query("url_normalize", f"SELECT page_id, regexp_replace({_HOST} || regexp_extract(b, '^[^/]*(.*)$', 1), '/+$', '') AS url FROM (SELECT page_id, regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '') AS b FROM pages)")(
    lambda s: s.t("pages").select("page_id", X.normalize_url(F.col("url")).alias("url"))
)
query("year_extract", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR) ELSE '' END AS year, CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR) AS year_in FROM orders")(
    lambda s: (lambda t: s.t("orders").select("o_orderkey", X.year(t).alias("year"), X.year_in(t).alias("year_in")))(F.concat(F.lit("no 12345, "), F.when(F.col("o_orderkey") % 3 == 0, "c").otherwise("of "), F.to_date("o_orderdate").cast("string").substr(1, 4), F.lit(" x")))
)
query(
    "parse_dates",
    "SELECT o_orderkey, CASE o_orderkey % 9 WHEN 3 THEN NULL WHEN 4 THEN CAST(year(o_orderdate) || '-01-01' AS DATE) WHEN 7 THEN CAST(year(o_orderdate) || '-01-01' AS DATE) ELSE CAST(o_orderdate AS DATE) END AS d FROM orders",
)(
    lambda s: s.t("orders").select("o_orderkey", X.parse_date(F.expr("CASE pmod(o_orderkey, 9) WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'd/M/yyyy') WHEN 2 THEN date_format(o_orderdate, ' dd-MM-yyyy ') WHEN 3 THEN 'soon' WHEN 4 THEN concat(' ', year(o_orderdate)) WHEN 5 THEN date_format(o_orderdate, 'yyyy/M/d -> 2001') WHEN 6 THEN concat(date_format(o_orderdate, 'dd.MM.yyyy'), '→2001-01-01') WHEN 7 THEN concat('about ', year(o_orderdate), '\t -> 1850') ELSE concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00:00') END")).alias("d"))
)
_SECRET = "'(password|passwd|token|secret|authorization)(\\s*[=:]\\s*)([^\\s]+)', '\\1\\2[REDACTED]', 'gi'"
query("redact", f"SELECT doc_id, md5(regexp_replace(text, {_SECRET})) AS redacted_md5 FROM documents")(lambda s: s.t("documents").select("doc_id", F.md5(X.redact(F.col("text"), None)).alias("redacted_md5")))
query("redact_fields", f"SELECT event_id, left(regexp_replace(props || ' Authorization: Basic' || event_id || ' token=x', {_SECRET}), 4096) AS field FROM events")(
    lambda s: s.t("events").select("event_id", X.redact(F.concat("props", F.lit(" Authorization: Basic"), F.col("event_id").cast("string"), F.lit(" token=x"))).alias("field"))
)
_PLANTED = (" sk-0123456789abcdefghij", " x=/home/ann/y", " Authorization: 'abcd1234'", " -----BEGIN EC PRIVATE KEY-----", " secret: x, -----BEGIN PUBLIC PRIVATE KEY-----, task-0123456789abcdefghijk, api_key=12345678")
_PATTERNS = (
    ("personal_absolute_path", "(?:^|[\\s''\"=`])(?:/Users/[^/\\s]+|/home/[^/\\s]+)(?:/|\\b)"), ("private_key", "-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"),
    ("credential_assignment", "(?i)\\b(?:password|passwd|token|secret|authorization)\\s*[:=]\\s*[''\"]?[A-Za-z0-9_./+=-]{8,}"), ("api_key", "\\bsk-[A-Za-z0-9_-]{20,}\\b"),
)
query("sensitive", f"SELECT doc_id, concat_ws('|', {', '.join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in _PATTERNS)}) AS findings FROM (SELECT doc_id, text || [{', '.join(repr(x) if chr(39) not in x else chr(39) + x.replace(chr(39), chr(39) * 2) + chr(39) for x in _PLANTED)}][doc_id % 7 + 1] AS t FROM documents WHERE text IS NOT NULL AND doc_id % 7 < 5 UNION ALL SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND doc_id % 7 >= 5)")(
    lambda s: s.t("documents").filter("text is not null").select("doc_id", F.array_join(X.sensitive_findings(F.concat("text", F.coalesce(F.get(F.array(*map(F.lit, _PLANTED)), (F.col("doc_id") % 7).cast("int")), F.lit("")))), "|").alias("findings"))
)
query("slug_hash", "SELECT p_partkey, trim(regexp_replace(lower(p_name || '--' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug, p_partkey || '' AS key FROM part")(lambda s: s.t("part").select("p_partkey", X.slug(F.concat_ws("--", "p_name", "p_brand")).alias("slug"), F.col("p_partkey").cast("string").alias("key")))
query("name_form", "SELECT c_custkey, array_to_string(list_sort(list_filter(string_split(trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) > 1)), ' ') AS form FROM customer")(lambda s: s.t("customer").select("c_custkey", X.name_form(F.col("c_name")).alias("form")))
_TAILS = ("On Monday someone wrote:", "Il giorno 3 marzo Anna HA SCRITTO", "-----  Original Message", "Sent with Proton Mail secure", " Confidentiality notice: private")
query("strip_quoted", "SELECT conv_id, turn, md5(trim(regexp_replace(array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^\\s*>')), lambda x: rtrim(x, ' ' || chr(9))), chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10))) AS kept_md5 FROM conversations")(
    lambda s: s.t("conversations").select("conv_id", "turn", F.md5(X.strip_quoted(F.concat(F.col("text"), F.lit("  \n> quoted\n\n\n\n >> more\n"), F.get(F.array(*map(F.lit, _TAILS)), F.pmod(F.xxhash64("conv_id"), F.lit(5)).cast("int")), F.lit("\nold text")))).alias("kept_md5"))
)
query("clean_layout", "SELECT doc_id, md5(trim(regexp_replace(array_to_string(list_transform(string_split(text || chr(10) || chr(10) || 'a   b   c', chr(10)), lambda x: regexp_replace(regexp_replace(x, '\\s+$', ''), ' {4,}', '   ', 'g')), chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13))) AS clean_md5 FROM documents")(
    lambda s: s.t("documents").select("doc_id", F.md5(X.clean_layout(F.concat("text", F.lit("\fa     b    c  \n\n\n\n")))).alias("clean_md5"))
)
query("bulk_mail", "SELECT doc_id, doc_id % 3 = 0 OR lang IN ('de', 'fr') AS bulk FROM documents")(
    lambda s: s.t("documents").select("doc_id", X.is_bulk(F.expr("CASE WHEN doc_id % 3 = 0 THEN '<mailto:x>' WHEN doc_id % 3 = 1 THEN '' END"), F.expr("CASE lang WHEN 'de' THEN 'Bulk' WHEN 'fr' THEN 'JUNK' ELSE 'first-class' END")).alias("bulk"))
)
query("as_list", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || '~b' WHEN p_partkey % 3 = 1 THEN p_name || '~' || p_brand ELSE '' END AS items FROM part")(
    lambda s: s.t("part").select("p_partkey", F.array_join(X.as_list(F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(' ["'), "p_name", F.lit('","b"]'))).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" , ,"), "p_brand"))), "~").alias("items"))
)
query("truncate_middle", "SELECT doc_id, CASE WHEN length(text) > 400 THEN left(text, 200) || chr(10) || '[...]' || chr(10) || right(text, 200) ELSE text END AS cut FROM documents")(lambda s: s.t("documents").select("doc_id", X.truncate_middle(F.col("text"), 400).alias("cut")))
query("safe_text", "SELECT doc_id, CASE WHEN length(t) > 60 THEN rtrim(left(t, 58)) || ' …' ELSE t END AS preview FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)")(lambda s: s.t("documents").select("doc_id", X.safe_text(F.col("text"), 60).alias("preview")))
query("human_size", "SELECT doc_id, CASE WHEN n < 1024 THEN CAST(n AS VARCHAR) || ' B' WHEN n < 1048576 THEN format('{:.1f} KB', n / 1024) ELSE format('{:.1f} MB', n / 1048576) END AS size FROM (SELECT doc_id, CAST(n_chars * n_chars AS BIGINT) AS n FROM documents WHERE n_chars IS NOT NULL AND n_chars < 30000)")(
    lambda s: s.t("documents").filter("n_chars < 30000").select("doc_id", X.human_size((F.col("n_chars") * F.col("n_chars")).cast("long")).alias("size"))
)
query("key_lines", "SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '' AND length(x) <= 220 AND regexp_matches(x, '(?i)license|rights'))[1:12], chr(10)) AS found FROM documents")(
    lambda s: s.t("documents").select("doc_id", F.array_join(X.key_lines(F.col("text"), ["license", "rights"]), "\n").alias("found"))
)
query("key_numbers", "SELECT p_partkey, array_to_string(list_sort(list_distinct(['7%', CAST(p_size AS VARCHAR) || '%'])), ' ') AS numbers FROM part WHERE p_size <> 7")(
    lambda s: s.t("part").filter("p_size <> 7").select("p_partkey", F.array_join(F.array_sort(X.key_numbers(F.concat(F.lit("7% and "), F.col("p_size").cast("string"), F.lit("% of 7%")), [r"\d+%"])), " ").alias("numbers"))
)
query("headings", "SELECT doc_id, lang || '|' || source AS headings FROM documents")(lambda s: s.t("documents").select("doc_id", F.array_join(X.headings(F.concat(F.lit("# "), "lang", F.lit("\nplain\n ###   "), "source", F.lit("\n#no"))), "|").alias("headings")))
_PHRASES = ("entro la fine del mese", "ENTRO  12 giorni", "entro il 3 del mese prossimo", "quanto prima", "entro domani")
query(
    "deadlines",
    "SELECT doc_id, value > 0.5 OR doc_id % 5 < 4 AS present, trim(CASE WHEN doc_id % 5 < 4 THEN right(head, 80) || phrase || left(tail, 80) ELSE left(head || phrase || tail, 300) END) AS excerpt, CASE WHEN value >= 0.5 THEN 'alto' WHEN value >= 0.4 THEN 'medio' WHEN value >= 0.2 THEN 'basso' ELSE 'nessuno' END AS risk "
    f"FROM (SELECT doc_id, (doc_id % 10) / 10 AS value, repeat('x ', CAST(doc_id % 70 AS INTEGER)) AS head, ['{(chr(39) + ', ' + chr(39)).join(_PHRASES)}'][doc_id % 5 + 1] AS phrase, repeat(' y', CAST(doc_id % 90 AS INTEGER)) AS tail FROM documents)",
)(
    lambda s: (lambda t, p: s.t("documents").select("doc_id", X.deadline_present(t, p, 0.6).alias("present"), X.deadline_excerpt(t).alias("excerpt"), X.risk_level(p, p + 0.1, p + 0.3).alias("risk")))(
        F.concat(F.repeat(F.lit("x "), (F.col("doc_id") % 70).cast("int")), F.get(F.array(*map(F.lit, _PHRASES)), (F.col("doc_id") % 5).cast("int")), F.repeat(F.lit(" y"), (F.col("doc_id") % 90).cast("int"))), (F.col("doc_id") % 10) / 10
    )
)
query("frontmatter", "SELECT doc_id, lang AS title, '2024-01-0' || CAST(doc_id % 9 + 1 AS VARCHAR) AS date, 'own: ' || source AS other, 'body' AS body, '---' || chr(10) || 'title: \"' || lang || '\"' || chr(10) || 'tags: [\"a\", \"b\"]' || chr(10) || 'own: ' || source || chr(10) || '---' AS rendered FROM documents")(
    lambda s: (lambda f: f.select("doc_id", F.element_at("f.known", F.lit("title")).alias("title"), F.element_at("f.known", F.lit("date")).alias("date"), F.array_join("f.other", "|").alias("other"), "f.body", X.render_frontmatter({"title": X.quoted(F.element_at("f.known", F.lit("title"))), "tags": X.quoted_list(F.array(F.lit("a"), F.lit("b")))}, F.col("f.other")).alias("rendered")))(
        s.t("documents").select("doc_id", X.split_frontmatter(F.concat(F.lit('---\ntitle:  "'), "lang", F.lit('"\ndate: 2024-01-0'), (F.col("doc_id") % 9 + 1).cast("string"), F.lit("\nown: "), "source", F.lit("\n---\n\nbody"))).alias("f"))
    )
)
query("content_hash", "SELECT p_partkey, sha256(p_name || chr(31) || '' || chr(31) || CAST(p_size AS VARCHAR)) AS joined, sha256(length(p_name) || ':' || p_name || '0:' || length(CAST(p_size AS VARCHAR)) || ':' || CAST(p_size AS VARCHAR)) AS prefixed FROM part")(
    lambda s: s.t("part").select("p_partkey", X.content_hash(F.col("p_name"), F.lit(None), F.col("p_size")).alias("joined"), X.length_prefixed(F.col("p_name"), F.lit(None), F.col("p_size")).alias("prefixed"))
)
query("split_multi", "SELECT p_partkey, array_to_string(list_filter(list_transform(string_split_regex(p_name || ' , ' || p_brand || '; ;' || p_type, '[,;•|/]'), lambda x: trim(x)), lambda x: x <> ''), '~') AS parts FROM part")(
    lambda s: s.t("part").select("p_partkey", F.array_join(X.split_multi(F.concat(F.col("p_name"), F.lit("\t,\n"), F.col("p_brand"), F.lit("; \t;"), F.col("p_type"))), "~").alias("parts"))
)
query("marker_gate", "SELECT doc_id, CAST(strpos(lower(text), 'license') - 1 AS BIGINT) AS place, strpos(lower(text), 'license') - 1 BETWEEN 0 AND 500 AS near_top FROM documents")(
    lambda s: s.t("documents").select("doc_id", X.marker_at(F.col("text"), "license").cast("long").alias("place"), X.near_top(F.col("text"), "license", 500).alias("near_top"))
)
_BARE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<script\\b[^>]*>.*?</script\\s*>', '', 'gis'), '<style\\b[^>]*>.*?</style\\s*>', '', 'gis'), '<(br|p|div|tr|li)\\b[^>]*>', chr(10), 'gi')"
_TEXT = f"regexp_replace({_BARE}, '</?[A-Za-z!][^>]*>', '', 'gs')"
for _entity, _char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&amp;", "'&'")):
    _TEXT = f"replace({_TEXT}, '{_entity}', {_char})"
query("html_text", f"SELECT page_id, trim(regexp_replace({_TEXT}, '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM pages")(lambda s: s.t("pages").select("page_id", X.html_to_text(F.col("html"), closed=True).alias("text")))
query("pipe_rows", "SELECT coalesce(CAST(event_id AS VARCHAR), '') || '|' || coalesce(nullif(event_type, 'view'), '') || '|' || props AS line FROM events")(lambda s: s.t("events").select(X.pipe_row(F.col("event_id"), F.expr("nullif(event_type, 'view')"), F.col("props")).alias("line")))
