"""Claims: resolve, consolidate, corroborate, gate, patch, route, discover, govern.

Where an answer depends on order (the first text seen, the last claim of a predicate) the rows carry ord.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X

#: Statuses, strongest first; any other ranks after them, and none is that of the archive.
PRECEDENCE = ("VERIFIED", "CONFIRMED", "VALID", "SUPPORTED_BY_ARCHIVE", "SUPPORTED_BY_WEB", "DISPUTED", "UNVERIFIED", "INFERRED", "CONFLICTING", "MISSING")
DEFAULT_STATUS = "SUPPORTED_BY_ARCHIVE"
#: Statuses that never satisfy a mandatory field, and those that a patch may be built on.
BLOCKING = ("INFERRED", "MISSING", "CONFLICTING", "SUPPORTED_BY_WEB")


SUPPORTED = ("SUPPORTED_BY_ARCHIVE", "VERIFIED", "CONFIRMED", "VALID")


def rank(status: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for i, s in enumerate(PRECEDENCE) for x in (s, i)])
    return F.coalesce(F.element_at(ranks, F.coalesce(status, F.lit(""))), F.lit(len(PRECEDENCE)))


def resolve(raw: DataFrame, rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """raw with subject_id, subject_match, object_id, object_match and resolution.  A side's key is its normalised text,
    through the aliases; one row of that title: MATCH; none and a key that isn't empty: NEW_ENTITY with an id made from
    the key; else AMBIGUOUS.  Candidates are first brought to a row a key, so a frequent title joins once, and aliases to
    their names' titles, so that texts meet their own row and not the one of a name that many aliases share."""
    known = known_texts(rows, aliases)
    return with_resolution(resolve_side(resolve_side(raw, "subject", known), "object", known))


def known_texts(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """_raw, _key, _n, _id: of each normalised title or alias, the title it stands for, how many rows have that, and one's
    id."""
    titles = rows.select(X.norm(F.col("title")).alias("_k"), "id").groupBy("_k").agg(F.count("*").alias("_n"), F.min("id").alias("_id"))
    a = aliases.filter("alias IS NOT NULL").select(F.col("alias").alias("_raw"), F.coalesce("name", "alias").alias("_key"))
    known = titles.join(a, F.col("_k") == F.col("_raw"), "left_anti").select(F.col("_k").alias("_raw"), F.col("_k").alias("_key"), "_n", "_id")
    return known.unionByName(a.join(titles, F.col("_key") == F.col("_k"), "left").select("_raw", "_key", "_n", "_id"))


def resolve_side(raw: DataFrame, side: str, known: DataFrame) -> DataFrame:
    """raw, or any table of texts that claims are made of, with the id and match of one side."""
    out = raw.withColumn("_text", X.norm(F.col(f"{side}_raw"), "none")).join(known, F.col("_text") == F.col("_raw"), "left")
    out = out.withColumn("_key", F.coalesce("_key", "_text"))
    new = F.col("_n").isNull() & (F.col("_key") != "")
    ident = F.when(F.col("_n") == 1, F.col("_id")).when(new, F.concat(F.lit("new:"), F.left(F.sha2("_key", 256), F.lit(16))))
    match = F.when(F.col("_n") == 1, "MATCH").when(new, "NEW_ENTITY").otherwise("AMBIGUOUS")
    return out.withColumns({f"{side}_id": ident, f"{side}_match": match}).drop("_text", "_raw", "_key", "_n", "_id")


def with_resolution(out: DataFrame) -> DataFrame:
    unclear = (F.col("subject_match") == "AMBIGUOUS") | (F.col("object_match") == "AMBIGUOUS")
    return out.withColumn("resolution", F.when(unclear, "PENDING_RESOLUTION").otherwise("RESOLVED"))


def claim_ident(key: Column) -> Column:
    return F.concat(F.lit("claim:"), F.sha2(key, 256))


def consolidate(resolved: DataFrame, dealt: bool = False, hashed: bool = True, **more: Column) -> DataFrame:
    """One row a claim: id (of both ends, the normalised predicate and the qualifiers, as JSON), first texts by ord, best
    status, file ids and excerpts in order of appearance.  Without a column qualifiers there are none.

    dealt: resolved lies by subject_id already; hashed=False leaves the id as that JSON, for plans that shuffle it and show
    claim_ident of it; more: further aggregates of the rows of a claim."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    held = resolved if "qualifiers" in resolved.columns else resolved.withColumn("qualifiers", none)
    said = F.map_from_entries(F.array_sort(F.map_entries(F.coalesce("qualifiers", none))))
    key = F.concat(F.lit("["), F.concat_ws(",", X.quoted(F.col("subject_id")), X.quoted(X.norm(F.col("predicate"), "none")), X.quoted(F.col("object_id")), F.to_json(said)), F.lit("]"))
    # rows travel once and by subject, as what follows wants them, before anything is made of them: as partial lists they
    # would be twice as wide
    held = held.filter("resolution = 'RESOLVED'") if dealt else held.filter("resolution = 'RESOLVED'").repartition("subject_id")
    held = held.withColumn("status", F.coalesce("status", F.lit(DEFAULT_STATUS)))
    held = held.withColumn("_key", key).withColumn("_rank", rank(F.col("status")))

    def ordered(column: str):
        return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", column))), lambda s: s[column]))

    out = held.groupBy("subject_id", "_key").agg(
        F.min_by("subject_raw", "ord").alias("subject"),
        F.min_by("predicate", "ord").alias("predicate"),
        F.min_by("object_raw", "ord").alias("object"),
        F.min_by("qualifiers", "ord").alias("qualifiers"),
        F.min_by("status", F.struct("_rank", "ord")).alias("status"),
        ordered("file_id").alias("source_file_ids"),
        ordered("evidence_excerpt").alias("source_excerpts"),
        F.min("ord").alias("ord"),
        *[c.alias(name) for name, c in more.items()],
    )
    ident = (claim_ident(F.col("_key")) if hashed else F.col("_key")).alias("claim_id")
    return out.select(ident, "subject", "predicate", "object", "subject_id", "qualifiers", "status", "source_file_ids", "source_excerpts", "ord", *more)


def _asked(entities: DataFrame, claims: DataFrame, names: list[str]) -> DataFrame:
    """entity_id, name and status (of its last claim) for every entity and configured name: a literal array, no join."""
    last = claims.groupBy(F.col("subject_id").alias("_e"), X.norm(F.col("predicate")).alias("_p")).agg(F.max_by("status", "ord").alias("status"))
    each = entities.select("entity_id").distinct().withColumn("name", F.explode(F.array(*map(F.lit, names)).cast("array<string>")))
    return each.join(last, (F.col("entity_id") == F.col("_e")) & (X.norm(F.col("name")) == F.col("_p")), "left").select("entity_id", "name", "status")


def _blocked(status: Column) -> Column:
    return status.isNull() | status.isin(*BLOCKING)


def gate(entities: DataFrame, claims: DataFrame, mandatory: list[str]) -> DataFrame:
    """entities (entity_id, match) with the gate: REVIEW_REQUIRED if ambiguous or conflicting; a mandatory predicate
    missing or blocked by its last claim's status: INSUFFICIENT_EVIDENCE for a new entity, else REVIEW_REQUIRED;
    READY_FOR_NOTION otherwise."""
    blocked = _asked(entities, claims, mandatory).groupBy(F.col("entity_id").alias("_id")).agg(F.bool_or(_blocked(F.col("status"))).alias("_b"))
    out = entities.join(blocked, F.col("entity_id") == F.col("_id"), "left")
    return out.withColumn("gate", gate_of(F.col("match"), F.coalesce("_b", F.lit(False)))).drop("_id", "_b")


def gate_of(match: Column, blocked: Column) -> Column:
    return (
        F.when(match == "AMBIGUOUS", "REVIEW_REQUIRED")
        .when(blocked & (match == "NEW_ENTITY"), "INSUFFICIENT_EVIDENCE")
        .when(blocked | (match == "EXISTS_CONFLICTING"), "REVIEW_REQUIRED")
        .otherwise("READY_FOR_NOTION")
    )


def compare_entity(names: DataFrame, rows: DataFrame) -> DataFrame:
    """names (entity_type, name): NEW_ENTITY, EXISTS_AND_MATCHES or AMBIGUOUS by titles within the type."""
    t = rows.groupBy(F.col("entity_type").alias("_t"), X.norm(F.col("title")).alias("_k")).agg(F.count("*").alias("_n"))
    out = names.join(t, (F.col("entity_type") == F.col("_t")) & (X.norm(F.col("name")) == F.col("_k")), "left")
    said = F.when(F.col("_n").isNull(), "NEW_ENTITY").when(F.col("_n") == 1, "EXISTS_AND_MATCHES").otherwise("AMBIGUOUS")
    return out.withColumn("match", said).drop("_t", "_k", "_n")


def provenance(claims: DataFrame) -> DataFrame:
    """claim_id and file_id; a claim without a source is an error."""
    some = F.when(F.size("source_file_ids") > 0, F.col("source_file_ids")).otherwise(F.raise_error(F.lit("CLAIM_WITHOUT_EVIDENCE")).cast("array<string>"))
    return claims.select("claim_id", F.explode(some).alias("file_id"))


def corroborate(claims: DataFrame, sources: DataFrame | None = None, k: int = 2) -> DataFrame:
    """claims whose status SUPPORTED_BY_WEB becomes VERIFIED where at least k different normalised URLs support them.
    sources: file_id, url; without them claims have urls, those of their files by urls_of_files."""
    web = F.col("status") == "SUPPORTED_BY_WEB"
    if sources is None:
        return claims.withColumn("status", F.when(web & (F.size(F.array_distinct(F.coalesce("urls", F.array()))) >= k), "VERIFIED").otherwise(F.col("status"))).drop("urls")
    u = sources.select(F.col("file_id").alias("_f"), X.normalize_url(F.col("url")).alias("_u"))
    each = claims.filter("status = 'SUPPORTED_BY_WEB'").select("claim_id", F.explode("source_file_ids").alias("_id"))
    n = each.join(u, F.col("_id") == F.col("_f")).groupBy(F.col("claim_id").alias("_c")).agg(F.countDistinct("_u").alias("_n"))
    out = claims.join(n, F.col("claim_id") == F.col("_c"), "left")
    return out.withColumn("status", F.when(web & (F.coalesce("_n", F.lit(0)) >= k), "VERIFIED").otherwise(F.col("status"))).drop("_c", "_n")


def urls_of_files(sources: DataFrame) -> DataFrame:
    """file_id and urls, its normalised ones.  sources: file_id, url."""
    return sources.groupBy("file_id").agg(F.collect_set(X.normalize_url(F.col("url"))).alias("urls"))


FINDING = ("predicate", "object_raw", "url", "evidence_excerpt")


def finding_faults(findings: DataFrame) -> DataFrame:
    """Findings that lack what they need, and what."""
    lacking = F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", c) for c in FINDING])
    out = findings.withColumn("missing", F.array_join(F.filter(lacking, lambda c: c.isNotNull()), ","))
    return out.filter("missing <> ''")


def ingest_findings(findings: DataFrame) -> DataFrame:
    """Web findings as claims: file id from URL and excerpt, years cut out of values of that type.  All or nothing: one
    finding that lacks a field fails the whole."""
    bad = finding_faults(findings).select("missing").first()
    if bad:
        raise ValueError(f"WEB_FINDING_MISSING_FIELD:{bad['missing']}")
    u = X.normalize_url(F.col("url"))
    ident = F.concat(F.lit("sha256:"), F.sha2(F.concat(u, F.lit("|"), F.col("evidence_excerpt")), 256))
    at = X.year_in(F.col("object_raw"))
    value = F.when((F.col("value_type") == "anno") & (at != ""), at).otherwise(F.col("object_raw"))
    out = findings.withColumns({"file_id": ident, "source_url": u, "object_raw": value})
    return out.withColumns({"status": F.lit("SUPPORTED_BY_WEB"), "source_type": F.lit("WEB")})


def retrieval_gaps(entities: DataFrame, claims: DataFrame, fields: list[str]) -> DataFrame:
    """One request an entity: entity_id, missing (the fields, sorted, joined by |, that no claim gives or only a blocked
    one)."""
    gap = _asked(entities, claims, fields).filter(_blocked(F.col("status")))
    return gap.groupBy("entity_id").agg(F.array_join(F.sort_array(F.collect_list("name")), "|").alias("missing"))


def patch(claims: DataFrame, fields: DataFrame, current: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """claim_id, action, reason and property of the claims of entities that exist or not.  CONFLICT where the status isn't
    supported, no source or no locator is known, or no field has the predicate's name; a property is an ADD where the
    entity has no value, nothing where it has this one, else an UPDATE; a relation is a CONFLICT unless its list holds the
    value.  fields: name, key, property, kind (property or relation); current: entity_id, key, value, list; index:
    file_id, paths; without it claims have located, whether any of their files has a path."""
    f = fields.select(X.norm(F.col("name")).alias("_n"), F.col("key").alias("_key"), "property", "kind")
    # an entity's values travel as one list, by entity alone, as claims lie already
    c = current.groupBy(F.col("entity_id").alias("_e")).agg(F.collect_list(F.struct(F.col("key").alias("_k"), F.col("value").alias("_v"), F.col("list").alias("_l"))).alias("_all"))
    held = ["claim_id", "subject_id", "predicate", "object", "status"]
    out = claims
    if index is not None:
        located = index.filter(F.size("paths") > 0).select(F.col("file_id").alias("_f")).distinct()
        each = claims.select(*held, F.explode_outer("source_file_ids").alias("_s")).join(located, F.col("_s") == F.col("_f"), "left")
        out = each.groupBy(*held).agg(F.bool_or(F.col("_f").isNotNull()).alias("located"))
    out = out.join(F.broadcast(f), X.norm(F.col("predicate")) == F.col("_n"), "left").join(c, F.col("subject_id") == F.col("_e"), "left")
    out = out.select(*held, "located", "_key", "property", "kind", F.inline_outer(F.filter("_all", lambda x: x["_k"] == F.col("_key"))))
    fine = F.coalesce(F.upper("status").isin(*SUPPORTED), F.lit(False)) & F.coalesce("located", F.lit(False))
    reason = (
        F.when(~fine, "UNSUPPORTED_STATUS_OR_MISSING_PROVENANCE")
        .when(F.col("_key").isNull(), "PREDICATE_NOT_IN_ARTISTA_SCHEMA")
        .when(F.col("kind") == "relation", "RELATION_TARGET_ID_NOT_RESOLVED")
    )
    there = (F.col("kind") == "relation") & F.coalesce(F.array_contains("_l", F.col("object")), F.lit(False))
    same = (F.col("kind") == "property") & F.coalesce(F.col("_v") == F.col("object"), F.lit(False))
    out = out.filter(~(fine & F.coalesce(there | same, F.lit(False))))
    action = F.when(reason.isNotNull(), "CONFLICT").when(F.coalesce("_v", F.lit("")) == "", "ADD").otherwise("UPDATE")
    return out.select("claim_id", action.alias("action"), reason.alias("reason"), "property")


#: Which body a claim becomes part of.  Parts of the predicate, section, subsection; the first that fits.
BODY_SECTIONS = ("IDENTITÀ", "PROFILO ARTISTICO", "BIOGRAFIA", "RELAZIONE", "DOCUMENTAZIONE / FONTI", "STATO EDITORIALE")
IDENTITY_PARTS = ("born", "birth", "nationality", "birthplace", "place of birth", "anno_nascita", "luogo_nascita")
BIOGRAPHY_PARTS = ("studied", "educated", "graduated", "moved", "lives", "based", "career", "biography")
HOUSE_PARTS = ("represented", "collaborat", "exhibited", "curated", "produced", "supported", "relationship")
RESEARCH_PARTS = ("theme", "themes", "research", "practice", "focus", "explores", "investigates", "concern")
LANGUAGE_PARTS = ("medium", "media", "technique", "material", "language", "style", "works with", "uses")
READING_PARTS = ("said", "states", "stated", "describes", "according to", "critic", "interpret")
#: Predicates that say what a source is, that name themes, that quote and that name means.
METADATA_PREDICATES = ("is the subject of", "is a", "has type", "is the source of")
THEME_PREDICATES = ("has themes", "themes", "theme", "research", "practice", "focus", "explores", "investigates")
QUOTE_PREDICATES = ("said", "states", "stated", "says")
MEANS_PREDICATES = ("works with", "uses", "medium", "media")
HELD_STATUSES = ("UNVERIFIED", "DISPUTED", "CONFLICTING", "MISSING")
PLACES = ("riyadh", "venice", "venezia")
#: Words that stand for one concept.
CONCEPTS = {
    "storytelling": "narrazione", "cinema": "film", "photography": "fotografia", "photographer": "fotografia", "fotografo": "fotografia", "identity": "identità", "memory": "memoria", "landscape": "paesaggio",
    "sea": "mare", "mare": "mare", "memoria": "memoria", "paesaggio": "paesaggio", "fotografia": "fotografia", "identità": "identità", "narrazione": "narrazione", "film": "film", "filmmaker": "film", "video": "video",
}


def _covered(concept: Column, body: Column) -> Column:
    """Whether the body (lower case) holds the concept or any word for it."""
    groups: dict[str, list[str]] = {}
    for word, canonical in CONCEPTS.items():
        groups.setdefault(canonical, [canonical]).append(word)
    canonical = F.create_map(*[F.lit(x) for p in CONCEPTS.items() for x in p])
    words = F.create_map(*[x for k, v in groups.items() for x in (F.lit(k), F.array(*map(F.lit, dict.fromkeys(v))))])
    own = F.coalesce(F.element_at(canonical, F.lower(concept)), F.lower(concept))
    return F.exists(F.coalesce(F.element_at(words, own), F.array(own)), lambda w: body.contains(w))


def body_candidates(claims: DataFrame, bodies: DataFrame, index: DataFrame | None, house: str) -> DataFrame:
    """Where each claim belongs in its entity's page and what to do with it: section, subsection, semantic_class, text,
    delta_text, source_id, source_path and action.  KEEP_EVIDENCE for what only describes a source; HOLD where the status
    needs a review or no locator is known; themes are compared concept by concept: KEEP_CONTEXT or KEEP_SEMANTIC if the
    body has them all, PARTIAL_ADD of the new ones, ADD; other texts KEEP_SEMANTIC if the body holds them, else ADD.
    bodies: entity_id, body; index: file_id, paths, or None where claims have source_path, their first file's first; house:
    the name of the house whose relations make a section."""
    b = bodies.select(F.col("entity_id").alias("_e"), F.lower("body").alias("_b"))
    out = claims.withColumn("source_id", F.get("source_file_ids", F.lit(0)))
    if index is not None:
        first = index.select(F.col("file_id").alias("_f"), F.get("paths", F.lit(0)).alias("source_path"))
        out = out.join(first, F.col("source_id") == F.col("_f"), "left")
    out = out.join(b, F.col("subject_id") == F.col("_e"), "left")
    p, body = F.lower(X.strip(F.coalesce("predicate", F.lit("")))), F.coalesce("_b", F.lit(""))
    subject, predicate, obj = (X.strip(F.coalesce(F.col(c), F.lit(""))) for c in ("subject", "predicate", "object"))
    words = F.lower(F.concat(p, F.lit(" "), F.coalesce("object", F.lit(""))))

    def part(c: Column, keys: tuple[str, ...]) -> Column:
        return c.rlike("|".join(X.re.escape(k) for k in keys))

    routes = [
        (part(p, IDENTITY_PARTS), "IDENTITÀ", None),
        (part(p, BIOGRAPHY_PARTS), "BIOGRAFIA", None),
        (words.contains(house.lower()) & part(words, HOUSE_PARTS), "RELAZIONE", None),
        (part(p, RESEARCH_PARTS), "PROFILO ARTISTICO", "La ricerca"),
        (part(p, LANGUAGE_PARTS), "PROFILO ARTISTICO", "Linguaggio e poetica"),
        (part(p, READING_PARTS), "PROFILO ARTISTICO", "Letture / dichiarazioni documentate"),
    ]
    section, subsection = F.lit("DOCUMENTAZIONE / FONTI"), F.lit(None).cast("string")
    for fits, name, below in reversed(routes):
        section, subsection = F.when(fits, name).otherwise(section), F.when(fits, F.lit(below).cast("string")).otherwise(subsection)
    text = (
        F.when(p.isin(*QUOTE_PREDICATES), F.concat(subject, F.lit(" dichiara: "), obj))
        .when(p.isin("has themes", "themes", "theme"), F.concat(F.lit("Temi documentati: "), obj))
        .when(p.isin(*MEANS_PREDICATES), F.concat(F.lit("Medium / tecniche documentate: "), obj))
        .when((subject != "") & (predicate != ""), F.concat(subject, F.lit(" — "), predicate, F.lit(": "), obj))
        .otherwise(obj)
    )
    out = out.withColumns({"section": section, "subsection": subsection, "text": text, "_p": p, "_body": body})
    out = out.withColumn("_concepts", X.split_multi(F.coalesce("object", F.lit(""))))
    out = out.withColumn("_editorial", F.filter("_concepts", lambda c: ~F.lower(c).isin(*PLACES)))
    out = out.withColumn("_new", F.filter("_editorial", lambda c: ~_covered(c, F.col("_body"))))
    metadata, theme = F.col("_p").isin(*METADATA_PREDICATES), F.col("_p").isin(*THEME_PREDICATES)
    placed = F.coalesce("source_path", F.lit("")) != ""
    of_theme = (
        F.when((F.size("_new") == 0) & (F.size("_concepts") > F.size("_editorial")), "KEEP_CONTEXT")
        .when(F.size("_new") == 0, "KEEP_SEMANTIC")
        .when(F.size("_new") < F.size("_editorial"), "PARTIAL_ADD")
        .when(~placed, "HOLD")
        .otherwise("ADD")
    )
    action = (
        F.when(metadata, "KEEP_EVIDENCE")
        .when(F.coalesce(F.upper("status").isin(*HELD_STATUSES), F.lit(False)), "HOLD")
        .when(theme, of_theme)
        .when((F.col("text") != "") & F.col("_body").contains(F.lower("text")), "KEEP_SEMANTIC")
        .when(~placed, "HOLD")
        .otherwise("ADD")
    )
    out = out.withColumn("action", action).withColumn("semantic_class", F.when(metadata, "SOURCE_METADATA").otherwise("EDITORIAL_KNOWLEDGE"))
    delta = F.when(F.col("action") == "PARTIAL_ADD", F.array_join("_new", ", ")).otherwise(F.col("text"))
    return out.select("claim_id", "subject_id", "ord", "predicate", "semantic_class", "section", "subsection", "action", "text", delta.alias("delta_text"), "source_id", "source_path")


def body_gate(candidates: DataFrame) -> DataFrame:
    """Per entity the count of each action that occurs, and whether its body patch is ready: something to add and no
    conflict."""
    n = F.count_if(F.col("action").isin("ADD", "PARTIAL_ADD"))
    per = candidates.groupBy("subject_id", "action").agg(F.count("*").alias("n"))
    counts = per.groupBy("subject_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("action", "n")))).alias("counts"))
    ready = candidates.groupBy(F.col("subject_id").alias("_s")).agg(((n > 0) & (F.count_if(F.col("action") == "CONFLICT") == 0)).alias("_r"))
    out = counts.join(ready, F.col("subject_id") == F.col("_s"))
    return out.select("subject_id", "counts", F.when(F.col("_r"), "BODY_PATCH_READY").otherwise("BODY_REVIEW_REQUIRED").alias("body_gate"))


def body_markdown(candidates: DataFrame) -> DataFrame:
    """subject_id and markdown: what is to be added, under its sections in their order and their subsections in order of
    appearance."""
    place = F.coalesce("subsection", "section")
    inner = F.concat(F.lit("Nei materiali esaminati emerge inoltre il "), "delta_text", F.lit(" come elemento ricorrente della ricerca."))
    other = F.concat(F.lit("Nei materiali esaminati emerge inoltre "), "delta_text", F.lit(" nella sezione "), place, F.lit("."))
    partial = F.when(F.col("delta_text") == "", "").when((F.col("section") == "PROFILO ARTISTICO") & (F.col("subsection") == "La ricerca"), inner).otherwise(other)
    held = candidates.filter(F.col("action").isin("ADD", "PARTIAL_ADD")).withColumn("line", F.when(F.col("action") == "ADD", F.col("text")).otherwise(partial))
    per = held.groupBy("subject_id", "section", "subsection").agg(F.min("ord").alias("o"), F.array_sort(F.collect_list(F.struct("ord", "line"))).alias("l"))
    bullets = F.transform("l", lambda x: F.concat(F.lit("- "), x["line"]))
    rows = F.when(F.col("subsection").isNull(), bullets).otherwise(F.concat(F.array(F.concat(F.lit("### "), "subsection")), bullets))
    order = F.array_position(F.array(*map(F.lit, BODY_SECTIONS)), F.col("section"))
    sections = per.groupBy("subject_id", "section").agg(F.array_sort(F.collect_list(F.struct("o", rows.alias("rows")))).alias("s"))
    sections = sections.select("subject_id", order.alias("o"), F.concat(F.array(F.concat(F.lit("## "), "section")), F.flatten(F.transform("s", lambda x: x["rows"]))).alias("rows"))
    page = sections.groupBy("subject_id").agg(F.array_sort(F.collect_list(F.struct("o", "rows"))).alias("s"))
    return page.select("subject_id", F.array_join(F.flatten(F.transform("s", lambda x: x["rows"])), "\n").alias("markdown"))


def route_body(claims: DataFrame, routes: list[tuple[str, str]], other: str) -> DataFrame:
    """claims with section: that of the first route whose pattern the normalised predicate matches."""
    section = F.lit(other)
    for pattern, name in reversed(routes):
        section = F.when(X.norm(F.col("predicate")).rlike(pattern), name).otherwise(section)
    return claims.withColumn("section", section)


def discover(claims: DataFrame, rows: DataFrame, hints: DataFrame, primary: str = "") -> DataFrame:
    """name, type_source, entity_type and generate of every subject and object but the primary one: matched_existing_row
    (the type of the first row of that title), hinted_not_confirmed (by the longest hint for the predicate and side) or
    no_signal, which generates nothing."""
    # a name is looked at once for each predicate and side, not once a claim
    said = claims.select("predicate", "ord", F.expr("stack(2, 'subject', subject_raw, 'object', object_raw) as (anchor, name)")).groupBy("name", "predicate", "anchor").agg(F.min("ord").alias("ord"))
    per = said.select("ord", "anchor", X.norm(F.col("predicate")).alias("_np"), F.inline(F.array(F.struct(X.strip(F.col("name")).alias("name"), X.norm(F.col("name")).alias("_k"))))).filter((F.col("name") != "") & (F.col("_k") != F.lit(primary)))
    t = rows.groupBy(X.norm(F.col("title")).alias("_t")).agg(F.min_by("entity_type", "ord").alias("_type"))
    h = hints.select(X.norm(F.col("predicate")).alias("_hp"), F.col("anchor").alias("_ha"), F.col("entity_type").alias("_ht"), F.length("predicate").alias("_hl"))
    out = per.join(h, (F.col("_np") == F.col("_hp")) & (F.col("anchor") == F.col("_ha")), "left")
    out = out.groupBy("name", "_k").agg(F.min("ord").alias("ord"), F.max_by("_ht", F.struct("_hl", "_ht")).alias("_ht"))
    out = out.join(t, F.col("_k") == F.col("_t"), "left")
    found = F.when(F.col("_type").isNotNull(), "matched_existing_row").when(F.col("_ht").isNotNull(), "hinted_not_confirmed").otherwise("no_signal")
    return out.select("name", "_k", "ord", found.alias("type_source"), F.coalesce("_type", "_ht").alias("entity_type"), (found != "no_signal").alias("generate")).drop("_k")


def entity_operations(entities: DataFrame, claims: DataFrame, rows: DataFrame, hints: DataFrame, schema: DataFrame) -> DataFrame:
    """name, entity_type, claim_id, layer, key, action and reason of every claim that speaks of an entity, in that
    entity's page.  A relation hint goes before a field hint, what neither fits is body text.  Relations are never
    written: RELATION_NOT_IN_ENTITY_SCHEMA, RELATION_TARGET_ID_NOT_RESOLVED or RELATION_WRITE_NOT_SUPPORTED.  A field is
    an ADD where the entity has no value, nothing where it has this one, else FIELD_VALUE_MISMATCH.  status is what the
    gate makes of it.

    hints: entity_type, layer (relation or field), predicate, anchor (relations), key, target_type; schema: entity_type,
    key, property; rows: id, entity_type, title, fields (map)."""
    h = hints.select(F.col("entity_type").alias("_t"), X.norm(F.col("predicate")).alias("_p"), "layer", "anchor", "key", "target_type", (F.col("layer") == "field").alias("_late"), F.col("turn").alias("_turn"))
    # the first hint of a type and predicate, before any claim is joined
    h = h.groupBy("_t", "_p").agg(F.min(F.struct("_late", "_turn", "layer", "anchor", "key", "target_type")).alias("_h")).select("_t", "_p", "_h.layer", "_h.anchor", "_h.key", "_h.target_type")
    names = _names(entities, rows, h)
    # claims travel once by each side's text, and become an operation for each entity after that
    held = ["claim_id", "ord", "predicate", "subject", "object", "status"]
    each = claims.select(*held, X.norm(F.col("object")).alias("_k")).join(names.toDF("_n", "_who_object", "_types_object"), F.col("_k") == F.col("_n"), "left").withColumn("_s", X.norm(F.col("subject")))
    each = each.withColumn("_who_object", F.when(F.col("_k") != F.col("_s"), F.col("_who_object"))).drop("_k", "_n")
    each = each.join(names.toDF("_n", "_who_subject", "_types_subject"), F.col("_s") == F.col("_n"), "left")
    who = F.explode(F.concat(F.coalesce("_who_subject", F.array()), F.coalesce("_who_object", F.array())))
    each = each.select(*held, "_types_subject", "_types_object", who.alias("_w")).select("*", "_w.*").drop("_w")
    each = each.join(F.broadcast(h), (F.col("entity_type") == F.col("_t")) & (X.norm(F.col("predicate")) == F.col("_p")), "left")
    each = each.withColumn("layer", F.coalesce("layer", F.lit("body")))
    of_subject = F.coalesce(F.col("anchor") == "subject", F.lit(False))
    target, types = (F.when(of_subject, F.col(f"{c}subject")).otherwise(F.col(f"{c}object")) for c in ("", "_types_"))
    each = each.withColumn("_target", (F.col("layer") == "relation") & target.isNotNull() & F.coalesce(F.array_contains(types, F.col("target_type")), F.lit(False)))
    s = schema.select(F.col("entity_type").alias("_st"), F.col("key").alias("_sk"), "property")
    each = each.join(F.broadcast(s), (F.col("entity_type") == F.col("_st")) & (F.col("key") == F.col("_sk")), "left")
    old = F.when(F.col("_rows") == 1, F.element_at("_fields", F.col("key")))
    relation = F.when(F.col("property").isNull(), "RELATION_NOT_IN_ENTITY_SCHEMA").when(~F.col("_target"), "RELATION_TARGET_ID_NOT_RESOLVED").otherwise("RELATION_WRITE_NOT_SUPPORTED")
    empty, same = F.coalesce(old, F.lit("")) == "", F.coalesce(old == F.col("object"), F.lit(False))
    field_ = F.when(F.col("property").isNull(), "FIELD_NOT_IN_ENTITY_SCHEMA").when(~empty & ~same, "FIELD_VALUE_MISMATCH")
    reason = F.when(F.col("layer") == "relation", relation).when(F.col("layer") == "field", field_)
    action = F.when(F.col("layer") == "body", None).when(reason.isNotNull(), "CONFLICT").when(same & ~empty, "KEEP").otherwise("ADD")
    lost = ((F.col("layer") == "relation") & ~F.col("_target")) | ((F.col("layer") == "field") & reason.isNotNull())
    status = F.when(F.col("layer") != "body", F.when(lost, "MISSING").otherwise(F.col("status")))
    return each.select("name", "entity_type", "claim_id", "ord", "layer", "key", "property", action.alias("action"), reason.alias("reason"), status.alias("gate_status"))


def _names(entities: DataFrame, rows: DataFrame, hints: DataFrame) -> DataFrame:
    """_n, _who, _types: of each normalised name the entities called so, with how many rows there are and those of the first
    one's fields that a hint names, and the types whose first row of that title has an id."""
    own = entities.select("name", "entity_type", X.norm(F.col("name")).alias("_n")).distinct()
    own = own.join(compare_rows(rows), (F.col("entity_type") == F.col("_ot")) & (F.col("_n") == F.col("_on")), "left")
    asked = hints.filter("layer = 'field'").groupBy(F.col("_t").alias("_ht")).agg(F.collect_set("key").alias("_keys"))
    own = own.join(F.broadcast(asked), F.col("entity_type") == F.col("_ht"), "left").withColumn("_fields", F.map_filter("_fields", lambda k, _: F.array_contains("_keys", k)))
    who = own.select("_n", F.struct("name", "entity_type", "_rows", "_fields").alias("_w"), F.lit(None).cast("string").alias("_type"))
    t = rows.groupBy(F.col("entity_type").alias("_type"), X.norm(F.col("title")).alias("_n")).agg(F.min_by("id", "ord").alias("_id")).filter("_id IS NOT NULL")
    each = who.unionByName(t.select("_n", F.lit(None).cast(who.schema["_w"].dataType).alias("_w"), "_type"))
    return each.groupBy("_n").agg(F.collect_list("_w").alias("_who"), F.collect_list("_type").alias("_types"))


def compare_rows(rows: DataFrame) -> DataFrame:
    """_ot, _on, _rows, _fields: of each type and normalised title, how many rows there are and the first one's fields."""
    return rows.groupBy(F.col("entity_type").alias("_ot"), X.norm(F.col("title")).alias("_on")).agg(F.count("*").alias("_rows"), F.min_by("fields", "ord").alias("_fields"))


def fan_out(entities: DataFrame, claims: DataFrame, rows: DataFrame, hints: DataFrame, schema: DataFrame, required: DataFrame, linked_only: list[str]) -> DataFrame:
    """A candidate page for every entity (name, entity_type): match, operation (CREATE, UPDATE, none if ambiguous), gate and
    how many operations are proposed.  Types in linked_only want a resolved link from an earlier page; as no relation is
    ever written, they are skipped.  required: entity_type, key."""
    # the types that are skipped show no operations
    shown_ones = entities.filter(~F.coalesce(F.col("entity_type").isin(*linked_only), F.lit(False))) if linked_only else entities
    ops = entity_operations(shown_ones, claims, rows, hints, schema)
    each = ops.groupBy(F.col("name").alias("_pn"), F.col("entity_type").alias("_pt"), X.norm(F.col("key"), "").alias("_key"), F.col("key").isNull().alias("_none"))
    each = each.agg(F.max_by("gate_status", "ord").alias("status"), F.count_if(F.col("action").isin("ADD", "CONFLICT")).alias("n"))
    last = F.map_from_entries(F.collect_list(F.when(~F.col("_none"), F.struct("_key", "status"))))
    proposed = each.groupBy("_pn", "_pt").agg(F.sum("n").alias("operations"), last.alias("_last"))
    want = required.groupBy(F.col("entity_type").alias("_wt")).agg(F.collect_set(X.norm(F.col("key"))).alias("_want"))
    out = entities.join(compare_rows(rows), (F.col("entity_type") == F.col("_ot")) & (X.norm(F.col("name")) == F.col("_on")), "left")
    out = out.join(proposed, (F.col("name") == F.col("_pn")) & (F.col("entity_type") == F.col("_pt")), "left").join(want, F.col("entity_type") == F.col("_wt"), "left")
    out = out.withColumn("_blocked", F.exists("_want", lambda k: _blocked(F.element_at("_last", k))))
    match = F.when(F.col("_rows").isNull(), "NEW_ENTITY").when(F.col("_rows") == 1, "EXISTS_AND_MATCHES").otherwise("AMBIGUOUS")
    skip = F.col("entity_type").isin(*linked_only) if linked_only else F.lit(False)
    shown = lambda c: F.when(~skip, c)
    return out.select(
        "name", "entity_type", shown(match).alias("match"), shown(F.when(match == "NEW_ENTITY", "CREATE").when(match == "EXISTS_AND_MATCHES", "UPDATE")).alias("operation"),
        shown(gate_of(match, F.coalesce("_blocked", F.lit(False)))).alias("gate"), shown(F.coalesce("operations", F.lit(0))).alias("operations"),
        F.when(skip, "REQUIRES_EXISTING_LINK_NOT_FOUND").alias("skipped"),
    )


def route_claims(claims: DataFrame, relation_hints: DataFrame, field_hints: DataFrame) -> DataFrame:
    """claims with route (relation, field, body) and its key; a relation hint goes before a field hint."""
    r = relation_hints.select(X.norm(F.col("predicate")).alias("_rp"), F.col("key").alias("_rk"))
    f = field_hints.select(X.norm(F.col("predicate")).alias("_fp"), F.col("key").alias("_fk"))
    p = X.norm(F.col("predicate"))
    out = claims.join(r, p == F.col("_rp"), "left").join(f, p == F.col("_fp"), "left")
    route = F.when(F.col("_rk").isNotNull(), "relation").when(F.col("_fk").isNotNull(), "field").otherwise("body")
    return out.withColumn("route", route).withColumn("route_key", F.coalesce("_rk", "_fk")).drop("_rp", "_rk", "_fp", "_fk")


def claims_for(claims: DataFrame, names: DataFrame) -> DataFrame:
    """name and claim_id of the claims that speak of a name on either side, by two equal joins rather than one with OR."""
    n = names.select("name", X.norm(F.col("name")).alias("_n"))
    sides = claims.select("claim_id", F.explode(F.array_distinct(F.array(X.norm(F.col("subject")), X.norm(F.col("object"))))).alias("_k"))
    return n.join(sides, F.col("_n") == F.col("_k")).select("name", "claim_id").distinct()


def govern(facts: DataFrame, registry: DataFrame) -> DataFrame:
    """facts with verdict: accepted, ungoverned (no such predicate), domain or range (an incompatible subject class or
    object; a number only has to hold a digit).  Nothing is dropped."""
    r = registry.select(F.col("predicate_id").alias("_p"), F.col("domain").alias("_d"), F.col("range").alias("_r"))
    out = facts.join(r, F.col("predicate") == F.col("_p"), "left")
    number = F.array_contains("_r", "number") | F.array_contains("_r", "integer")
    verdict = (
        F.when(F.col("_p").isNull(), "ungoverned")
        .when(~F.coalesce(F.array_contains("_d", F.col("subject_class")), F.lit(False)), "domain")
        .when(F.coalesce(number, F.lit(False)) & ~F.coalesce(F.col("object").rlike(r"\d"), F.lit(False)), "range")
        .otherwise("accepted")
    )
    return out.withColumn("verdict", verdict).drop("_p", "_d", "_r")


#: Fixed value: the evidence state of a fact that is inferred.
INFERRED_FACT = "inferito"


def facts_to_claims(facts: DataFrame) -> DataFrame:
    """Facts with subject, predicate, object and evidence as raw claims; the optional fields that hold something become
    qualifiers."""
    whole = ~X.is_empty(F.col("subject")) & ~X.is_empty(F.col("predicate")) & ~X.is_empty(F.col("object")) & ~X.is_empty(F.col("evidence"))
    optional = ["currency", "scope", "page", "document_date", "valid_from", "valid_to"]
    pairs = F.create_map(*[x for c in optional for x in (F.lit(c), F.col(c).cast("string"))])
    return facts.filter(whole).select(
        "file_id", F.col("subject").alias("subject_raw"), "predicate", F.col("object").alias("object_raw"), F.col("evidence").alias("evidence_excerpt"),
        F.when(F.col("evidence_state") == INFERRED_FACT, "INFERRED").otherwise(DEFAULT_STATUS).alias("status"),
        F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != "")).alias("qualifiers"),
    )


def summarize_verification(claims: DataFrame, web_files: DataFrame | None = None) -> DataFrame:
    """Per entity: EXECUTED with the predicates, in order, that are VERIFIED and that are still SUPPORTED_BY_WEB among its
    claims with a source from the web; NOT_EXECUTED where it has none.  Without web_files claims have from_web, whether any
    of their files is from there."""
    held = claims
    if web_files is not None:
        w = web_files.select(F.col("file_id").alias("_f")).distinct()
        each = claims.select("claim_id", F.explode("source_file_ids").alias("_id"))
        web = each.join(w, F.col("_id") == F.col("_f"), "left_semi").select(F.col("claim_id").alias("_c")).distinct()
        held = claims.join(web, F.col("claim_id") == F.col("_c"), "left").withColumn("from_web", F.col("_c").isNotNull())

    def listed(status: str) -> Column:
        found = F.collect_list(F.when(F.col("from_web") & (F.col("status") == status), F.struct("ord", "predicate")))
        return F.array_join(F.transform(F.array_sort(found), lambda x: x["predicate"]), "|")

    ran = F.when(F.coalesce(F.bool_or("from_web"), F.lit(False)), "EXECUTED").otherwise("NOT_EXECUTED")
    return held.groupBy("subject_id").agg(ran.alias("state"), listed("VERIFIED").alias("verified"), listed("SUPPORTED_BY_WEB").alias("pending"))


def page_sections(claims: DataFrame, sections: dict[str, str], other: str) -> DataFrame:
    """Per entity and section: its claims as bullets, in order."""
    m = F.create_map(*[F.lit(x) for p in sections.items() for x in p])
    held = claims.withColumn("section", F.coalesce(F.element_at(m, X.norm(F.col("predicate"))), F.lit(other)))
    line = F.concat(F.lit("- "), "predicate", F.lit(": "), "object")
    per = held.groupBy("subject_id", "section").agg(F.array_sort(F.collect_list(F.struct("ord", line.alias("line")))).alias("l"))
    return per.select("subject_id", "section", F.array_join(F.transform("l", lambda s: s["line"]), "\n").alias("body"))


def merged_index(files: DataFrame, web: DataFrame) -> DataFrame:
    """file_id, paths: the union of both indexes, the web's row where both have one."""
    a = files.select("file_id", "paths", F.lit(1).alias("_o"))
    b = web.select("file_id", F.array("url").alias("paths"), F.lit(0).alias("_o"))
    w = Window.partitionBy("file_id").orderBy("_o")
    return a.unionByName(b).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("file_id", "paths")
