"""The validation rule engine: 29 rule codes over configured corpora, scores and remediation.

A corpus row is entity, id, title, fields (map of strings), relations (map of arrays of strings), service (map of
strings), body and ord.  Rules are DataFrames of issues and their union is the audit; dates are compared to as_of, never
to a clock.  Configuration stays small and turns into expressions, so a rule family is one scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.scratch import materialize

SEVERITIES = ("BLOCKER", "MAJOR", "MINOR", "INFO")
#: What reads as yes, once normalised.
YES = ("yes", "true", "1", "si", "vero")


@dataclass(frozen=True)
class Field:
    kind: str = "text"  # text, date, year or integer
    required: bool = False
    weight: int = 1


@dataclass(frozen=True)
class Relation:
    target: str
    inverse: str | None = None
    required: bool = False


@dataclass(frozen=True)
class Entity:
    fields: dict[str, Field] = field(default_factory=dict)
    relations: dict[str, Relation] = field(default_factory=dict)
    sources: tuple[str, ...] = ()
    state: str | None = None
    state_options: tuple[str, ...] = ()
    verified_on: str | None = None
    publishable: str | None = None
    confidentiality: str | None = None
    unpublishable: tuple[str, ...] = ()
    economic: tuple[str, ...] = ()
    identity: tuple[str, ...] = ()
    span: tuple[str, str] | None = None  # start and end fields
    years: tuple[str, ...] = ()
    year_severity: str = "MINOR"
    name_like: bool = False


@dataclass(frozen=True)
class Config:
    entities: dict[str, Entity]
    states: dict[str, str] = field(default_factory=dict)  # normalised state -> epistemic state
    active_from: str | None = None
    active_to: str | None = None
    years: tuple[int, int] = (1000, 2099)
    verified_days: int = 730
    placeholders: tuple[str, ...] = ()
    promotional: tuple[str, ...] = ()
    vague: tuple[str, ...] = ()
    generated: tuple[str, ...] = ()
    completeness: float = 0.8


def _issue(df: DataFrame, code: str, severity: str | Column, name: Column | str, message: Column | str, when: Column | None = None) -> DataFrame:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    rows = df if when is None else df.filter(when)
    return rows.select(F.lit(code).alias("code"), lit(severity).alias("severity"), "entity", F.col("id").alias("record_id"), "title", lit(name).alias("field"), lit(message).alias("message"))


def _of(corpus: DataFrame, entity: str) -> DataFrame:
    return corpus.filter(F.col("entity") == entity)


def _get(column: str, key: str) -> Column:
    return F.element_at(F.col(column), F.lit(key))


def _year(c: Column) -> Column:
    """The year of a text as a number; no year is null before it is cast, as a cast that fails costs an exception a row."""
    return F.nullif(X.year(F.coalesce(c, F.lit(""))), F.lit("")).try_cast("int")


def union(frames: list[DataFrame], like: DataFrame) -> DataFrame:
    none = _issue(like.filter(F.lit(False)), "", "", "", "")
    return reduce(DataFrame.unionByName, frames, none)


def _finding(code: str | Column, severity: str | Column, name: str, message: str | Column, when: Column) -> Column:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.when(when, F.struct(lit(code).alias("code"), lit(severity).alias("severity"), F.lit(name).alias("field"), lit(message).alias("message")))


def found(corpus: DataFrame, checks: dict[str, list[Column]]) -> DataFrame:
    """The issues of rules that look at a record alone, in one pass over the corpus: checks holds arrays of findings, null
    where there is none, by entity."""
    held = F.lit(None).cast("array<struct<code:string,severity:string,field:string,message:string>>")
    for name, arrays in checks.items():
        if arrays:
            held = F.when(F.col("entity") == name, F.concat(*arrays)).otherwise(held)
    each = corpus.withColumn("_c", F.explode(held)).filter("_c is not null")
    return each.select("_c.code", "_c.severity", "entity", F.col("id").alias("record_id"), "title", "_c.field", "_c.message")


def field_checks(cfg: Config) -> dict[str, list[Column]]:
    out = {}
    for name, e in cfg.entities.items():
        checks = []
        for key, f in e.fields.items():
            v = _get("fields", key)
            empty = X.is_empty(v)
            bad = {"date": X.parse_date(v).isNull(), "year": X.year(F.coalesce(v, F.lit(""))) == "", "integer": ~v.rlike(r"^\s*-?\d+(\.\d+)?\s*$")}.get(f.kind, F.lit(False))
            code = F.when(empty, "S01" if f.required else "S02" if f.weight >= 2 else None).when(bad, "S03")
            severity = F.when(empty, "BLOCKER" if f.required else "MINOR").otherwise("MINOR" if f.kind == "integer" else "MAJOR")
            checks.append(_finding(code, severity, key, F.when(empty, "empty").otherwise(F.lit(f"not a {f.kind}")), code.isNotNull()))
        out[name] = [F.array(*checks)] if checks else []
    return out


def field_rules(corpus: DataFrame, cfg: Config) -> DataFrame:
    """S01, S02, S03: required fields empty, weighty ones empty, values that can't be read."""
    return found(corpus, field_checks(cfg))


def links(corpus: DataFrame, cfg: Config, births: tuple[str, str, str, str] | None = None) -> DataFrame:
    """What rules between records need of each: entity, id, title, ord and relations, own_year and birth_year (of births),
    identity (digest of the identity fields, null without any), form and plain (of the name, null if it has none)."""
    identity = form = F.lit(None).cast("string")
    for name, e in cfg.entities.items():
        if e.identity:
            key = F.concat_ws("|", *[X.norm(F.coalesce(_get("fields", k), F.array_join(_get("relations", k), " "), F.lit(""))) for k in e.identity])
            identity = F.when(F.col("entity") == name, X.bind(key, lambda k: F.when(F.replace(k, F.lit("|"), F.lit("")) != "", F.sha2(k, 256)))).otherwise(identity)
        if e.name_like:
            form = F.when(F.col("entity") == name, F.nullif(X.name_form(F.col("title")), F.lit(""))).otherwise(form)
    year = F.lit(None).cast("int")
    own = F.when(F.col("entity") == births[0], F.year(X.parse_date(_get("fields", births[1])))) if births else year
    born = _year(_get("fields", births[3])) if births else year
    out = corpus.select("entity", "id", "title", "ord", "relations", own.alias("own_year"), born.alias("birth_year"), identity.alias("identity"), form.alias("form"))
    return out.withColumn("plain", F.when(F.col("form").isNotNull(), F.nullif(X.norm(F.col("title")), F.lit(""))))


def references(corpus: DataFrame, cfg: Config) -> DataFrame:
    """Every configured reference: entity, id, title, rel, ref, target, inverse, required and, resolved by id over all
    entities or else by normalised title within the target, the row it means (target_id; the last such row)."""
    out = []
    for name, e in cfg.entities.items():
        for key, r in e.relations.items():
            rows = _of(corpus, name).select("entity", "id", "title", F.lit(key).alias("rel"), F.explode(_get("relations", key)).alias("ref"))
            out.append(rows.withColumns({"target": F.lit(r.target), "inverse": F.lit(r.inverse), "required": F.lit(r.required)}))
    if not out:
        return corpus.filter(F.lit(False)).select("entity", "id", "title", F.lit("").alias("rel"), F.lit("").alias("ref"), F.lit("").alias("target"), F.lit("").alias("inverse"), F.lit(False).alias("required"), F.lit("").alias("target_id"))
    refs = reduce(DataFrame.unionByName, out)
    ids = corpus.select(F.col("id").alias("_id")).distinct()
    named = corpus.filter(F.col("entity").isin(*sorted({r.target for e in cfg.entities.values() for r in e.relations.values()})))
    titles = named.groupBy(F.col("entity").alias("_e"), X.norm(F.col("title")).alias("_t")).agg(F.max_by("id", "ord").alias("_tid"))
    refs = refs.join(ids, F.col("ref") == F.col("_id"), "left")
    refs = refs.join(titles, (F.col("target") == F.col("_e")) & (X.norm(F.col("ref")) == F.col("_t")), "left")
    return refs.withColumn("target_id", F.coalesce("_id", "_tid")).drop("_id", "_e", "_t", "_tid")


def relation_rules(corpus: DataFrame, cfg: Config, refs: DataFrame | None = None) -> DataFrame:
    """R01 required relation empty, R02 unresolved, R03 not answered by the configured inverse, R04 no link either way.
    corpus may be its links."""
    refs = references(corpus, cfg) if refs is None else refs
    out = [found(corpus, required_checks(cfg)), *reference_rules(corpus, refs, cfg)]
    return union(out, corpus)


def required_checks(cfg: Config) -> dict[str, list[Column]]:
    out = {}
    for name, e in cfg.entities.items():
        none = {key: F.coalesce(F.size(_get("relations", key)), F.lit(0)) <= 0 for key, r in e.relations.items() if r.required}
        out[name] = [F.array(*[_finding("R01", "BLOCKER", key, "required relation is empty", when) for key, when in none.items()])] if none else []
    return out


def reference_rules(corpus: DataFrame, refs: DataFrame, cfg: Config) -> list[DataFrame]:
    """R02, R03, R04, of references and of who is linked."""
    inverses = {r.inverse for e in cfg.entities.values() for r in e.relations.values() if r.inverse}
    out = []
    out.append(_issue(refs, "R02", "MAJOR", F.col("rel"), F.concat(F.lit("unresolved: "), "ref"), F.col("target_id").isNull()))
    # what the targets' inverse lists hold, by id or normalised title; other relations are nobody's inverse
    back = corpus.select(F.col("id").alias("_back"), F.explode("relations").alias("_rel", "_list")).filter(F.col("_rel").isin(*sorted(inverses))).select("_back", "_rel", F.explode("_list").alias("_ref"))
    back = back.select("_back", "_rel", F.explode(F.array_distinct(F.array("_ref", F.concat(F.lit("\u0001"), X.norm(F.col("_ref")))))).alias("_key")).distinct()
    asked = refs.filter("target_id is not null and inverse is not null")
    by_id = asked.join(back, (F.col("target_id") == F.col("_back")) & (F.col("inverse") == F.col("_rel")) & (F.col("id") == F.col("_key")), "left_anti")
    title_key = F.concat(F.lit("\u0001"), X.norm(F.col("title")))
    unanswered = by_id.join(back, (F.col("target_id") == F.col("_back")) & (F.col("inverse") == F.col("_rel")) & (title_key == F.col("_key")), "left_anti")
    out.append(_issue(unanswered, "R03", "MINOR", F.col("rel"), F.concat(F.lit("missing inverse: "), "target_id")))
    linked = refs.filter("target_id is not null").select(F.col("target_id").alias("_l")).distinct()
    own = F.exists(F.map_values("relations"), lambda v: F.size(v) > 0)
    alone = corpus.filter(F.coalesce(~own, F.lit(True))).join(linked, F.col("id") == F.col("_l"), "left_anti")
    out.append(_issue(alone, "R04", "MAJOR", "", "no relation to or from the record"))
    return out


def time_checks(cfg: Config, as_of: str) -> dict[str, list[Column]]:
    held: dict[str, list[Column]] = {}
    for name, e in cfg.entities.items():
        out = held[name] = []
        if e.span:

            def spans(v: Column) -> Column:
                start, end = v["start"], v["end"]
                after = start > F.lit(cfg.active_to or as_of).cast("date")
                checks = [_finding("T01", "BLOCKER", e.span[1], "end before start", end < start), _finding("T02", "MINOR", e.span[0], "after the end of activity", after)]
                if cfg.active_from:
                    checks.append(_finding("T02", "MAJOR", e.span[0], "before the start of activity", start < F.lit(cfg.active_from).cast("date")))
                return F.array(*checks)

            start, end = (X.parse_date(_get("fields", k)) for k in e.span)
            out.append(X.bind(F.struct(start.alias("start"), end.alias("end")), spans))
        for key in e.years:
            y = _year(_get("fields", key))
            out.append(F.array(_finding("T05", e.year_severity, key, "implausible year", ~y.between(*cfg.years))))
    return held


def birth_rules(linked: DataFrame, refs: DataFrame, births: tuple[str, str, str, str]) -> DataFrame:
    """T03: the entity's year is earlier than the birth of a record that the relation names."""
    entity, own, relation, _ = births
    mine = _of(linked, entity).select(F.col("id").alias("_i"), F.col("own_year").alias("_y")).filter("_y is not null")
    born = linked.select(F.col("id").alias("_b"), F.col("birth_year").alias("_by")).filter("_by is not null")
    link = refs.filter((F.col("entity") == entity) & (F.col("rel") == relation)).join(mine, F.col("id") == F.col("_i")).join(born, F.col("target_id") == F.col("_b"))
    return _issue(link, "T03", "BLOCKER", own, F.concat(F.lit("before the birth of "), "target_id"), F.col("_y") < F.col("_by"))


def time_rules(corpus: DataFrame, cfg: Config, as_of: str, births: tuple[str, str, str, str] | None = None, refs: DataFrame | None = None) -> DataFrame:
    """T01 end before start, T02 outside the time of activity, T05 implausible years, and, given births (entity, its
    year field, relation, the target's year field), T03 earlier than the linked record's birth."""
    out = [found(corpus, time_checks(cfg, as_of))]
    if births:
        out.append(birth_rules(links(corpus, cfg, births), references(corpus, cfg) if refs is None else refs, births))
    return union(out, corpus)


def source_level(url: Column) -> Column:
    """CANONICAL for the archive's host, EXTERNAL_WEB for other web addresses, else UNKNOWN."""
    return F.when(X.norm(url).contains("dropbox"), "CANONICAL").when(url.rlike(r"(?i)^https?:"), "EXTERNAL_WEB").otherwise("UNKNOWN")


def metadata_checks(cfg: Config, as_of: str) -> dict[str, list[Column]]:
    mapped = F.create_map(*[F.lit(x) for p in cfg.states.items() for x in p]) if cfg.states else None
    none = F.lit(None).cast("string")

    def checks(e: Entity, v: Column) -> Column:
        out = []
        add = lambda *x: out.append(_finding(*x))
        source, raw, state, on = v["source"], v["raw"], v["state"], v["verified"]
        valid = F.coalesce(state == "VALID", F.lit(False))
        if not e.sources:
            add("M01", "MAJOR", "", "entity without a source field", F.lit(True))
        else:
            add("M02", "MAJOR", "source", "no source given", source.isNull())
            add("M03", "INFO", "source", "source on the open web", source_level(source) == "EXTERNAL_WEB")
        if e.state:
            add("M04", "MAJOR", e.state, "state is empty", X.is_empty(raw))
            add("M04", "MINOR", e.state, "state is unknown", ~X.is_empty(raw) & state.isNull())
        if e.verified_on:
            add("M06", "MINOR", e.verified_on, "valid without a date of verification", valid & on.isNull())
            add("M06", "MINOR", e.verified_on, "verification is out of date", F.datediff(F.lit(as_of).cast("date"), on) > cfg.verified_days)
        if e.publishable:
            public = v["public"]
            add("M07", "MAJOR", e.publishable, "publishable but not valid", public & ~valid)
            if e.sources:
                add("M07", "MAJOR", "source", "publishable without a source", public & source.isNull())
            if e.confidentiality:
                closed = F.coalesce(_get("service", e.confidentiality).isin(*e.unpublishable), F.lit(False))
                add("M08", "BLOCKER", e.confidentiality, "publishable but confidential", public & closed)
            for key in e.economic:
                add("M08", "BLOCKER", key, "publishable with a private figure", public & ~X.is_empty(_get("fields", key)))
        return F.array(*out) if out else F.array().cast("array<struct<code:string,severity:string,field:string,message:string>>")

    held = {}
    for name, e in cfg.entities.items():
        raw = _get("service", e.state) if e.state else none
        values = {
            "source": F.coalesce(*[F.when(~X.is_empty(_get("service", s)), _get("service", s)) for s in e.sources]) if e.sources else none,
            "raw": raw,
            "state": F.element_at(mapped, X.norm(raw)) if mapped is not None else none,
            "verified": X.parse_date(_get("service", e.verified_on)) if e.verified_on else F.lit(None).cast("date"),
            "public": X.norm(_get("service", e.publishable)).isin(*YES) if e.publishable else F.lit(None).cast("boolean"),
        }
        held[name] = [X.bind(F.struct(*[c.alias(k) for k, c in values.items()]), partial(checks, e))]
    return held


def metadata_rules(corpus: DataFrame, cfg: Config, as_of: str) -> DataFrame:
    """M01-M04, M06-M08: sources, epistemic state, verification, publication."""
    return found(corpus, metadata_checks(cfg, as_of))


def _marked(padded: Column, markers: tuple[str, ...]) -> Column:
    """The markers, in their order, that stand in a normalised text as whole words; markers are normalised too."""
    plain = [(w, " ".join(X.re.sub(r"[^a-z0-9\s]", " ", X.plain_text(w)).split())) for w in markers]
    # words of a normalised text, given with a space at both ends, stand between single spaces
    found = [F.when(padded.contains(f" {n} "), F.lit(w)) for w, n in plain if n]
    return F.filter(F.array(*found), lambda w: w.isNotNull()) if found else F.array().cast("array<string>")


def text_blocks(corpus: DataFrame, cfg: Config) -> DataFrame:
    """entity, id, title, field, text of every text that isn't blank: the text fields of each entity and the body."""
    none = F.array().cast("array<struct<field:string,text:string>>")
    fields = none
    for name, e in cfg.entities.items():
        own = [F.struct(F.lit(k).alias("field"), _get("fields", k).alias("text")) for k, f in e.fields.items() if f.kind == "text"]
        fields = F.when(F.col("entity") == name, F.array(*own) if own else none).otherwise(fields)
    body = F.array(F.struct(F.lit("body").alias("field"), F.col("body").alias("text")))
    each = corpus.select("entity", "id", "title", F.explode(F.concat(fields, body)).alias("b")).select("entity", "id", "title", "b.field", "b.text")
    return each.filter(~X.is_empty(F.col("text")))


TEXT_CODES = ("Q01", "Q02", "Q03", "Q04", "Q08")


def text_rules(corpus: DataFrame, cfg: Config, codes: tuple[str, ...] = (*TEXT_CODES, "Q07")) -> DataFrame:
    """Q01 placeholders, in every text; in bodies and in fields of more than 200 characters Q02 unfinished text, Q03
    promotion, Q04 two marks or more of generated text, Q08 vagueness, all in one scan; Q07 sentences that occur three
    times or more.  The normalised text is bound once, and only the asked codes are looked at."""
    blocks = text_blocks(corpus, cfg)
    long_ = (F.col("field") == "body") | (F.length("text") > 200)
    ended = F.col("text").rlike(r"(?U)[.!?»\"')][\s\x1c-\x1f]*\z")

    def issue(code, severity, when, message):
        return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), message.alias("message")))

    def findings(n: Column) -> Column:
        checks = {
            "Q01": lambda: X.bind(_marked(n, cfg.placeholders), lambda m: issue("Q01", "BLOCKER", F.size(m) > 0, F.concat(F.lit("placeholder: "), F.get(m, F.lit(0))))),
            "Q02": lambda: issue("Q02", "MAJOR", long_ & ~ended, F.lit("text breaks off")),
            "Q03": lambda: issue("Q03", "MINOR", long_ & (F.size(_marked(n, cfg.promotional)) > 0), F.lit("promotional")),
            "Q04": lambda: X.bind(_marked(n, cfg.generated), lambda m: issue("Q04", "MAJOR", long_ & (F.size(m) >= 2), F.concat(F.lit("reads as generated: "), F.array_join(F.slice(m, 1, 3), ", ")))),
            "Q08": lambda: issue("Q08", "MINOR", long_ & (F.size(_marked(n, cfg.vague)) > 0), F.lit("vague")),
        }
        return F.filter(F.array(*[checks[c]() for c in TEXT_CODES if c in codes]), lambda c: c.isNotNull())

    marks, repeats = any(c in codes for c in TEXT_CODES), "Q07" in codes
    said = blocks.withColumn("_s", X.normal_sentences()(F.col("text")))
    if marks and repeats:  # a text is normalised once, by its sentences
        each = said.withColumn("keys", F.when(long_, F.col("_s.keys"))).withColumn("found", X.bind(F.concat(F.lit(" "), F.col("_s.n"), F.lit(" ")), findings))
        each = each.select("entity", "id", "title", "field", "found", "keys")
        each = materialize(each.filter((F.size("found") > 0) | (F.size("keys") > 0)), "texts")
        each, keys = each.select("entity", "id", "title", "field", F.explode("found").alias("_c")), each.select("entity", "id", "title", F.explode("keys").alias("k"))
    elif marks:
        each = blocks.withColumn("_c", F.explode_outer(X.bind(F.concat(F.lit(" "), X.norm(F.col("text")), F.lit(" ")), findings))).filter("_c is not null")
    else:
        keys = materialize(said.filter(long_).select("entity", "id", "title", F.explode("_s.keys").alias("k")), "sentences")
    out = [each.select("_c.code", "_c.severity", "entity", F.col("id").alias("record_id"), "title", "field", "_c.message")] if marks else []
    return reduce(DataFrame.unionByName, [*out, *([repeated_sentences(keys)] if repeats else [])])


def repeated_sentences(keys: DataFrame, least: int = 3) -> DataFrame:
    """Q07: an issue an occurrence of every normalised sentence that occurs least times or more.  keys: entity, id, title
    and k, the sentence's digest; read twice, for the counts and for the issues."""
    often = keys.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return _issue(keys.join(often, "k"), "Q07", "MINOR", "-", F.concat(F.lit("sentence occurs "), F.col("n").cast("string"), F.lit(" times")))


def duplicate_rules(corpus: DataFrame, cfg: Config) -> DataFrame:
    """D01: the same identity key within an entity; D02: the same name in another order, reported on
    the earlier record once for each other title of the name that a later one has (naming the last such record): records
    of one title aren't paired with each other's copies, so a frequent name makes no square of issues."""
    return union(duplicates(links(corpus, cfg), cfg), corpus)


def duplicates(linked: DataFrame, cfg: Config) -> list[DataFrame]:
    out = []
    for name, e in cfg.entities.items():
        rows = _of(linked, name)
        if e.identity:
            keyed = rows.filter("identity is not null").select("entity", "id", "title", "identity")
            twice = keyed.groupBy("identity").agg(F.count("*").alias("_n")).filter("_n > 1")
            out.append(_issue(keyed.join(twice, "identity"), "D01", "BLOCKER", ",".join(e.identity), "same identity as another record"))
        if e.name_like:
            formed = rows.filter("form is not null and plain is not null")
            # a form has few titles, as their words are the same: a row each, with the last record of that title
            titles = formed.groupBy(F.col("form").alias("_f"), F.col("plain").alias("_t")).agg(F.max(F.struct("ord", "id", "title")).alias("_other"))
            both = formed.join(titles, (F.col("form") == F.col("_f")) & (F.col("plain") != F.col("_t")) & (F.col("ord") < F.col("_other.ord")))
            said = F.concat(F.lit("same name as a later record: "), F.col("_other.title"), F.lit(" ("), F.col("_other.id"), F.lit(")"))
            out.append(_issue(both, "D02", "MAJOR", "title", said))
    return out


def corpus_rules(corpus: DataFrame, cfg: Config) -> DataFrame:
    """N01 more than one vocabulary of states, N03 more than one naming of source fields (none is one too), N04 entities
    without any; of the configuration, so at most three rows."""
    entities = cfg.entities.items()
    plain = lambda w: " ".join(X.re.sub(r"[^a-z0-9\s]", " ", X.plain_text(w)).split())
    vocabularies: dict[tuple, list[str]] = {}
    sources: dict[tuple, list[str]] = {}
    for n, e in entities:
        if e.state:
            vocabularies.setdefault(tuple(sorted(map(plain, e.state_options))), []).append(f"{n}:{e.state}")
        sources.setdefault(e.sources or ("(none)",), []).append(n)
    rows = []
    if len(vocabularies) > 1:
        rows.append(("N01", "MINOR", "state vocabularies differ: " + "; ".join(f"[{', '.join(sorted(v))}]" for v in vocabularies.values())))
    if len(sources) > 1:
        rows.append(("N03", "MINOR", "source fields are named differently: " + "; ".join(f"{'/'.join(k)}: {', '.join(v)}" for k, v in sources.items())))
    bare = [n for n, e in entities if not e.sources]
    if bare:
        rows.append(("N04", "MAJOR", "no source field: " + ", ".join(bare)))
    made = corpus.sparkSession.createDataFrame(rows, "code string, severity string, message string")
    dash = F.lit("-")
    return made.select("code", "severity", F.lit("corpus").alias("entity"), dash.alias("record_id"), dash.alias("title"), dash.alias("field"), "message")


def corpus_rule_reach(corpus: DataFrame, cfg: Config) -> DataFrame:
    """The issues of the configuration with how many records of the corpus each concerns: N01 those of entities that have
    states, N03 all, N04 those of entities without source fields."""
    stated = [n for n, e in cfg.entities.items() if e.state]
    bare = [n for n, e in cfg.entities.items() if not e.sources]
    per = corpus.filter(F.col("entity").isin(*cfg.entities)).groupBy("entity").agg(F.count("*").alias("n"))
    sums = per.agg(*[F.coalesce(F.sum(F.when(F.col("entity").isin(*of), F.col("n"))), F.lit(0)).alias(code) for code, of in (("N01", stated), ("N03", list(cfg.entities)), ("N04", bare))])
    told = sums.select(F.expr("stack(3, 'N01', N01, 'N03', N03, 'N04', N04) AS (_c, records)"))
    return corpus_rules(corpus, cfg).join(told, F.col("code") == F.col("_c")).drop("_c")


def audit(corpus: DataFrame, cfg: Config, as_of: str, births=None) -> DataFrame:
    """All issues.  Rules of a record alone share one pass over the corpus, rules of texts another; what rules between
    records need is written once, without the texts, and so are the references they resolve."""
    linked = materialize(links(corpus, cfg, births), "links")
    refs = materialize(references(linked, cfg), "references")
    alone = [field_checks(cfg), required_checks(cfg), time_checks(cfg, as_of), metadata_checks(cfg, as_of)]
    parts = [
        found(corpus, {name: [a for checks in alone for a in checks[name]] for name in cfg.entities}),
        *reference_rules(linked, refs, cfg),
        *([birth_rules(linked, refs, births)] if births else []),
        text_rules(corpus, cfg),
        *duplicates(linked, cfg),
        corpus_rules(corpus, cfg),
    ]
    return reduce(DataFrame.unionByName, parts)


def ordered(issues: DataFrame) -> DataFrame:
    order = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    return issues.orderBy(order, "entity", "title", "code", "record_id", "field")


def scores(corpus: DataFrame, issues: DataFrame, cfg: Config) -> DataFrame:
    """Per record: weight present and in all, completeness, epistemic state, blockers, majors and minors, exportable, and
    why not; those that aren't exportable first, then by completeness."""
    per = issues.groupBy(F.col("record_id").alias("_r")).agg(*[F.count_if(F.col("severity") == s).alias(f"{s.lower()}s") for s in SEVERITIES[:3]])
    mapped = F.create_map(*[F.lit(x) for p in cfg.states.items() for x in p]) if cfg.states else None
    out = []
    for name, e in cfg.entities.items():
        parts = [(f.weight, ~X.is_empty(_get("fields", k))) for k, f in e.fields.items()]
        parts += [(3 if r.required else 1, F.coalesce(F.size(_get("relations", k)), F.lit(0)) > 0) for k, r in e.relations.items()]
        have = reduce(lambda a, b: a + b, [F.when(p, w).otherwise(0) for w, p in parts], F.lit(0))
        state = F.element_at(mapped, X.norm(_get("service", e.state))) if mapped is not None and e.state else F.lit(None).cast("string")
        out.append(_of(corpus, name).select("entity", "id", have.cast("long").alias("have"), F.lit(sum(w for w, _ in parts)).cast("long").alias("all_weight"), F.coalesce(state, F.lit("UNVERIFIED")).alias("epistemic")))
    both = reduce(DataFrame.unionByName, out).join(per, F.col("id") == F.col("_r"), "left").drop("_r")
    both = both.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("blockers", "majors", "minors")})
    both = both.withColumn("completeness", F.when(F.col("all_weight") > 0, F.col("have") / F.col("all_weight")).otherwise(0.0))
    why = F.array(F.when(F.col("blockers") > 0, "blockers"), F.when(F.col("completeness") < cfg.completeness, "completeness"))
    both = both.withColumn("reasons", F.filter(why, lambda w: w.isNotNull()))
    return both.withColumn("exportable", F.size("reasons") == 0).orderBy("exportable", "completeness")


#: What becomes of an issue and how much is at risk; only R03 can be mended without asking.
REMEDY = {
    "S01": ("RESEARCH_REQUIRED", "HIGH"),
    "S02": ("RESEARCH_REQUIRED", "MEDIUM"),
    "S03": ("RESEARCH_REQUIRED", "HIGH"),
    "R01": ("RESEARCH_REQUIRED", "HIGH"),
    "R02": ("RESEARCH_REQUIRED", "HIGH"),
    "R03": ("AUTO_FIX", "LOW"),
    "R04": ("HUMAN_DECISION", "HIGH"),
    "T01": ("RESEARCH_REQUIRED", "HIGH"),
    "T02": ("RESEARCH_REQUIRED", "HIGH"),
    "T03": ("RESEARCH_REQUIRED", "HIGH"),
    "T05": ("RESEARCH_REQUIRED", "MEDIUM"),
    "M01": ("SCHEMA_CHANGE", "HIGH"),
    "M02": ("RESEARCH_REQUIRED", "HIGH"),
    "M03": ("RESEARCH_REQUIRED", "MEDIUM"),
    "M04": ("HUMAN_DECISION", "HIGH"),
    "M06": ("RESEARCH_REQUIRED", "MEDIUM"),
    "M07": ("HUMAN_DECISION", "HIGH"),
    "M08": ("HUMAN_DECISION", "CRITICAL"),
    "Q01": ("HUMAN_DECISION", "HIGH"),
    "Q02": ("HUMAN_DECISION", "MEDIUM"),
    "Q03": ("HUMAN_DECISION", "MEDIUM"),
    "Q04": ("HUMAN_DECISION", "MEDIUM"),
    "Q07": ("HUMAN_DECISION", "LOW"),
    "Q08": ("HUMAN_DECISION", "MEDIUM"),
    "D01": ("HUMAN_DECISION", "HIGH"),
    "D02": ("HUMAN_DECISION", "HIGH"),
    "N01": ("SCHEMA_CHANGE", "HIGH"),
    "N03": ("SCHEMA_CHANGE", "HIGH"),
    "N04": ("SCHEMA_CHANGE", "HIGH"),
}
#: Whose leave an action needs.
AUTHORIZATION = {"AUTO_FIX": "LOCAL_COPY_ONLY", "HUMAN_DECISION": "HUMAN_APPROVAL", "RESEARCH_REQUIRED": "VERIFIED_SOURCE", "SCHEMA_CHANGE": "SCHEMA_APPROVAL"}


def check_policy(remedy: dict[str, tuple[str, str]]) -> None:
    """Raises ValueError for a class that doesn't exist and for any automatic fix but R03's."""
    for code, (action, _) in remedy.items():
        if action not in AUTHORIZATION:
            raise ValueError(f"{code}: no such class: {action}")
        if action == "AUTO_FIX" and code != "R03":
            raise ValueError(f"{code}: only R03 may be fixed automatically")


ISSUE = ("code", "entity", "field", "message", "record_id", "severity", "title")


def remediation(issues: DataFrame, remedy: dict[str, tuple[str, str]] = REMEDY) -> DataFrame:
    """issues with action_id (of the issue as JSON with keys in order, and its turn among equal ones), classification,
    authorization and risk.  An issue whose code the policy lacks fails the plan."""
    check_policy(remedy)
    text = F.to_json(F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in ISSUE]))
    turn = F.row_number().over(Window.partitionBy("_text").orderBy("code"))  # equal rows: any order
    lookup = lambda values: F.element_at(F.create_map(*[F.lit(x) for p in values.items() for x in p]), F.col("code"))
    action = F.coalesce(lookup({c: a for c, (a, _) in remedy.items()}), F.raise_error(F.concat(F.lit("no remedy for "), "code")).cast("string"))
    ident = F.concat(F.lit("act-"), F.left(F.sha2(F.concat("_text", F.lit("\n"), turn.cast("string")), 256), F.lit(20)))
    out = issues.withColumn("_text", text).withColumns({"action_id": ident, "classification": action, "risk": lookup({c: r for c, (_, r) in remedy.items()})}).drop("_text")
    may = F.create_map(*[F.lit(x) for p in AUTHORIZATION.items() for x in p])
    return out.withColumn("authorization", F.element_at(may, F.col("classification")))


def apply_statuses(actions: DataFrame, corpus: DataFrame, cfg: Config) -> DataFrame:
    """action_id and status of each automatic fix: APPLIED; SKIPPED_ALREADY_RESOLVED where the target's list holds the
    source, also through an action before; NOT_BIDIRECTIONAL where the configuration of the inverse doesn't lead back;
    SOURCE_NOT_FOUND; NOT_DETERMINISTIC where not exactly one reference is meant.  Here an id must be of the target's
    entity and a title must be its only one."""
    fixes = actions.filter("classification = 'AUTO_FIX'").select("action_id", F.col("entity").alias("_e"), F.col("record_id").alias("_r"), F.col("field").alias("_f"), "message")
    both = {(n, k) for n, e in cfg.entities.items() for k, r in e.relations.items() if r.inverse and (b := cfg.entities.get(r.target)) and (v := b.relations.get(r.inverse)) and v.target == n and v.inverse == k}
    leads_back = reduce(lambda a, b: a | b, [(F.col("_e") == n) & (F.col("_f") == k) for n, k in both], F.lit(False))
    refs = references(corpus, cfg).filter("inverse is not null").select("entity", "id", "title", "rel", "ref", "target", "inverse")
    ids = corpus.select(F.col("entity").alias("_ie"), F.col("id").alias("_i"))
    once = corpus.groupBy(F.col("entity").alias("_te"), X.norm(F.col("title")).alias("_t")).agg(F.count("*").alias("_n"), F.first("id").alias("_ti")).filter("_n = 1")
    refs = refs.join(ids, (F.col("target") == F.col("_ie")) & (F.col("ref") == F.col("_i")), "left")
    refs = refs.join(once, (F.col("target") == F.col("_te")) & (X.norm(F.col("ref")) == F.col("_t")), "left")
    refs = refs.withColumn("to", F.coalesce("_i", "_ti")).filter("to is not null").withColumn("_m", F.concat(F.lit("missing inverse: "), "to"))
    per = refs.groupBy("entity", "id", "rel", "_m").agg(F.count("*").alias("meant"), F.first("to").alias("to"), F.first("inverse").alias("inverse"), F.first("title").alias("title"))
    out = fixes.join(ids.select(F.col("_ie").alias("_se"), F.col("_i").alias("_s")), (F.col("_e") == F.col("_se")) & (F.col("_r") == F.col("_s")), "left")
    out = out.join(per, (F.col("_e") == F.col("entity")) & (F.col("_r") == F.col("id")) & (F.col("_f") == F.col("rel")) & (F.col("message") == F.col("_m")), "left")
    held = corpus.select(F.col("id").alias("_b"), F.explode("relations").alias("_rel", "_list")).select("_b", "_rel", F.explode("_list").alias("_v"))
    held = held.select("_b", "_rel", F.explode(F.array("_v", F.concat(F.lit("\u0001"), X.norm(F.col("_v"))))).alias("_key")).distinct()
    mine = out.select("action_id", "to", "inverse", F.explode(F.array("_r", F.concat(F.lit("\u0001"), X.norm(F.col("title"))))).alias("_own"))
    there = mine.join(held, (F.col("to") == F.col("_b")) & (F.col("inverse") == F.col("_rel")) & (F.col("_own") == F.col("_key")), "left_semi")
    out = out.join(there.select(F.col("action_id").alias("_there")).distinct(), F.col("action_id") == F.col("_there"), "left")
    before = F.row_number().over(Window.partitionBy("to", "inverse", "_r").orderBy("action_id"))
    status = (
        F.when(F.col("_s").isNull(), "SOURCE_NOT_FOUND")
        .when(~leads_back, "NOT_BIDIRECTIONAL")
        .when(F.coalesce("meant", F.lit(0)) != 1, "NOT_DETERMINISTIC")
        .when(F.col("_there").isNotNull() | (F.col("_before") > 1), "SKIPPED_ALREADY_RESOLVED")
        .otherwise("APPLIED")
    )
    return out.withColumn("_before", before).select("action_id", status.alias("status"))


def apply_inverses(corpus: DataFrame, cfg: Config) -> DataFrame:
    """corpus with the inverse references that R03 finds missing, where the target is one row of its entity by id."""
    refs = references(corpus, cfg).filter("inverse is not null and target_id is not null")
    add = refs.groupBy(F.col("target").alias("_e"), F.col("target_id").alias("_t"), F.col("inverse").alias("_inv")).agg(F.sort_array(F.collect_set("id")).alias("_ids"))
    add = add.groupBy("_e", "_t").agg(F.map_from_entries(F.collect_list(F.struct("_inv", "_ids"))).alias("_add"))
    out = corpus.join(add, (F.col("entity") == F.col("_e")) & (F.col("id") == F.col("_t")), "left")
    held = F.coalesce("relations", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>")))
    more = F.map_zip_with(held, F.col("_add"), lambda _, a, b: F.array_union(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>"))))
    return out.withColumn("relations", F.when(F.col("_add").isNull(), F.col("relations")).otherwise(more)).drop("_e", "_t", "_add")
