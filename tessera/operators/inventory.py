"""Content-addressed inventory: groups, duplicates, imports, identities, comparison with a master list, plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import properties as P
from tessera.functions import text as X
from tessera.scratch import running_total


def content_groups(files: DataFrame) -> DataFrame:
    """One row a content: sha256, paths in order (joined by |), n."""
    per = files.groupBy("sha256").agg(F.sort_array(F.collect_set("path")).alias("p"), F.count("*").alias("n"))
    return per.select("sha256", F.array_join("p", "|").alias("paths"), "n")


def exact_duplicates(files: DataFrame) -> DataFrame:
    return files.groupBy("sha256").agg(F.count("*").alias("n"), F.min("path").alias("first_path")).filter("n > 1")


def import_outcome(incoming: DataFrame, resources: DataFrame, order: str) -> DataFrame:
    """incoming with outcome: resource_imported for the first row of a content that resources lacks, else
    resource_seen_again."""
    w = Window.partitionBy("sha256").orderBy(order)
    known = resources.select(F.col("sha256").alias("_known")).distinct()
    out = incoming.withColumn("_turn", F.row_number().over(w)).join(known, F.col("sha256") == F.col("_known"), "left")
    fresh = F.col("_known").isNull() & (F.col("_turn") == 1)
    return out.withColumn("outcome", F.when(fresh, "resource_imported").otherwise("resource_seen_again")).drop("_known", "_turn")


def allocate(rows: DataFrame, sequences: DataFrame, kind: str, order: str) -> DataFrame:
    """rows (with a column of object types) with the next object ids of their types in order.  The turn within a type is a
    running total over range-sorted partitions, so a type of any size is spread over many tasks."""
    turned = running_total(rows.withColumn("_one", F.lit(1)), [kind], [order], {"_n": "_one"}, "allocate")
    out = turned.join(sequences, F.col(kind) == F.col("object_type"))
    number = F.col("last_value") + F.col("_n") + 1
    safe = F.when(number <= 999_999, number).otherwise(F.raise_error(F.lit("object ids of a type are used up")).cast("long"))
    return out.withColumn("oid", F.concat("prefix", F.lit("-"), F.lpad(safe.cast("string"), 6, "0"))).drop("_n", "_one", "object_type", "prefix", "last_value")


def compare_master(files: DataFrame, master: DataFrame | None, complete: bool) -> DataFrame:
    """files with comparison: EXACT MATCH by content, else SAME NAME in any case, else NOT FOUND, or UNKNOWN where the
    master list is incomplete; NOT CHECKED where no master list is given."""
    if master is None:
        return files.withColumn("comparison", F.lit("NOT CHECKED"))
    by_hash = master.select(F.col("sha256").alias("_h")).filter("_h is not null").distinct()
    by_name = master.select(F.lower("filename").alias("_n")).filter("_n is not null").distinct()
    out = files.join(by_hash, F.col("sha256") == F.col("_h"), "left").join(by_name, F.lower("filename") == F.col("_n"), "left")
    said = (
        F.when(F.col("_h").isNotNull(), "EXACT MATCH")
        .when(F.col("_n").isNotNull(), "SAME NAME")
        .otherwise("NOT FOUND" if complete else "UNKNOWN — INDEX INCOMPLETE")
    )
    return out.withColumn("comparison", said).drop("_h", "_n")


def histogram(files: DataFrame, column: str) -> DataFrame:
    return files.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def plan_moves(files: DataFrame, root: str) -> DataFrame:
    """A destination under root for each file and, if the plan must not run, why."""
    out = files.withColumn("destination", F.concat_ws("/", F.lit(root), "path"))
    clash = Window.partitionBy("destination")
    problem = F.when(~X.path_ok(F.col("path")), "unsafe path").when(F.count("*").over(clash) > 1, "destination twice")
    return out.withColumn("problem", problem)


def verify_moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: planned, moved, changed, remaining (still at their old path) and the outcome COMPLETED (all moved and
    nothing left behind), PARTIAL or ABORTED."""
    there = after.select(F.col("path").alias("_path"), F.col("sha256").alias("_sha"))
    here = after.select(F.col("path").alias("_old")).distinct()
    both = before.join(there, F.col("destination") == F.col("_path"), "left").join(here, F.col("path") == F.col("_old"), "left")
    got = both.agg(
        F.count("*").alias("planned"),
        F.count_if(F.col("_path").isNotNull()).alias("moved"),
        F.count_if(F.col("_sha") != F.col("sha256")).alias("changed"),
        F.count_if(F.col("_old").isNotNull()).alias("remaining"),
    )
    done = (F.col("moved") == F.col("planned")) & (F.col("remaining") == 0)
    return got.withColumn("outcome", F.when(F.col("changed") > 0, "ABORTED").when(done, "COMPLETED").otherwise("PARTIAL"))


#: Where unresolved files wait, the levels of confidence and the longest reason.
UNRESOLVED_FOLDER = "TEMP_IMPORT"
CONFIDENCE = ("HIGH", "MEDIUM", "LOW")
LONGEST_REASON = 240


def proposal_faults(proposals: DataFrame, sources: DataFrame) -> DataFrame:
    """source_relpath and fault: proposed twice, without such a source, or sources without a proposal.  Any of them voids
    the batch."""
    n = proposals.groupBy("source_relpath").agg(F.count("*").alias("n"))
    s = sources.select(F.col("source_relpath").alias("_s")).distinct()
    both = n.join(s, F.col("source_relpath") == F.col("_s"), "full")
    fault = F.when(F.col("_s").isNull(), "UNEXPECTED").when(F.col("n").isNull(), "OMITTED").when(F.col("n") > 1, "DUPLICATE")
    return both.select(F.coalesce("source_relpath", "_s").alias("source_relpath"), fault.alias("fault")).filter("fault is not null")


def settle_proposals(proposals: DataFrame, sources: DataFrame, allowed: list[str]) -> DataFrame:
    """sources (source_relpath, sha256) with destination_directory, destination_relpath, status, confidence and reason: as
    proposed where that is sound, else UNRESOLVED in the folder for it, because of the destination's path or the rest."""
    p = proposals.select(F.col("source_relpath").alias("_s"), *[F.col(c).alias(f"_{c}") for c in ("destination_directory", "status", "confidence", "reason")])
    out = sources.join(p, F.col("source_relpath") == F.col("_s"), "left")
    waits = F.col("_destination_directory") == UNRESOLVED_FOLDER
    reason = X.strip(F.coalesce("_reason", F.lit("")))
    sound = (
        F.col("_destination_directory").isin(*allowed)
        & F.col("_status").isin("PROPOSED", "UNRESOLVED")
        & F.col("_confidence").isin(*CONFIDENCE)
        & (reason != "") & (F.length("_reason") <= LONGEST_REASON)
        & (waits == (F.col("_status") == "UNRESOLVED"))
    )
    path = F.coalesce(X.path_ok(F.col("_destination_directory")), F.lit(False))
    why = F.when(~path, "LLM_DESTINATION_INVALID").when(~F.coalesce(sound, F.lit(False)), "LLM_ITEM_INVALID")
    out = out.withColumn("_why", why)
    keep = lambda c, other: F.when(F.col("_why").isNull(), c).otherwise(F.lit(other))
    out = out.withColumns({
        "destination_directory": keep(F.col("_destination_directory"), UNRESOLVED_FOLDER), "status": keep(F.col("_status"), "UNRESOLVED"),
        "confidence": keep(F.col("_confidence"), "LOW"), "reason": F.coalesce("_why", reason),
    })
    return out.select("source_relpath", "sha256", "destination_directory", F.concat_ws("/", "destination_directory", "source_relpath").alias("destination_relpath"), "status", "confidence", "reason")


def plan_faults(items: DataFrame, allowed: list[str]) -> DataFrame:
    """id and fault (the first) of items (id, turn, source_relpath, source_sha256, destination_directory,
    destination_relpath, status, confidence, reason) of a normalization plan that break its invariants."""
    source, destination = Window.partitionBy("source_relpath"), Window.partitionBy("destination_relpath")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    waits = F.col("destination_directory") == UNRESOLVED_FOLDER
    why = (
        F.when(no(F.col("id") == F.concat(F.lit("N"), F.lpad(F.col("turn").cast("string"), F.greatest(F.lit(4), F.length(F.col("turn").cast("string"))), F.lit("0")))), "id")
        .when(no(X.path_ok(F.col("source_relpath"))) | no(X.path_ok(F.col("destination_directory"))) | no(X.path_ok(F.col("destination_relpath"))), "path")
        .when((F.count("*").over(source) > 1) | (F.count("*").over(destination) > 1), "duplicate")
        .when(no(F.col("destination_directory").isin(*allowed)), "outside the template")
        .when(no(F.col("destination_relpath") == F.concat_ws("/", "destination_directory", "source_relpath")), "source path lost")
        .when((F.col("status") == "UNRESOLVED") & ~(waits & (F.col("confidence") == "LOW")), "unresolved")
        .when((F.col("status") == "PROPOSED") & waits, "proposed")
        .when(no(F.col("status").isin("PROPOSED", "UNRESOLVED")), "status")
        .when(no(F.col("confidence").isin(*CONFIDENCE)), "confidence")
        .when(no(F.col("source_sha256").rlike(r"^[0-9a-f]{64}$")), "sha256")
        .when(F.coalesce("reason", F.lit("")) == "", "reason")
    )
    return items.withColumn("fault", why).filter("fault is not null").select("id", "fault")


def plan_summary(items: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("source_files"), F.count_if(F.col("status") == "PROPOSED").alias("proposed"), F.count_if(F.col("status") == "UNRESOLVED").alias("unresolved"), F.lit(0).cast("long").alias("operations_applied"))


def collected(listing: DataFrame) -> DataFrame:
    """A walked listing (path, kind: file, folder or link; error) as path and outcome: file, folder, or the problem that
    keeps it out of the inventory."""
    outcome = F.when(F.col("error").isNotNull(), F.concat(F.lit("problem: "), "error")).when(F.col("kind") == "link", "problem: symlink skipped").otherwise(F.col("kind"))
    return listing.select("path", outcome.alias("outcome"))


def stale_properties(kept: DataFrame, live: DataFrame) -> DataFrame:
    """page_id, property, bundle_value, live_value of kept properties that are otherwise now; pages that are yet to be made
    have none."""
    now = live.select(F.col("page_id").alias("_p"), F.col("property").alias("_n"), F.col("value").alias("live_value"))
    held = kept.filter("page_id is not null").join(now, (F.col("page_id") == F.col("_p")) & (F.col("property") == F.col("_n")), "left")
    return held.filter(~F.col("value").eqNullSafe(F.col("live_value"))).select("page_id", "property", F.col("value").alias("bundle_value"), "live_value")


def property_payload(operations: DataFrame, schema: DataFrame) -> DataFrame:
    """ADD and UPDATE operations with their property's type (kind), why they are skipped, or what writes their value
    (payload, JSON text; null where operations have no value column).  A value that its type can't take is skipped too."""
    s = schema.select(F.col("property").alias("_p"), F.col("type").alias("kind"))
    out = operations.filter(F.col("action").isin("ADD", "UPDATE")).join(s, F.col("property") == F.col("_p"), "left").drop("_p")
    fits = F.coalesce(F.col("kind").isin(*P.WRITABLE), F.lit(False))
    written = P.payload(F.col("kind"), F.col("value")) if "value" in operations.columns else F.lit(None).cast("string")
    odd = F.lit("value" in operations.columns) & F.col("payload").isNull()
    skipped = F.when(~fits, F.concat(F.lit("UNSUPPORTED_NOTION_TYPE:"), F.coalesce("kind", F.lit("None")))).when(odd, F.concat(F.lit("INVALID_VALUE:"), "kind"))
    return out.withColumn("payload", written).withColumn("skipped", skipped)


def page_payloads(payloads: DataFrame, order: str) -> DataFrame:
    """page_id and properties (a JSON object by property) of what isn't skipped; of several operations on a property the
    last by order holds.  A page has as many properties as its schema, so its object is bounded."""
    last = payloads.filter("skipped IS NULL").groupBy("page_id", "property").agg(F.max_by("payload", order).alias("payload"))
    name = F.element_at(F.split(F.to_json(F.array("property")), r"^\[|\]$"), 2)
    each = last.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct(name.alias("name"), "payload"))).alias("all"))
    joined = F.array_join(F.transform("all", lambda x: F.concat(x["name"], F.lit(":"), x["payload"])), ",")
    return each.select("page_id", F.concat(F.lit("{"), joined, F.lit("}")).alias("properties"))


def markdown_blocks(pages: DataFrame) -> DataFrame:
    """page_id, no, type and content of each line of a page's body: headings of two levels and flat bullets; anything else
    fails.  Blank lines are nothing."""
    each = pages.select("page_id", F.posexplode(F.filter(F.split("markdown", "\n"), lambda x: ~X.is_empty(x))).alias("no", "line"))
    line = F.col("line")
    kind = F.when(line.startswith("### "), "heading_3").when(line.startswith("## "), "heading_2").when(line.startswith("- "), "bulleted_list_item")
    failed = F.raise_error(F.concat(F.lit("unexpected markdown construct: "), line)).cast("string")
    return each.select("page_id", "no", F.coalesce(kind, failed).alias("type"), F.regexp_replace(line, r"^(### |## |- )", "").alias("content"))


def artifact_availability(runs: DataFrame, listing: DataFrame) -> DataFrame:
    """Two rows a run: its stdout and stderr, available, unavailable or not_recorded."""
    each = runs.select("id", F.expr("stack(2, 'stdout', stdout_path, 'stderr', stderr_path) as (stream, path)"))
    here = listing.select(F.col("path").alias("_p")).distinct()
    out = each.join(here, F.col("path") == F.col("_p"), "left")
    state = F.when(F.col("path").isNull(), "not_recorded").when(F.col("_p").isNotNull(), "available").otherwise("unavailable")
    return out.select("id", "stream", state.alias("availability"))


def expired(sets: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Sets older than days, but none at all if that would be every set."""
    old = F.datediff(F.lit(as_of).cast("date"), F.col("created_on")) > days
    stays = sets.filter(~old).select(F.lit(1).alias("_one")).limit(1)
    return sets.filter(old).join(stays, F.lit(True), "left_semi")


def cache_misses(wanted: DataFrame, cache: DataFrame, parts: list[str]) -> DataFrame:
    """wanted rows whose key, the sha256 of parts joined by |, the cache lacks."""
    keyed = wanted.withColumn("cache_key", F.sha2(F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]), 256))
    return keyed.join(cache.select("cache_key"), "cache_key", "left_anti")


def merge_index(old: DataFrame, new: DataFrame) -> DataFrame:
    """The file index after a scan: a content's paths are what the scan found; contents that vanished go."""
    o = old.select("file_id", F.col("first_seen").alias("_seen"))
    return new.join(o, "file_id", "left").withColumn("first_seen", F.coalesce("_seen", "first_seen")).drop("_seen")


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def legacy_counts(files: DataFrame, previous: DataFrame) -> DataFrame:
    """Documents per domain and kind with the change since the previous count."""
    now = files.groupBy("domain", "extension").agg(F.count("*").alias("n"))
    p = previous.select(F.col("domain").alias("_d"), F.col("extension").alias("_e"), F.col("n").alias("_n"))
    out = now.join(p, (F.col("domain") == F.col("_d")) & (F.col("extension") == F.col("_e")), "left")
    return out.select("domain", "extension", "n", (F.col("n") - F.coalesce("_n", F.lit(0))).alias("change"))
