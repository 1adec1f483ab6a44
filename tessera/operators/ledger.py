"""Run ledgers, state machines, hash chains, freshness and overall state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import canonical as C
from tessera.functions import text as X
from tessera.scratch import materialize, partitions

#: The run state each event leads to, and the events each state allows.
RUN_STATES = {
    "RUN_CREATED": "CREATED",
    "RUN_STARTED": "RUNNING",
    "RUN_PAUSED": "PAUSED",
    "RUN_RESUMED": "RUNNING",
    "RUN_FAILED": "FAILED",
    "RUN_INTERRUPTED": "INTERRUPTED",
    "RUN_COMPLETED": "COMPLETED",
    "RUN_ABORTED": "ABORTED",
}
RUN_TRANSITIONS = (
    (None, "RUN_CREATED"),
    ("CREATED", "RUN_STARTED"),
    ("CREATED", "RUN_ABORTED"),
    ("CREATED", "RUN_INTERRUPTED"),
    ("RUNNING", "RUN_PAUSED"),
    ("RUNNING", "RUN_FAILED"),
    ("RUNNING", "RUN_INTERRUPTED"),
    ("RUNNING", "RUN_COMPLETED"),
    ("RUNNING", "RUN_ABORTED"),
    ("PAUSED", "RUN_RESUMED"),
    ("PAUSED", "RUN_ABORTED"),
    ("FAILED", "RUN_RESUMED"),
    ("FAILED", "RUN_ABORTED"),
    ("INTERRUPTED", "RUN_RESUMED"),
    ("INTERRUPTED", "RUN_ABORTED"),
)
#: The same for the stages of a run; a stage without events is not started.
STAGE_STATES = {
    "STAGE_STARTED": "RUNNING",
    "STAGE_RESTARTED": "RUNNING",
    "STAGE_COMPLETED": "COMPLETED",
    "STAGE_FAILED": "FAILED",
    "STAGE_SKIPPED": "SKIPPED",
}
STAGE_TRANSITIONS = (
    (None, "STAGE_STARTED"),
    (None, "STAGE_SKIPPED"),
    ("RUNNING", "STAGE_COMPLETED"),
    ("RUNNING", "STAGE_FAILED"),
    ("FAILED", "STAGE_RESTARTED"),
)
#: Events that change no state, and the states that end a run or that a crash leaves behind.
OTHER_EVENTS = ("ARTIFACT_REGISTERED", "LEDGER_REPAIRED", "HUMAN_DECISION")
TERMINAL = ("COMPLETED", "ABORTED")
LEFT_OPEN = ("CREATED", "RUNNING")
#: The states of an imported item, the steps between them, and what a state requires.
QUEUE_STATES = ("new", "processing", "classified", "approved", "retryable_error", "rejected", "failed", "archived")
QUEUE_TRANSITIONS = (
    (None, "new"),
    ("new", "processing"),
    ("processing", "classified"),
    ("processing", "retryable_error"),
    ("processing", "failed"),
    ("retryable_error", "processing"),
    ("classified", "approved"),
    ("classified", "rejected"),
    ("approved", "archived"),
)
QUEUE_ERRORS = ("retryable_error", "failed")
QUEUE_PLACED = ("approved", "archived")
GENESIS = "0" * 64


def _state_of(column, states: dict):
    return F.element_at(F.create_map(*[F.lit(x) for p in states.items() for x in p]), column)


def sequence_faults(events: DataFrame) -> DataFrame:
    """run_id, seq and expected of events whose seq isn't their turn."""
    w = Window.partitionBy("run_id").orderBy("seq", "event_id")
    turn = F.row_number().over(w).cast("long")
    return events.withColumn("expected", turn).filter("seq <> expected").select("run_id", "seq", "expected")


def event_faults(events: DataFrame, schema: str, actors: tuple[str, ...]) -> DataFrame:
    """run_id, seq and fault of events that can't be taken, by the first reason: another schema, a seq that isn't its
    turn, an actor or event type that doesn't exist, a changed component without its source hash."""
    turn = F.row_number().over(Window.partitionBy("run_id").orderBy("seq", "event_id"))
    known = (*RUN_STATES, *STAGE_STATES, *OTHER_EVENTS)
    no = lambda c: ~F.coalesce(c, F.lit(False))
    why = (
        F.when(no(F.col("schema") == schema), "schema")
        .when(no(F.col("seq") == F.col("_turn")), "seq")
        .when(no(F.col("actor").isin(*actors)), "actor")
        .when(no(F.col("event_type").isin(*known)), "event_type")
        .when(F.coalesce(F.col("component.git_dirty"), F.lit(False)) & (F.coalesce("component.source_hash", F.lit("")) == ""), "component")
    )
    return events.withColumn("_turn", turn).withColumn("fault", why).filter("fault is not null").select("run_id", "seq", "fault")


def _violations(events: DataFrame, keys: list[str], states: dict, transitions) -> DataFrame:
    """Events that the state before doesn't allow.  The state after an event depends on its type alone, so the state
    before is that of the state event before; events that change no state don't count."""
    w = Window.partitionBy(*keys).orderBy("seq")
    held = events.filter(F.col("event_type").isin(*states)).withColumn("before", _state_of(F.lag("event_type").over(w), states))
    step = F.concat(F.coalesce("before", F.lit("")), F.lit(">"), "event_type")
    return held.filter(~step.isin(*[f"{s or ''}>{e}" for s, e in transitions]))


def fsm_violations(events: DataFrame, states: dict = RUN_STATES, transitions=RUN_TRANSITIONS) -> DataFrame:
    """run_id, first_violation_seq of runs with an event that the state before doesn't allow."""
    return _violations(events, ["run_id"], states, transitions).groupBy("run_id").agg(F.min("seq").alias("first_violation_seq"))


def stage_violations(events: DataFrame) -> DataFrame:
    """run_id, stage, first_violation_seq of stages with an event that the stage's state before doesn't allow; a stage
    event without a stage is one too."""
    bad = _violations(events.filter("stage <> ''"), ["run_id", "stage"], STAGE_STATES, STAGE_TRANSITIONS)
    bare = events.filter(F.col("event_type").isin(*STAGE_STATES) & (F.coalesce("stage", F.lit("")) == ""))
    both = bad.select("run_id", "stage", "seq").unionByName(bare.select("run_id", F.lit("").alias("stage"), "seq"))
    return both.groupBy("run_id", "stage").agg(F.min("seq").alias("first_violation_seq"))


def stage_states(events: DataFrame) -> DataFrame:
    """The state each stage's last event leaves it in."""
    per = events.filter(F.col("event_type").isin(*STAGE_STATES)).groupBy("run_id", "stage").agg(F.max_by("event_type", "seq").alias("e"))
    return per.select("run_id", "stage", _state_of(F.col("e"), STAGE_STATES).alias("state"))


def queue_violations(changes: DataFrame) -> DataFrame:
    """item, seq and fault of changes (item, seq, state, error, confidence, destination) to a state that doesn't exist or
    that the state before doesn't allow, that lack an error or bear one without need, whose confidence isn't from 0 to 1,
    or that lack a destination."""
    before = F.lag("state").over(Window.partitionBy("item").orderBy("seq"))
    step = F.concat(F.coalesce("_before", F.lit("")), F.lit(">"), "state")
    wrong = F.col("state").isin(*QUEUE_ERRORS)
    blank = lambda c: X.is_empty(F.col(c))
    why = (
        F.when(~F.coalesce(F.col("state").isin(*QUEUE_STATES), F.lit(False)), "state")
        .when(~step.isin(*[f"{s or ''}>{t}" for s, t in QUEUE_TRANSITIONS]), "transition")
        .when(wrong & blank("error"), "error missing")
        .when(~wrong & F.col("error").isNotNull(), "error")
        .when(F.isnan("confidence") | ~F.col("confidence").between(0.0, 1.0), "confidence")
        .when(F.col("state").isin(*QUEUE_PLACED) & blank("destination"), "destination")
    )
    return changes.withColumn("_before", before).withColumn("fault", why).filter("fault is not null").select("item", "seq", "fault")


def run_state(events: DataFrame, states: dict = RUN_STATES) -> DataFrame:
    """The state each run's last state event leaves it in."""
    held = events.filter(F.col("event_type").isin(*states))
    per = held.groupBy("run_id").agg(F.max_by("event_type", "seq").alias("e"), F.max("seq").alias("last_seq"))
    return per.select("run_id", _state_of(F.col("e"), states).alias("state"), "last_seq")


def recovery_class(runs: DataFrame, violations: DataFrame, held: DataFrame, resumable: DataFrame) -> DataFrame:
    """canonical_state and action of each run (run_id, state): RUNNING and not to be touched while its lock is held (held:
    run_id); LEDGER_CORRUPT, likewise, where its ledger has a violation; a run that a crash left created or running is
    INTERRUPTED.  Ended runs need nothing; others can be resumed where a stage is left (resumable: run_id) or finalized."""
    out = runs.select("run_id", "state")
    for name, df in (("_live", held), ("_bad", violations), ("_left", resumable)):
        out = out.join(df.select(F.col("run_id").alias(name)).distinct(), F.col("run_id") == F.col(name), "left")
    live, bad = F.col("_live").isNotNull(), F.col("_bad").isNotNull()
    state = F.when(live, "RUNNING").when(bad, "LEDGER_CORRUPT").when(F.col("state").isin(*LEFT_OPEN), "INTERRUPTED").otherwise(F.col("state"))
    action = F.when(live | bad, "DO_NOT_RESUME").when(F.col("state").isin(*TERMINAL), "NO_ACTION").when(F.col("_left").isNotNull(), "RESUME_AVAILABLE").otherwise("FINALIZE_AVAILABLE")
    return out.select("run_id", state.alias("canonical_state"), action.alias("action"))


def stage_projection(stages: DataFrame) -> DataFrame:
    """Per run: the furthest completed or skipped stage and the current one, in requested order (idx)."""
    done = F.col("status").isin("COMPLETED", "SKIPPED")
    return stages.groupBy("run_id").agg(
        F.max_by(F.when(done, F.col("stage")), F.when(done, F.col("idx"))).alias("last_completed"),
        F.min_by(F.when(~done, F.col("stage")), F.when(~done, F.col("idx"))).alias("current_stage"),
    )


def resume_point(stages: DataFrame) -> DataFrame:
    """Per run: the least idx that isn't satisfied and valid; runs without one have nothing to resume."""
    ok = F.col("status").isin("COMPLETED", "SKIPPED") & F.coalesce(F.col("valid"), F.lit(True))
    return stages.filter(~ok).groupBy("run_id").agg(F.min("idx").alias("resume_idx"))


def checkpoint_failures(needed: DataFrame, listing: DataFrame) -> DataFrame:
    """needed (checkpoint, path, size, sha256) that the listing doesn't bear out, and how."""
    h = listing.select(F.col("path").alias("_p"), F.col("size").alias("_s"), F.col("sha256").alias("_h"))
    out = needed.join(h, F.col("path") == F.col("_p"), "left")
    why = F.when(F.col("_p").isNull(), "FILE_MISSING").when(F.col("_s") != F.col("size"), "SIZE_MISMATCH").when(F.col("_h") != F.col("sha256"), "HASH_MISMATCH")
    return out.withColumn("failure", why).filter("failure is not null").select("checkpoint", "path", "failure")


#: How an artifact compares to its file, in the order of its size and then of its digest, so that of an artifact registered
#: twice the least path and code are those of the first row by path, size and digest, without carrying the digests.
NO_FILE, SAME = 0, 3
OTHER_SIZE, OTHER_DIGEST = (1, 5), (2, 4)


def _file_states(artifacts: DataFrame, listing: DataFrame) -> DataFrame:
    """run_id, artifact_id, path and code of each registered artifact; a null size or digest is before any other."""
    files = listing.select(F.col("path").alias("_p"), F.col("size").alias("_s"), F.col("sha256").alias("_h"))
    size, digest = F.col("size") > F.col("_s"), F.col("sha256") > F.col("_h")
    code = F.when(F.col("_p").isNull(), NO_FILE).when(size, OTHER_SIZE[1]).when(~F.coalesce(F.col("size") == F.col("_s"), F.lit(False)), OTHER_SIZE[0])
    code = code.when(digest, OTHER_DIGEST[1]).when(~F.coalesce(F.col("sha256") == F.col("_h"), F.lit(False)), OTHER_DIGEST[0]).otherwise(SAME)
    return artifacts.join(files, F.col("path") == F.col("_p"), "left").select("run_id", "artifact_id", "path", code.alias("code"))


def checkpoints(requested: DataFrame, events: DataFrame, artifacts: DataFrame, listing: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """A checkpoint for each stage asked for (run_id, stage; without asked each requested one): run_id, stage,
    checkpoint_id, stage_state, derived_from_seq, resume_from, input_artifacts, output_artifacts, valid, failed_conditions.

    requested: run_id, idx, stage; events: run_id, seq, event_type, stage, component (a struct or map), input_artifacts and
    output_artifacts (arrays of ids); artifacts: run_id, artifact_id, path, size, sha256; listing: path, size, sha256 of
    the files that are there.

    Conditions in order: STAGE_NOT_REQUESTED; of a stage that isn't skipped STAGE_NOT_COMPLETED, or of its last completion
    COMPONENT_FINGERPRINT_MISSING, then for each input and each output NOT_REGISTERED, FILE_MISSING, SIZE_MISMATCH or
    HASH_MISMATCH after its role and before its id.  A skipped stage is satisfied whatever its files.  resume_from is the
    stage requested next, null for the last one and where the stage wasn't requested.  A stage requested twice counts where
    it is first; of an artifact registered twice the first row by path, size and digest holds.  Arrays are a completion's
    own, so their rows are spread by run and stage.  Files are looked up by registered artifact, and only how they compare
    meets the stages."""
    w = Window.partitionBy("run_id").orderBy("idx")
    place = requested.select("run_id", "stage", "idx", F.struct(F.lead("stage").over(w).alias("_next")).alias("_place"))
    named = F.coalesce(F.to_json("component"), F.lit("{}")) != "{}"
    end = F.struct("seq", named.alias("named"), *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("input_artifacts", "output_artifacts")])
    held = events.filter(F.col("event_type").isin(*STAGE_STATES)).select("run_id", "stage", "seq", "event_type", F.when(F.col("event_type") == "STAGE_COMPLETED", end).alias("_done"))
    # one grouping in place of a join for each kind of row; a stage without a name is no other's
    facts = place.unionByName(held, allowMissingColumns=True).filter("run_id IS NOT NULL AND stage IS NOT NULL")
    facts = facts.withColumn("_asked", F.lit(None).cast("boolean") if asked is not None else F.when(F.col("idx").isNotNull(), True))
    if asked is not None:
        facts = facts.unionByName(asked.select("run_id", "stage", F.lit(True).alias("_asked")), allowMissingColumns=True)
    done = F.col("_done").isNotNull()
    n = partitions(facts)  # rows of one stage are few, so tasks of a fixed number of rows hold little at any size
    out = facts.repartition(n, "run_id", "stage").groupBy("run_id", "stage").agg(
        F.min_by("_place", "idx").alias("_place"), F.max_by("event_type", "seq").alias("_event"), F.max_by(F.when(done, F.col("_done")), F.when(done, F.col("seq"))).alias("_done"),
        F.max(F.when(F.col("event_type") == "STAGE_SKIPPED", F.col("seq"))).alias("_skip"), F.max("_asked").alias("_asked"),
    ).filter("_asked").drop("_asked")
    state = F.coalesce(_state_of(F.col("_event"), STAGE_STATES), F.lit("NOT_STARTED"))
    out = out.withColumn("stage_state", state).withColumn("_done", F.when(F.col("stage_state") != "SKIPPED", F.col("_done"))).drop("_event")
    out = materialize(out, "stages")  # read for what it needs and for the result

    def numbered(ids: str, role: str):
        return F.transform(ids, lambda x, i: F.struct(F.lit(role).alias("role"), i.alias("pos"), x.alias("artifact_id")))

    roles = F.concat(numbered("_done.input_artifacts", "INPUT"), numbered("_done.output_artifacts", "OUTPUT"))
    needed = out.select("run_id", "stage", F.explode(roles).alias("n")).select("run_id", "stage", "n.*")
    known = _file_states(artifacts, listing).repartition(n, "run_id", "artifact_id").groupBy("run_id", "artifact_id").agg(F.min(F.struct("path", "code")).alias("_a"))
    code = F.col("_a.code")
    why = F.when(code.isNull(), "NOT_REGISTERED").when(code == NO_FILE, "FILE_MISSING").when(code.isin(*OTHER_SIZE), "SIZE_MISMATCH").when(code.isin(*OTHER_DIGEST), "HASH_MISMATCH")
    bad = needed.repartition(n, "run_id", "artifact_id").join(known, ["run_id", "artifact_id"], "left").withColumn("_why", why).filter("_why IS NOT NULL")
    bad = bad.repartition(n, "run_id", "stage").groupBy("run_id", "stage").agg(F.sort_array(F.collect_list(F.struct("role", "pos", F.concat("role", F.lit("_"), "_why", F.lit(":"), F.coalesce("artifact_id", F.lit("None"))).alias("text")))).alias("_bad"))
    out = out.repartition(n, "run_id", "stage").join(bad, ["run_id", "stage"], "left")
    no = lambda c: ~F.coalesce(c, F.lit(False))

    skipped = F.col("stage_state") == "SKIPPED"
    first = (
        F.when(F.col("_place").isNull(), F.lit("STAGE_NOT_REQUESTED")),
        F.when(~skipped & F.col("_done").isNull(), F.lit("STAGE_NOT_COMPLETED")),
        F.when(no(F.col("_done.named")) & F.col("_done").isNotNull(), F.lit("COMPONENT_FINGERPRINT_MISSING")),
    )
    none = F.array().cast("array<string>")
    failed = F.concat(F.array_compact(F.array(*first)), F.coalesce(F.transform("_bad", lambda x: x["text"]), none))
    ident = F.concat(F.lit("cp_"), F.lower("stage"), F.when(skipped, "_skipped").otherwise("_complete"))
    seq = F.coalesce(F.when(skipped, F.col("_skip")).otherwise(F.col("_done.seq")), F.lit(0)).cast("long")
    return out.select(
        "run_id", "stage", ident.alias("checkpoint_id"), "stage_state", seq.alias("derived_from_seq"), F.col("_place._next").alias("resume_from"),
        *[F.coalesce(f"_done.{c}", none).alias(c) for c in ("input_artifacts", "output_artifacts")], (F.size(failed) == 0).alias("valid"), failed.alias("failed_conditions"),
    )


def chain_faults(records: DataFrame, group: list[str], content: list[str]) -> DataFrame:
    """Records out of their turn (sequence counts from 1), whose previous_hash isn't the one before's record_hash, or
    whose record_hash isn't that of previous_hash and content joined by |."""
    w = Window.partitionBy(*group).orderBy("sequence")
    expected = F.lag("record_hash", 1, GENESIS).over(w)
    own = F.sha2(F.concat_ws("|", "previous_hash", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in content]), 256)
    out = records.withColumns({"_e": expected, "_turn": F.row_number().over(w)})
    why = F.when(F.col("sequence") != F.col("_turn"), "sequence").when(F.col("previous_hash") != F.col("_e"), "previous_hash").when(own != F.col("record_hash"), "record_hash")
    return out.withColumn("fault", why).filter("fault is not null").select(*group, "sequence", "fault")


def audit_chain_faults(records: DataFrame, group: list[str], record: str = "record") -> DataFrame:
    """group, sequence and fault of records (JSON objects) that break their chain, the first reason: a text that is no
    object or names a key twice, out of its turn (sequence counts from 1), another previous_hash than the record before
    has, or a record_hash that isn't the sha256 of the record's own canonical JSON without it.  Keys may come in any order,
    at any depth.  Unreadable records have no sequence; they are reported and take no turn."""
    body = C.canonical_without(F.col(record), "record_hash")
    said = lambda k: F.get_json_object(record, f"$.{k}")
    read = X.bind(body, lambda b: F.struct(F.when(b.isNotNull(), said("sequence").try_cast("bigint")).alias("sequence"), F.sha2(C.ascii_escaped(b), 256).alias("own")))
    held = records.select(*group, read.alias("_read"), *[said(k).alias(f"_{k}") for k in ("previous_hash", "record_hash")])
    held = held.select(*group, F.col("_read.sequence").alias("_sequence"), "_previous_hash", "_record_hash", (F.col("_read.own") == F.col("_record_hash")).alias("_own"))
    # unreadable records keep to a window of their own: a filter here would take every record apart once more
    w = Window.partitionBy(*group, F.col("_sequence").isNull()).orderBy("_sequence", "_record_hash")
    held = held.withColumns({"_expected": F.lag("_record_hash", 1, GENESIS).over(w), "_turn": F.row_number().over(w)})
    no = lambda c: ~F.coalesce(c, F.lit(False))
    why = F.when(F.col("_sequence").isNull(), "unreadable").when(F.col("_sequence") != F.col("_turn"), "sequence")
    why = why.when(no(F.col("_previous_hash") == F.col("_expected")), "previous_hash").when(no(F.col("_own")), "record_hash")
    return held.select(*group, F.col("_sequence").alias("sequence"), why.alias("fault")).filter("fault is not null")


def latest_per_key(records: DataFrame, key: str, at: str, order: str) -> DataFrame:
    """The record of each key with the greatest time; of equal times the one first read."""
    w = Window.partitionBy(key).orderBy(F.desc(at), F.asc(order))
    return records.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def freshness(records: DataFrame, as_of, seconds: int) -> DataFrame:
    """Per service, of its latest record: DEGRADED if it failed or went stale (seconds after its end, or where it says
    itself, the earlier), else PASS."""
    last = latest_per_key(records, "service", "ended_at", "ord")
    until = F.least(F.coalesce(F.col("fresh_until"), F.expr(f"ended_at + interval {seconds} seconds")), F.expr(f"ended_at + interval {seconds} seconds"))
    now = F.lit(as_of).cast("timestamp_ntz")
    return last.select("service", "ended_at", F.when((F.col("status") != "OK") | (until < now), "DEGRADED").otherwise("PASS").alias("classification"))


def overall_state(checks: DataFrame) -> DataFrame:
    """failed if any check is FAIL, degraded if any is DEGRADED or UNAVAILABLE, else ready."""
    got = checks.agg(F.max((F.col("classification") == "FAIL").cast("int")).alias("f"), F.max(F.col("classification").isin("DEGRADED", "UNAVAILABLE").cast("int")).alias("d"))
    return got.select(F.when(F.col("f") == 1, "failed").when(F.col("d") == 1, "degraded").otherwise("ready").alias("state"))


def status_pivot(rows: DataFrame, group: str, status: str, values: list[str]) -> DataFrame:
    return rows.groupBy(group).agg(*[F.count_if(F.col(status) == v).alias(f"n_{v.lower()}") for v in values])


#: The contract of operational records.
RECORD_VERSION = 1
RECORD_STATUSES = ("OK", "ERROR", "TIMEOUT", "CANCELLED")
RECORD_ERRORS = ("none", "validation", "dependency", "process_exit", "timeout", "cancelled", "internal")
RECORD_ID = r"^(?:RUN|COR)-[0-9a-f]{32}$"
RECORD_FIELDS = ("schema_version", "run_id", "correlation_id", "service", "status", "error_code", "started_at", "ended_at", "fresh_until", "return_code", "command", "summary", "artifacts", "runbook")
LONGEST_FIELD = 4096


def record_violations(records: DataFrame) -> DataFrame:
    """Operational records that break their contract, and the first reason; a missing field is a null."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    why = F.when(F.greatest(*[F.col(c).isNull() for c in RECORD_FIELDS]), "fields")
    why = why.when(F.col("schema_version") != RECORD_VERSION, "schema_version")
    why = why.when(no(F.col("status").isin(*RECORD_STATUSES)) | no(F.col("error_code").isin(*RECORD_ERRORS)), "status or error code")
    for name in ("run_id", "correlation_id"):
        why = why.when(no(F.col(name).rlike(RECORD_ID)), name)
    for name in ("service", "summary", "runbook"):
        why = why.when(F.length(name) > LONGEST_FIELD, name)
    return records.withColumn("reason", why).filter("reason is not null").select("run_id", "reason")
