"""Integrity assertions, which return what violates them, and multiset reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, required: bool = False) -> DataFrame:
    """Children whose key has no parent; a null key is one only where it is required."""
    p = parent.select(F.col(parent_key).alias("_p"))
    held = child if required else child.filter(F.col(key).isNotNull())
    return held.join(p, F.col(key) == F.col("_p"), "left_anti")


def oid_violations(objects: DataFrame) -> DataFrame:
    """Object ids that break the grammar, or whose prefix belongs to another type."""
    kind = X.oid_type(F.col("oid"))
    reason = F.when(~X.oid_ok(F.col("oid")), "grammar").when(kind.isNull(), "prefix").when(kind != F.col("type"), "type")
    return objects.select("oid", "type", reason.alias("reason")).filter("reason is not null")


def oid_continuity(objects: DataFrame) -> DataFrame:
    """Per prefix: least, greatest, count, gaps and duplicates of the numbers."""
    n = F.substring("oid", 5, 6).cast("long")
    per = objects.filter(X.oid_ok(F.col("oid"))).groupBy(F.left("oid", F.lit(3)).alias("prefix"))
    per = per.agg(F.min(n).alias("lo"), F.max(n).alias("hi"), F.count("*").alias("n"), F.countDistinct("oid").alias("different"))
    return per.select("prefix", "lo", "hi", "n", (F.col("hi") - F.col("lo") + 1 - F.col("different")).alias("gaps"), (F.col("n") - F.col("different")).alias("duplicates"))


def oid_gaps(objects: DataFrame) -> DataFrame:
    """prefix and number of what is missing between a prefix's least and greatest."""
    held = objects.filter(X.oid_ok(F.col("oid"))).select(F.left("oid", F.lit(3)).alias("prefix"), F.substring("oid", 5, 6).cast("long").alias("number"))
    span = held.groupBy("prefix").agg(F.min("number").alias("lo"), F.max("number").alias("hi"))
    every = span.select("prefix", F.explode(F.sequence("lo", "hi")).alias("number"))
    return every.join(held, ["prefix", "number"], "left_anti")


def sequence_highwater(sequences: DataFrame, objects: DataFrame) -> DataFrame:
    """Sequences whose last value lies under the greatest number in use."""
    used = objects.groupBy("type").agg(F.max(F.substring("oid", 5, 6).cast("long")).alias("used"))
    out = sequences.join(used, sequences["object_type"] == used["type"], "left").withColumn("used", F.coalesce("used", F.lit(0)))
    return out.filter(F.col("last_value") < F.col("used")).select("object_type", "last_value", "used")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def typed_references(df: DataFrame, key: str, objects: DataFrame, kind: str, required: bool = False) -> DataFrame:
    """Rows whose reference isn't to an object of the kind; a null one is among them only where it is required."""
    return orphans(df, key, objects.filter(F.col("type") == kind), "oid", required)


def missing_identities(required: DataFrame, objects: DataFrame) -> DataFrame:
    return required.join(objects.select("oid", "type"), ["oid", "type"], "left_anti")


def self_relations(relations: DataFrame) -> DataFrame:
    return relations.filter(F.col("source_oid") == F.col("target_oid"))


def superseded_twice(events: DataFrame) -> DataFrame:
    """Events that more than one event supersedes, or that supersede themselves."""
    s = events.filter("supersedes_event_id is not null")
    twice = s.groupBy(F.col("supersedes_event_id").alias("event_id")).agg(F.count("*").alias("n")).filter("n > 1")
    own = s.filter("supersedes_event_id = id").select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("n"))
    return twice.unionByName(own)


def _same(cols: list[str], right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{right}{c}")) for c in cols])


def parity(left: DataFrame, right: DataFrame, content: list[str]) -> DataFrame:
    """Contents that left holds more often than right: content, left_n, right_n."""
    a = left.groupBy(*content).agg(F.count("*").alias("left_n"))
    b = right.groupBy(*[F.col(c).alias(f"_{c}") for c in content]).agg(F.count("*").alias("right_n"))
    out = a.join(b, _same(content, "_"), "left").withColumn("right_n", F.coalesce("right_n", F.lit(0)))
    return out.filter(F.col("right_n") < F.col("left_n")).select(*content, "left_n", "right_n")


def fifo_match(left: DataFrame, right: DataFrame, content: list[str], key: str = "id") -> DataFrame:
    """Every left row with the right row of its content that comes at the same turn, by ascending key: key,
    matched_id (null if there is none).  Rows of equal content match one to one."""
    w = Window.partitionBy(*content).orderBy(key)
    a = left.select(key, *content, F.row_number().over(w).alias("_turn"))
    b = right.select(F.col(key).alias("matched_id"), *content, F.row_number().over(w).alias("_turn"))
    b = b.select("matched_id", *[F.col(c).alias(f"_{c}") for c in content], F.col("_turn").alias("__turn"))
    return a.join(b, _same([*content, "_turn"], "_"), "left").select(key, "matched_id")


def evidence_gap(left: DataFrame, right: DataFrame, content: list[str], logged: DataFrame) -> DataFrame:
    """id and matched_id of the pairs that the content alone gives and that no log entry (left_id, right_id) bears out."""
    pairs = fifo_match(left, right, content).filter("matched_id is not null")
    return pairs.join(logged, (F.col("id") == F.col("left_id")) & (F.col("matched_id") == F.col("right_id")), "left_anti")


def guards(checks: dict[str, DataFrame]) -> DataFrame:
    """One report of many checks: check, violations and PASS or FAIL."""
    each = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, each).withColumn("classification", F.when(F.col("violations") > 0, "FAIL").otherwise("PASS"))


def map_and_match(left: DataFrame, right: DataFrame, mapping: DataFrame, key: str, content: list[str], excluded: list) -> DataFrame:
    """left rows with their mapped identity, classed excluded (listed), unmapped, matched or pending."""
    m = left.join(mapping, key, "left")
    mapped = [c for c in mapping.columns if c != key]
    pairs = fifo_match(m.filter(F.col(mapped[0]).isNotNull()), right, content)
    out = m.join(pairs, "id", "left")
    state = F.when(F.col("id").isin(excluded), "excluded").when(F.col(mapped[0]).isNull(), "unmapped").when(F.col("matched_id").isNotNull(), "matched").otherwise("pending")
    return out.select("id", state.alias("state"), "matched_id")


def identity_audit(listed: DataFrame, objects: DataFrame) -> DataFrame:
    """oid, state (json_only, catalogue_only, both) and whether its (type, name) stands under another oid."""
    a = listed.select("oid", F.col("type").alias("lt"), F.col("name").alias("ln"))
    b = objects.select("oid", F.col("type").alias("ct"), F.col("name").alias("cn"))
    state = F.when(F.col("ct").isNull(), "json_only").when(F.col("lt").isNull(), "catalogue_only").otherwise("both")
    both = a.join(b, "oid", "full").withColumn("state", state)
    other = objects.groupBy(F.col("type").alias("ot"), F.col("name").alias("on_")).agg(F.count("*").alias("k"), F.min("oid").alias("o1"))
    out = both.join(other, (F.col("lt") == F.col("ot")) & (F.col("ln") == F.col("on_")), "left")
    elsewhere = (F.col("k") > 1) | (F.col("o1") != F.col("oid"))
    return out.select("oid", "state", F.coalesce(elsewhere, F.lit(False)).alias("elsewhere"))
