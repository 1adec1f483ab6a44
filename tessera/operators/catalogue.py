"""Catalogue queries: lists, lookups, counts, views and search over objects, relations, resources, events and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def plugin(plugins: DataFrame, wanted: str) -> DataFrame:
    """By oid, or by slug in any case."""
    return plugins.filter((F.col("plugin_oid") == wanted) | (F.lower("slug") == wanted.lower()))


def latest(events: DataFrame, n: int) -> DataFrame:
    return events.orderBy(F.desc("event_at"), F.desc("id")).limit(n)


def events_of(events: DataFrame, oid: str) -> DataFrame:
    return lookup(events, "oid", oid).orderBy(F.desc("event_at"), F.desc("id"))


def relations_of(relations: DataFrame, oid: str) -> DataFrame:
    return relations.filter((F.col("source_oid") == oid) | (F.col("target_oid") == oid))


def pending(queue: DataFrame) -> DataFrame:
    return queue.filter((F.col("status") == "pending") | (F.col("review_status") == "pending_review"))


def _named(objects: DataFrame, prefix: str) -> DataFrame:
    return objects.select(
        F.col("oid").alias(f"_{prefix}"), F.col("type").alias(f"{prefix}_type"), F.col("name").alias(f"{prefix}_name")
    )


def timeline_view(events: DataFrame, objects: DataFrame) -> DataFrame:
    o = _named(objects, "object")
    return events.join(o, F.col("oid") == F.col("_object"), "left").drop("_object")


def relation_view(relations: DataFrame, objects: DataFrame) -> DataFrame:
    s, t = _named(objects, "source"), _named(objects, "target")
    return (
        relations.join(s, F.col("source_oid") == F.col("_source"), "left")
        .join(t, F.col("target_oid") == F.col("_target"), "left")
        .drop("_source", "_target")
    )


def resource_view(resources: DataFrame, objects: DataFrame) -> DataFrame:
    o = _named(objects, "object")
    return resources.join(o, F.col("resource_oid") == F.col("_object"), "left").drop("_object")


def plugin_registry(metadata: DataFrame, objects: DataFrame) -> DataFrame:
    o = _named(objects, "object").filter("object_type = 'Plugin'")
    return metadata.join(o, F.col("plugin_oid") == F.col("_object")).drop("_object")


def plugin_services(links: DataFrame, objects: DataFrame) -> DataFrame:
    p, s = _named(objects, "plugin"), _named(objects, "service")
    return (
        links.join(p, F.col("plugin_oid") == F.col("_plugin"), "left")
        .join(s, F.col("service_oid") == F.col("_service"), "left")
        .drop("_plugin", "_service")
    )


def _holds(c: Column, text: str) -> Column:
    return F.instr(F.lower(F.coalesce(c, F.lit(""))), text.lower()) > 0


def _section(df: DataFrame, no: int, kind: str, ident: Column, name: Column, fields: list[str], text: str) -> DataFrame:
    """The rows of which a field holds text; detail is the first such field with its value."""
    hit = F.coalesce(*[F.when(_holds(F.col(f), text), F.concat(F.lit(f"{f}:"), F.coalesce(F.col(f), F.lit("")))) for f in fields])
    rows = df.select(F.lit(no).alias("section"), F.lit(kind).alias("kind"), ident.cast("string").alias("ident"), name.alias("name"), hit.alias("detail"))
    return rows.filter("detail is not null")


def search(objects: DataFrame, resources: DataFrame, events: DataFrame, relations: DataFrame, text: str) -> DataFrame:
    """Objects, resources, events and relations whose fields hold text in any case; section gives their order."""
    ends = F.concat("source_oid", F.lit("->"), "target_oid")
    return (
        _section(objects, 1, "object", F.col("oid"), F.col("name"), ["oid", "type", "name", "status"], text)
        .unionByName(_section(resources, 2, "resource", F.col("resource_oid"), F.col("filename"), ["filename", "path", "extension", "status"], text))
        .unionByName(_section(events, 3, "event", F.col("id"), F.col("event_type"), ["event_type", "description", "oid"], text))
        .unionByName(_section(relations, 4, "relation", F.col("id"), ends, ["relation_type", "source_oid", "target_oid"], text))
    )


def first_of_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def compare_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of both sides with side: left, right or both."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right").otherwise("both")
    return a.join(b, key, "full").select(key, side.alias("side"))
