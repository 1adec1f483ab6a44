"""Writers: canonical JSON lines, idempotent writes, upserts, bundles and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def canonical_json(df: DataFrame, key: str) -> DataFrame:
    """value: each row as JSON with its columns in order of name, sorted by key."""
    return df.orderBy(key).select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def write_canonical(df: DataFrame, key: str, path: str) -> None:
    """The JSON-lines index, sorted by key over all part files (part-00000 holds the least keys)."""
    canonical_json(df, key).write.mode("overwrite").text(path)


def changed_only(new: DataFrame, old: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Rows of new whose content differs from that of old or that old lacks: what an idempotent sink has to write."""
    digest = F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in content]), 256)
    seen = old.select(F.col(key).alias("_k"), digest.alias("_d"))
    return new.withColumn("_digest", digest).join(seen, (F.col(key) == F.col("_k")) & (F.col("_digest") == F.col("_d")), "left_anti").drop("_digest")


def upsert(table: DataFrame, rows: DataFrame, key: str, ident: str | None = None) -> DataFrame:
    """table with the rows in place of those that have their key.  With ident, of several rows for a key the last by ident
    holds, and it keeps the least ident that the key has had."""
    if ident is None:
        return table.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows)
    first = F.min(ident).over(Window.partitionBy(key))
    both = table.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    fresh = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_new"), F.desc(ident)))
    return both.withColumns({"_first": first, "_rn": fresh}).filter("_rn = 1").withColumn(ident, F.col("_first")).select(*table.columns)


def append_rotating(rows: DataFrame, path: str, limit: int) -> None:
    """Appends rows as JSON lines under path; once what is there exceeds limit bytes it first becomes path.1, in place of
    what was there."""
    spark = rows.sparkSession
    here, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, path.rstrip("/") + ".1"))
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(here) and fs.getContentSummary(here).getLength() > limit:
        fs.delete(old, True)
        fs.rename(here, old)
    rows.write.mode("append").json(path)


def append_events(table: DataFrame, rows: DataFrame) -> DataFrame:
    """An append-only log with further rows; ids that exist already, or a second row that supersedes the same event, are
    refused when the result is read."""
    clash = rows.join(table.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left")
    bad = F.when(F.col("_id").isNotNull(), F.raise_error(F.concat(F.lit("event exists: "), F.col("id").cast("string"))).cast("long")).otherwise(F.col("id"))
    return table.unionByName(clash.withColumn("id", bad).select(*table.columns))


def write_bundle(frames: dict[str, DataFrame], path: str, by: str) -> None:
    """An evidence bundle: each frame as JSON under path/name, split by entity."""
    for name, df in frames.items():
        df.write.mode("overwrite").partitionBy(by).json(f"{path}/{name}")


def manifest(files: DataFrame) -> DataFrame:
    return files.select("path", "size_bytes", "sha256").orderBy("path")
