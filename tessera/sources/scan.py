"""Scans of file trees: metadata first, content only of what changed, and strict scans that refuse a moving tree.

A listing never reads content.  What an index knows by path, length and time of modification keeps its hash; only the
rest is opened, by the task that has its row, a piece at a time, so a file of any size is hashed in bounded memory.
"""

from __future__ import annotations

import hashlib
import mimetypes
import os
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the folder of generated pages, which is no source.
GENERATED = "10_MD_PROCESSED_FILES"
PIECE = 1 << 20
HASHED = "sha256 string, mime_type string, error string"


def _linked(root: str):
    """Whether a path or a folder between root and it is a symbolic link; only local paths can be."""

    @F.pandas_udf("boolean")
    def test(paths: pd.Series) -> pd.Series:
        known: dict[str, bool] = {}

        def link(path: str) -> bool:
            if path not in known:
                up = os.path.dirname(path)
                known[path] = os.path.islink(path) or (len(up) > len(root) and link(up))
            return known[path]

        return paths.map(lambda p: p.startswith("file:") and link("/" + p[5:].lstrip("/")))

    return test


def list_files(spark: SparkSession, root: str, skip: str = GENERATED) -> DataFrame:
    """path, rel (below root), size_bytes and modified_at of every file under root, links and what lies in a folder skip
    left out.  No content is read."""
    bare = "/" + root.split(":", 1)[-1].strip("/") if "://" not in root or root.startswith("file:") else root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    plain = F.regexp_replace("path", r"^file:/+", "/") if bare.startswith("/") else F.col("path")
    rel = F.substring(plain, len(bare) + 2, F.length("path"))
    out = files.filter(~_linked(bare)("path")).withColumn("rel", rel)
    return out.filter(~F.array_contains(F.split("rel", "/"), skip)).select("path", "rel", "size_bytes", "modified_at")


def scan_plan(listing: DataFrame, known: DataFrame) -> DataFrame:
    """rel and plan of every path of a listing (rel, size_bytes, modified_at) or of what is known (the same and sha256):
    unchanged, changed, new or vanished."""
    old = known.select(F.col("rel").alias("_rel"), F.col("size_bytes").alias("_size"), F.col("modified_at").alias("_at"), F.col("sha256").alias("_sha"))
    both = listing.join(old, F.col("rel") == F.col("_rel"), "full")
    same = (F.col("size_bytes") == F.col("_size")) & (F.col("modified_at") == F.col("_at")) & F.col("_sha").isNotNull()
    plan = F.when(F.col("rel").isNull(), "vanished").when(F.col("_rel").isNull(), "new").when(same, "unchanged").otherwise("changed")
    kept = [c for c in listing.columns if c != "rel"]
    return both.select(F.coalesce("rel", "_rel").alias("rel"), *kept, F.when(plan == "unchanged", F.col("_sha")).alias("sha256"), plan.alias("plan"))


def _digest(path: str) -> tuple[str | None, str | None]:
    from pyarrow import fs

    try:
        if path.startswith("file:"):  # a plain path, not an escaped URI
            where, inside = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        else:
            where, inside = fs.FileSystem.from_uri(quote(path, safe=":/@"))
        digest = hashlib.sha256()
        with where.open_input_stream(inside) as stream:
            while piece := stream.read(PIECE):
                digest.update(piece)
        return digest.hexdigest(), None
    except (OSError, ValueError) as e:
        return None, f"{type(e).__name__}: {e}"[:500]


def hash_files(files: DataFrame) -> DataFrame:
    """files (with a path) and sha256, mime_type and, where one can't be read, the error."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema), HASHED])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [_described(p) for p in frame["path"]]
            yield frame.assign(**{c: [g[i] for g in got] for i, c in enumerate(("sha256", "mime_type", "error"))})

    return files.mapInPandas(run, schema)


def _described(path: str) -> tuple[str | None, str, str | None]:
    digest, error = _digest(path)
    return digest, mimetypes.guess_type(path)[0] or "application/octet-stream", error


def incremental_scan(spark: SparkSession, root: str, known: DataFrame, skip: str = GENERATED) -> DataFrame:
    """rel, size_bytes, modified_at, sha256, mime_type, error and hashed of every file under root.  known: the rows of the
    last scan; what it has of a path with the same length and time is taken over, all else is read (hashed).  Files that
    can't be read have an error and no hash; vanished paths are gone."""
    planned = scan_plan(list_files(spark, root, skip), known).filter("plan <> 'vanished'")
    mime = known.select(F.col("rel").alias("_rel"), F.col("mime_type").alias("_mime"))
    columns = ("rel", "size_bytes", "modified_at", "sha256", "mime_type", "error")
    kept = planned.filter("plan = 'unchanged'").join(mime, F.col("rel") == F.col("_rel"), "left")
    kept = kept.select("rel", "size_bytes", "modified_at", "sha256", F.col("_mime").alias("mime_type"), F.lit(None).cast("string").alias("error"), F.lit(False).alias("hashed"))
    # reading is what costs: what changed is dealt evenly, whatever the listing's partitions
    fresh = hash_files(planned.filter("plan <> 'unchanged'").select("path", "rel", "size_bytes", "modified_at").repartition("rel"))
    return kept.unionByName(fresh.select(*columns, F.lit(True).alias("hashed")))


def suffix(name: Column) -> Column:
    """The last extension with its point, in lower case; none for names that only begin with a point."""
    return F.lower(F.regexp_extract(name, r"(?s)^.+?(\.[^.]+)$", 1))


def content_index(files: DataFrame) -> DataFrame:
    """The index of a scan: a row a content with all its paths in order; name, extension, time and type are those of the
    path that comes last."""
    read = files.filter("sha256 IS NOT NULL")
    last = F.max_by(F.struct("rel", "size_bytes", "modified_at", "mime_type"), "rel").alias("last")
    per = read.groupBy("sha256").agg(F.sort_array(F.collect_set("rel")).alias("paths"), last)
    name = F.element_at(F.split("last.rel", "/"), -1)
    return per.select(
        F.concat(F.lit("sha256:"), "sha256").alias("file_id"), "sha256", "paths", name.alias("filename"), suffix(name).alias("extension"), "last.size_bytes", "last.modified_at", "last.mime_type", F.lit("INDEXED").alias("scan_status")
    )


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """rel and what happened to it (appeared, disappeared, changed) between two listings."""
    b = after.select(F.col("rel").alias("_rel"), F.col("size_bytes").alias("_size"), F.col("modified_at").alias("_at"))
    both = before.join(b, F.col("rel") == F.col("_rel"), "full")
    what = F.when(F.col("rel").isNull(), "appeared").when(F.col("_rel").isNull(), "disappeared")
    what = what.when((F.col("size_bytes") != F.col("_size")) | (F.col("modified_at") != F.col("_at")), "changed")
    return both.select(F.coalesce("rel", "_rel").alias("rel"), what.alias("what")).filter("what IS NOT NULL")


def strict_scan(spark: SparkSession, root: str, target: str, skip: str = "") -> DataFrame:
    """A scan that holds only if nothing moved while it ran: every file is hashed and written to target (Parquet), then
    the tree is listed again.  A file that can't be read, or a path whose length or time is otherwise, fails the whole."""
    before = list_files(spark, root, skip)
    hash_files(before).write.mode("overwrite").parquet(target)
    held = spark.read.parquet(target)
    wrong = held.filter("sha256 IS NULL").select("rel", F.lit("unreadable").alias("what"))
    fresh = list_files(spark, root, skip)
    wrong = wrong.unionByName(moved(held.select("rel", "size_bytes", "modified_at"), fresh))
    shown = [f"{r['rel']}: {r['what']}" for r in wrong.orderBy("rel").limit(10).collect()]
    if shown:
        raise ValueError("the tree changed or can't be read while it was scanned: " + "; ".join(shown))
    return held
