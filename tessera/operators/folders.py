"""Folder trees from flat listings: sums bottom up, and the tree in reading order.

Each path is expanded into its ancestors, so that a folder's sums are one aggregation with partial sums and a folder of
any size is spread over tasks.  The tree is made of joins on folders too: which entry is a folder's last is a maximum,
the first files of a folder are a ranking that Spark cuts before the shuffle, and the bars before a line come from its
ancestors.  The root is the empty path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X

#: Fixed value: files of a folder that the tree shows.
SHOWN = 12
KINDS = {"directory": 0, "file": 1, "special": 2, "hidden": 3}


def parent(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, r"(?s)/[^/]*$", "")).otherwise("")


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def ancestors(path: Column, own: bool = False) -> Column:
    """The folders above a path from the top, the root ('') first; with own, the path itself last."""
    parts = F.split(path, "/")
    upto = F.size(parts) if own else F.size(parts) - 1
    return F.transform(F.sequence(F.lit(0), upto), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def folder_sums(files: DataFrame, problems: DataFrame | None = None) -> DataFrame:
    """folder, files and bytes (directly in it), all_files, all_bytes and all_problems (at any depth) of every folder that
    files (path, size_bytes) or problems (path) are in."""
    each = files.select(F.explode(ancestors(F.col("path"))).alias("folder"), parent(F.col("path")).alias("_own"), "size_bytes", F.lit(0).alias("_problem"))
    if problems is not None:
        each = each.unionByName(problems.select(F.explode(ancestors(F.col("path"))).alias("folder"), F.lit(None).cast("string").alias("_own"), F.lit(None).cast("long").alias("size_bytes"), F.lit(1).alias("_problem")))
    own, file = F.col("folder") == F.col("_own"), F.col("_problem") == 0
    return each.groupBy("folder").agg(
        F.count_if(own).alias("files"),
        F.coalesce(F.sum(F.when(own, F.col("size_bytes"))), F.lit(0)).cast("long").alias("bytes"),
        F.count_if(file).alias("all_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("all_bytes"),
        F.count_if(~file).alias("all_problems"),
    )


def tree_entries(files: DataFrame, special: DataFrame | None = None, shown: int = SHOWN) -> DataFrame:
    """parent, kind (a number of KINDS), key and label of every line of the tree under its root: folders, the first files
    of each, special entries (path, label) and how many files aren't shown."""
    paths = files.select("path") if special is None else files.select("path").unionByName(special.select("path"))
    folders = paths.select(F.explode(ancestors(F.col("path"))).alias("path")).filter("path <> ''").distinct()
    held = files.select(parent(F.col("path")).alias("parent"), name(F.col("path")).alias("key"))
    first = F.row_number().over(Window.partitionBy("parent").orderBy(F.lower("key"), "key"))
    top = held.withColumn("_rn", first).filter(F.col("_rn") <= shown)
    more = held.groupBy("parent").agg((F.count("*") - shown).alias("n")).filter("n > 0")
    line = lambda c: X.safe_text(c, 10_000)
    kind = lambda k: F.lit(KINDS[k]).alias("kind")
    out = folders.select(parent(F.col("path")).alias("parent"), kind("directory"), name(F.col("path")).alias("key"), F.concat(line(name(F.col("path"))), F.lit("/")).alias("label"))
    out = out.unionByName(top.select("parent", kind("file"), "key", line(F.col("key")).alias("label")))
    if special is not None:
        out = out.unionByName(special.select(parent(F.col("path")).alias("parent"), kind("special"), name(F.col("path")).alias("key"), line(F.col("label")).alias("label")))
    return out.unionByName(more.select("parent", kind("hidden"), F.lit("").alias("key"), F.concat(F.lit("… "), F.col("n").cast("string"), F.lit(" altri file")).alias("label")))


def tree_lines(files: DataFrame, special: DataFrame | None = None, shown: int = SHOWN) -> DataFrame:
    """ord and line of the tree; ord is comparable and in reading order: folders first, then files, special entries and the
    count of the rest, names in any case.  Rows alike in kind and name stand for one line each."""
    entries = tree_entries(files, special, shown)
    rank = F.struct("kind", F.lower("key").alias("folded"), "key")
    last = entries.groupBy("parent").agg(F.max(rank).alias("_last")).select(F.col("parent").alias("_parent"), "_last")
    entries = entries.join(last, F.col("parent") == F.col("_parent")).withColumn("last", F.col("_last") == rank).drop("_parent", "_last")
    path = F.when(F.col("parent") == "", F.col("key")).otherwise(F.concat_ws("/", "parent", "key"))
    closed = entries.filter(F.col("kind") == KINDS["directory"]).select(path.alias("_folder"), F.col("last").alias("_closed"))
    above = F.filter(ancestors(F.col("parent"), own=True), lambda a: a != "")
    bars = entries.select("parent").distinct().select("parent", F.posexplode(above).alias("_depth", "_above"))
    bars = bars.join(closed, F.col("_above") == F.col("_folder"))
    bar = F.when(F.col("_closed"), "    ").otherwise("│   ")
    bars = bars.groupBy(F.col("parent").alias("_parent")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_depth", bar.alias("b")))), lambda x: x["b"]), "").alias("_bars"))
    out = entries.join(bars, F.col("parent") == F.col("_parent"), "left")
    step = lambda kind, key: F.struct(kind.alias("kind"), F.lower(key).alias("folded"), key.alias("key"))
    over = F.transform(F.filter(F.split("parent", "/"), lambda p: p != ""), lambda p: step(F.lit(KINDS["directory"]), p))
    ord_ = F.concat(over, F.array(step(F.col("kind"), F.col("key"))))
    return out.select(ord_.alias("ord"), F.concat(F.coalesce("_bars", F.lit("")), F.when(F.col("last"), "└── ").otherwise("├── "), "label").alias("line"))


def folder_report(root: str, files: DataFrame, problems: DataFrame) -> DataFrame:
    """part, ord and line: the Markdown of a folder's report, to be read in order of part and ord.  files: path,
    size_bytes, sha256; problems: path, problem."""
    none = F.array().cast("array<struct<kind:int,folded:string,key:string>>")
    say = lambda part, line, order=none: (F.lit(part).alias("part"), order.alias("ord"), line.alias("line"))
    by = lambda *keys: F.array(*[F.struct(F.lit(0).alias("kind"), k.cast("string").alias("folded"), F.lit("").alias("key")) for k in keys])
    sums = folder_sums(files, problems)
    top = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))
    head = F.array(
        F.lit(f"# {root}"), F.lit(""), F.concat(F.lit("**Files successfully inventoried:** "), F.col("files").cast("string"), F.lit("  ")), F.concat(F.lit("**Total size:** "), X.human_size(F.col("bytes"))), F.lit(""), F.lit("## Directory structure"), F.lit(""), F.lit(f"{root}/")
    )
    each = [top.select(F.posexplode(head).alias("_i", "_line")).select(*say(0, F.col("_line"), by(F.lpad(F.col("_i").cast("string"), 4, "0"))))]
    special = problems.select("path", F.concat(name(F.col("path")), F.lit(" ["), "problem", F.lit("]")).alias("label"))
    each.append(tree_lines(files, special).select(F.lit(1).alias("part"), "ord", "line"))
    ext = F.coalesce(F.nullif(F.lower(F.regexp_extract(name(F.col("path")), r"(?s)^.+?(\.[^.]+)$", 1)), F.lit("")), F.lit("[no extension]"))
    kinds = files.groupBy(ext.alias("_e")).agg(F.count("*").alias("_n"))
    first = F.lpad((F.lit(10**18 - 1) - F.col("_n")).cast("string"), 18, "0")
    each.append(kinds.select(*say(2, F.concat(F.lit("- `"), "_e", F.lit("`: "), F.col("_n").cast("string")), by(first, F.col("_e")))))
    size = X.human_size(F.col("all_bytes"))
    each.append(sums.select(*say(3, F.concat(F.lit("- `"), F.concat("folder", F.lit("/")), F.lit("`: "), F.col("all_files").cast("string"), F.lit(" files, "), size, F.lit(", "), F.col("all_problems").cast("string"), F.lit(" problems")), by(F.lower("folder"), F.col("folder")))))
    twice = files.groupBy("sha256").agg(F.sort_array(F.collect_list("path")).alias("_p")).filter(F.size("_p") > 1)
    listed = F.concat(F.array(F.concat(F.lit("- `"), F.left("sha256", F.lit(12)), F.lit("…`"))), F.transform("_p", lambda p: F.concat(F.lit("  - `"), p, F.lit("`"))))
    twice = twice.select("sha256", F.posexplode(listed).alias("_i", "_line"))
    each.append(twice.select(*say(4, F.col("_line"), by(F.col("sha256"), F.lpad(F.col("_i").cast("string"), 12, "0")))))
    each.append(problems.select(*say(5, F.concat(F.lit("- `"), "path", F.lit(": "), "problem", F.lit("`")), by(F.col("path")))))
    titles = ((2, "## File types"), (3, "## Folders"), (4, "## Exact duplicates inside source"), (5, "## Scan evidence"))
    spark = files.sparkSession
    heads = spark.createDataFrame([(p, t) for p, t in titles], "part int, line string").select("part", none.alias("ord"), F.explode(F.array(F.lit(""), "line", F.lit(""))).alias("line"))
    out = each[0]
    for more in [*each[1:], heads.select("part", by(F.lit("")).alias("ord"), "line")]:
        out = out.unionByName(more)
    return out
