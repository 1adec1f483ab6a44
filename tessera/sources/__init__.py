"""Readers: JSON lines, event files, entity-grouped JSON, file scans, Markdown tables, text extraction, notes and mail."""

from __future__ import annotations

import re
from collections.abc import Iterator
from email import policy
from email.parser import BytesParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions import properties as P
from tessera.functions import text as X


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, ord: the lines of text files; ord rises by file, then by line: the file's path, where the block that was read
    begins in it, and the row's place in that block, whatever files and blocks a task was given.  It needs no shuffle."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.option("wholetext", False).text(path).select("value", place.alias("ord"))


def read_index(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """JSON lines keyed by key; of several lines with a key the last one holds."""
    rows = numbered_lines(spark, path).filter(F.trim("value") != "").select(F.from_json("value", schema).alias("r"), "ord")
    w = Window.partitionBy(F.col(f"r.{key}")).orderBy(F.desc("ord"))
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("r.*")


def read_events(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(events, faults) of an append-only JSON-lines file.  A last line that can't be read is a truncated tail and only
    left out; any other is a fault: ord, value."""
    corrupt = StructType([*schema.fields]).add("_corrupt", "string")
    rows = numbered_lines(spark, path).withColumn("r", F.from_json("value", corrupt, {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    last = rows.agg(F.max("ord").alias("_last"))
    rows = rows.join(F.broadcast(last), F.lit(True))  # one row
    events = rows.filter(~bad).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema], "ord")
    return events, rows.filter(bad & (F.col("ord") < F.col("_last"))).select("ord", "value")


def truncated_tail(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row for an append-only JSON-lines file: valid_end (bytes up to where its readable part ends) and
    discarded_bytes (of a last line that can't be read)."""
    corrupt = StructType([*schema.fields]).add("_corrupt", "string")
    rows = numbered_lines(spark, path).withColumn("r", F.from_json("value", corrupt, {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    size = F.octet_length("value").cast("long")
    got = rows.agg(F.sum(size + 1).alias("all"), F.max_by(F.when(bad, size).otherwise(-1), "ord").alias("tail"))
    lost = F.greatest(F.coalesce("tail", F.lit(-1)), F.lit(-1))
    return got.select(F.when(lost >= 0, F.col("all") - lost - 1).otherwise(F.coalesce("all", F.lit(0))).alias("valid_end"), F.greatest(lost, F.lit(0)).alias("discarded_bytes"))


def read_records(spark: SparkSession, path: str, schema: StructType, valid: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, the lines that can't be read or whose record breaks the condition valid)."""
    corrupt = StructType([*schema.fields]).add("_corrupt", "string")
    rows = numbered_lines(spark, path).select(F.from_json("value", corrupt, {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"), "value", "ord").select("r.*", "value", "ord")
    ok = F.col("_corrupt").isNull() & F.coalesce(F.expr(valid), F.lit(False))
    return rows.filter(ok).drop("value", "_corrupt"), rows.filter(~ok).select("ord", "value")


def read_record_files(spark: SparkSession, path: str, schema: StructType, valid: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, notes, failed) of files of JSON lines, each file by itself.  A line that isn't JSON makes its whole file
    unreadable: failed has file and unreadable (how many lines), and none of its records count.  In the other files a record
    that breaks the condition valid, or whose fields have other types, is left out and noted: notes has file, ord, value.
    Blank lines are nothing; records carry file and ord.  Only the files with an unreadable line are told to the others,
    so no file is gathered in one task."""
    corrupt = StructType([*schema.fields]).add("_corrupt", "string")
    lines = numbered_lines(spark, path).filter(~X.is_empty(F.col("value"))).withColumn("file", F.col("ord.file"))
    failed = lines.filter(F.try_parse_json("value").isNull()).groupBy("file").agg(F.count("*").alias("unreadable"))
    held = lines.join(failed.select(F.col("file").alias("_f")), F.col("file") == F.col("_f"), "left_anti")
    read = held.select("file", "ord", "value", F.from_json("value", corrupt, {"columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("file", "ord", "value", "r.*")
    ok = F.col("_corrupt").isNull() & F.coalesce(F.expr(valid), F.lit(False))
    return read.filter(ok).drop("value", "_corrupt"), read.filter(~ok).select("file", "ord", "value"), failed


def read_entities(spark: SparkSession, path: str, row: str) -> DataFrame:
    """{entity: [row, ...]} files as entity and the row's columns; a missing id becomes entity:position."""
    held = spark.read.option("wholetext", True).text(path).select(F.from_json("value", f"map<string, array<struct<{row}>>>").alias("m"))
    each = held.select(F.explode("m").alias("entity", "rows")).select("entity", F.posexplode("rows").alias("_i", "r")).select("entity", "_i", "r.*")
    made = F.concat(F.col("entity"), F.lit(":"), F.lpad(F.col("_i").cast("string"), 5, "0"))
    return each.withColumn("id", F.coalesce("id", made)).drop("_i")


def scan_files(spark: SparkSession, root: str, pattern: str = "*", skip: str | None = None) -> DataFrame:
    """path, filename, extension, size_bytes, modified_at, sha256 and file_id of every file under root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    out = files.select(
        "path", name.alias("filename"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("extension"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"), F.sha2("content", 256).alias("sha256"),
    ).withColumn("file_id", F.concat(F.lit("sha256:"), "sha256"))
    return out.filter(~F.col("path").contains(skip)) if skip else out


def file_index(files: DataFrame) -> DataFrame:
    """One row a content with its paths in order."""
    return files.groupBy("file_id", "sha256").agg(F.sort_array(F.collect_set("path")).alias("paths"), F.min("size_bytes").alias("size_bytes"), F.min("extension").alias("extension"))


#: How an extraction ends, the extensions that are read as text, those that need another reader.
EXTRACTION_STATUSES = ("SUCCESS", "OCR_REQUIRED", "UNSUPPORTED_FORMAT", "FILE_TOO_LARGE", "EXTRACTION_ABORTED_STALE_HASH", "EXTRACTION_FAILED")
READ_AS_TEXT = ("md", "txt", "html", "csv", "json")
READ_ELSEWHERE = ("pdf", "docx", "doc")


def extract_text(spark: SparkSession, root: str, most: int = 50_000_000, index: DataFrame | None = None) -> DataFrame:
    """file_id, path, status and text of the files under root that are text.  Formats that need another reader arrive as
    tables of extraction records and aren't listed here; of the others, unknown ones are UNSUPPORTED_FORMAT, those over
    most bytes FILE_TOO_LARGE (and aren't read), those that aren't UTF-8 EXTRACTION_FAILED.  index (path, sha256), if given,
    tells which content is meant: another one is EXTRACTION_ABORTED_STALE_HASH."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.withColumn("_ext", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))).filter(~F.col("_ext").isin(*READ_ELSEWHERE))
    known = F.col("_ext").isin(*READ_AS_TEXT)
    refused = F.when(~known, "UNSUPPORTED_FORMAT").when(F.col("length") > most, "FILE_TOO_LARGE")
    # the length is pushed to the reader, so what is too large isn't read
    small = files.filter(F.col("length") <= most).select("path", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("file_id"), refused.alias("_refused"), F.when(known, F.col("content")).alias("_content"))
    stale = F.lit(False)
    if index is not None:
        held = index.select(F.col("path").alias("_p"), F.concat(F.lit("sha256:"), "sha256").alias("_h"))
        small = small.join(held, F.col("path") == F.col("_p"), "left")
        stale = F.coalesce(F.col("_h") != F.col("file_id"), F.lit(False))
    status = F.coalesce("_refused", F.when(stale, "EXTRACTION_ABORTED_STALE_HASH"), F.when(~F.is_valid_utf8("_content"), "EXTRACTION_FAILED"), F.lit("SUCCESS"))
    read = small.select("file_id", "path", status.alias("status"), F.when(status == "SUCCESS", F.try_validate_utf8("_content")).alias("text"))
    large = files.filter(F.col("length") > most).select(F.lit(None).cast("string").alias("file_id"), "path", refused.alias("status"), F.lit(None).cast("string").alias("text"))
    return read.unionByName(large)


def markdown_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of a report's table with that many columns, without header and rule."""
    rows = numbered_lines(spark, path).filter(F.col("value").rlike(r"^\s*\|.*\|\s*$") & ~F.col("value").rlike(r"^\s*\|[\s:|\-]+\|\s*$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = rows.select(cells.alias("c"), "ord").filter(F.size("c") == len(columns))
    head = rows.agg(F.min("ord").alias("_head"))
    rows = rows.join(F.broadcast(head), F.col("ord") > F.col("_head"))  # one row
    return rows.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(columns)])


def page_properties(pages: DataFrame, properties: str = "properties") -> DataFrame:
    """page_id, property, type and value of each property of remote pages (page_id, properties: a JSON object of typed
    properties): the value as JSON text, by its type, null where there is none."""
    each = pages.select("page_id", F.explode(F.from_json(properties, "map<string, string>")).alias("property", "_p"))
    return each.select("page_id", "property", F.get_json_object("_p", "$.type").alias("type"), F.to_json(P.decoded(F.col("_p"))).alias("value"))


def read_notes(spark: SparkSession, root: str) -> DataFrame:
    """path, name and content of normalised notes: a generated header (title from the header, else the first heading, else
    the file's name; type, date), the other header lines as they were, and the body."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(root)
    n = files.select("path", F.decode("content", "UTF-8").alias("raw"), F.to_date("modificationTime").cast("string").alias("day"))
    n = n.withColumn("f", X.split_frontmatter(F.col("raw")))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.md$", "")
    known = lambda k: F.nullif(F.element_at("f.known", F.lit(k)), F.lit(""))
    heading = F.nullif(F.regexp_extract("f.body", r"(?m)^#[ \t]+(\S.*?)[ \t]*$", 1), F.lit(""))
    n = n.withColumns({"title": F.coalesce(known("title"), heading, F.regexp_replace(stem, "[_-]", " ")), "type": F.coalesce(known("type"), F.lit("note")), "date": F.coalesce(known("date"), "day")})
    relative = F.regexp_replace("path", r"^.*?" + re.escape(root.rstrip("/").split("://")[-1]) + "/", "")
    ident = X.short_hash(relative)
    header = X.render_frontmatter(
        {"title": X.quoted(F.col("title")), "type": X.quoted(F.col("type")), "tags": F.lit('["nota-lavoro"]'), "date": X.quoted(F.col("date")), "source_kind": F.lit('"work_note"'), "source_hash": X.quoted(ident)}, F.col("f.other")
    )
    name = F.concat(F.lit("note-lavoro/"), "date", F.lit("-"), X.slug(F.col("title")), F.lit("-"), ident, F.lit(".md"))
    return n.select("path", name.alias("name"), F.concat(header, F.lit("\n\n"), F.regexp_replace("f.body", r"\s+\z", ""), F.lit("\n")).alias("content"))


def _message(path: str, content: bytes) -> dict:
    """The parts of one message that its page needs."""
    m = BytesParser(policy=policy.default).parsebytes(content)
    try:
        day = m["Date"].datetime.date().isoformat()
    except (AttributeError, TypeError):
        day = None
    part = m.get_body(preferencelist=("plain", "html"))
    try:
        text = part.get_content() if part is not None else ""
    except (LookupError, ValueError):
        text = ""
    head = lambda k: str(m.get(k) or "").strip()
    return {
        "path": path, "subject": head("Subject"), "message_id": head("Message-ID"), "sender": str(m.get("From") or ""), "recipients": ", ".join(str(m.get(h)) for h in ("To", "Cc") if m.get(h)), "day": day, "in_reply_to": head("In-Reply-To"),
        "list_unsubscribe": m.get("List-Unsubscribe"), "precedence": m.get("Precedence"), "text": text, "is_html": part is not None and part.get_content_type() == "text/html",
        "attachments": [p.get_filename() or "(senza nome)" for p in m.walk() if not p.is_multipart() and p.get_content_disposition() == "attachment"],
    }


MESSAGES = "path string, subject string, message_id string, sender string, recipients string, day string, in_reply_to string, list_unsubscribe string, precedence string, text string, is_html boolean, attachments array<string>"


def read_mail(spark: SparkSession, root: str, skip_bulk: bool = False) -> DataFrame:
    """path, name, content and outcome of messages: a page each, not_mail without sender and subject, skipped_bulk if
    asked.  Of one output name the message whose path comes last holds.  A message is parsed where it is read; all else
    are expressions."""

    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([_message(p, c) for p, c in zip(frame["path"], frame["content"], strict=True)])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    m = files.select("path", "content").mapInPandas(parsed, MESSAGES).join(files.select(F.col("path").alias("_p"), F.to_date("modificationTime").cast("string").alias("_day")), F.col("path") == F.col("_p"))
    m = m.withColumns({"outcome": F.when((F.col("sender") == "") & (F.col("subject") == ""), "not_mail").when(F.lit(skip_bulk) & X.is_bulk(F.col("list_unsubscribe"), F.col("precedence")), "skipped_bulk").otherwise("page"), "date": F.coalesce("day", "_day")})
    html = F.col("is_html") | F.col("text").rlike(r"(?i)^\s*<(!doctype html|html[\s>])")
    title = F.coalesce(F.nullif("subject", F.lit("")), F.lit("(senza oggetto)"))
    m = m.withColumns({"title": title, "plain": F.when(html, X.html_to_text(F.col("text"))).otherwise(F.col("text"))})
    m = m.withColumn("body", X.strip_quoted(F.col("plain")))
    key = F.coalesce(F.nullif("message_id", F.lit("")), X.short_hash(F.concat_ws("|", "title", "date", "sender", "plain")))
    ident = X.short_hash(key)
    more = F.filter(F.array(*[F.when(F.col(c) != "", F.concat(F.lit(f"{c}: "), X.quoted(F.col(c)))) for c in ("message_id", "in_reply_to")]), lambda x: x.isNotNull())
    header = X.render_frontmatter(
        {"title": X.quoted(F.col("title")), "type": F.lit('"email"'), "tags": F.lit('["mail-lavoro"]'), "date": X.quoted(F.col("date")), "source_kind": F.lit('"eml"'), "source_hash": X.quoted(ident), "from": X.quoted(F.col("sender")), "to": X.quoted(F.col("recipients"))}, more
    )
    to = F.when(F.length("recipients") <= 300, F.col("recipients")).otherwise(F.concat(F.left("recipients", F.lit(300)), F.lit("…")))
    line = F.concat(F.lit("**Da:** "), "sender", F.lit(" | **A:** "), to, F.lit(" | **Data:** "), "date")
    listed = F.transform("attachments", lambda a: F.concat(F.lit("- "), a, F.lit(" (non importato)")))
    files_ = F.when(F.size("attachments") > 0, F.concat(F.array(F.lit(""), F.lit("## Allegati")), listed)).otherwise(F.array().cast("array<string>"))
    page = F.array_join(F.concat(F.array(header, F.lit(""), F.concat(F.lit("# "), "title"), F.lit(""), line, F.lit(""), F.coalesce(F.nullif("body", F.lit("")), F.lit("(corpo vuoto)"))), files_), "\n")
    name = F.concat(F.lit("mail-lavoro/"), "date", F.lit("-"), X.slug(F.col("title")), F.lit("-"), ident, F.lit(".md"))
    own = F.col("outcome") == "page"
    m = m.select("path", F.when(own, name).alias("name"), F.when(own, F.concat(F.regexp_replace(page, r"\s+\z", ""), F.lit("\n"))).alias("content"), "outcome")
    last = F.row_number().over(Window.partitionBy(F.coalesce("name", "path")).orderBy(F.desc("path")))
    return m.withColumn("_rn", last).filter("_rn = 1").drop("_rn")


def read_folder_objects(spark: SparkSession, listing: DataFrame, documents: DataFrame, id_key: str) -> tuple[DataFrame, DataFrame]:
    """(rows, aliases) of a folder of folders: id and title of each folder (listing: folder) from its YAML document
    (documents: folder, text), which gives the id, the name and aliases; without a readable one the folder's name is both."""
    held = documents.select(F.col("folder").alias("_f"), F.col("text").alias("_t"))
    out = listing.select("folder").distinct().join(held, F.col("folder") == F.col("_f"), "left")
    value = lambda k: F.nullif(F.regexp_replace(X.strip(F.regexp_extract("_t", rf"(?m)^{k}:[ \t]*(.*)$", 1)), r"^[\"']|[\"']$", ""), F.lit(""))
    rows = out.select(F.coalesce(value(id_key), "folder").alias("id"), F.coalesce(value("name"), "folder").alias("title"), "_t")
    block = F.regexp_extract("_t", r"(?m)^aliases:[ \t]*\n((?:[ \t]*-[ \t]*.*\n?)*)", 1)
    flow = F.split(F.regexp_extract("_t", r"(?m)^aliases:[ \t]*\[(.*)\][ \t]*$", 1), ",")
    each = F.concat(F.transform(F.split(block, "\n"), lambda x: F.regexp_replace(x, r"^[ \t]*-[ \t]*", "")), flow)
    aliases = rows.select(F.explode(each).alias("a"), "title").select(X.norm(F.regexp_replace(X.strip(F.col("a")), r"^[\"']|[\"']$", "")).alias("alias"), X.norm(F.col("title")).alias("name")).filter("alias <> ''")
    return rows.drop("_t"), aliases
