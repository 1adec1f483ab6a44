"""Text as columns: normalisation, quality, chunks, signals, redaction, parsing.

Everything is an expression over Spark functions but lossless_chunks, paragraph_chunks and halves, whose cuts depend on
all boundaries or on the cuts before and which therefore are Arrow UDFs, and normal_sentences.  exact_norm is what norm is tested against.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache
from hashlib import sha256
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=1)
def decompositions() -> dict[str, str]:
    """Every character but the ASCII ones that compatibility decomposition turns into something with ASCII letters or
    digits, or into marks only, with what is left without marks; what isn't ASCII there is a space."""
    out = {}
    for code in [*range(0x80, 0xD800), *range(0xE000, 0x110000)]:
        x = chr(code)
        if unicodedata.combining(x):
            out[x] = ""
        elif whole := unicodedata.decomposition(x) and unicodedata.normalize("NFKD", x):
            base = "".join(c if c.isascii() else " " for c in whole if not unicodedata.combining(c))
            if not base or any(c.isalnum() for c in base):
                out[x] = base
    return out


@lru_cache(maxsize=1)
def folding() -> tuple[str, str]:
    """Characters that decompose to one ASCII character and marks, and that character; then marks, which have none."""
    found = sorted(decompositions().items(), key=lambda x: x[1] == "")
    return "".join(x for x, base in found if len(base) < 2), "".join(base for _, base in found if len(base) == 1)


@lru_cache(maxsize=1)
def expansions() -> tuple[str, list[tuple[str, str]]]:
    """The class of the characters that decompose to several, and for each place of what they become, the characters and
    theirs at that place; those that become shorter come last and have none."""
    several = {x: base for x, base in decompositions().items() if len(base) > 1}
    ranges: list[list[int]] = []
    for code in sorted(map(ord, several)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    kind = "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in ranges)
    longest = sorted(several, key=lambda x: -len(several[x]))
    return kind, [("".join(longest), "".join(several[x][i] for x in longest if i < len(several[x]))) for i in range(len(several[longest[0]]))]


def expand(c: Column) -> Column:
    """Characters that decompose to several as these (ligatures, fractions, circled numbers, units)."""
    kind, places = expansions()
    has = rf"(?=[^\x00-\x7f])[{kind}]"  # an ASCII character is told by one range, not by all of them
    piece = lambda x: F.when(x.rlike(f"^{has}"), F.concat(*[F.translate(x, *p) for p in places])).otherwise(x)
    pieces = F.regexp_extract_all(c, F.lit(f"[{kind}]|[^{kind}]+"), F.lit(0))
    return F.when(c.rlike(has), F.array_join(F.transform(pieces, piece), "")).otherwise(c)


@lru_cache(maxsize=1)
def normal_table() -> tuple[str, str, int]:
    """folding() with capitals small and other ASCII characters than letters, digits and the space as spaces: characters,
    what they become, and how many of them, at the front, are the ASCII ones."""
    characters, bases = folding()
    ascii_ = [chr(i) for i in range(0x80) if not re.match(r"[a-z0-9 ]", chr(i))]
    return "".join(ascii_) + characters, "".join(x.lower() if x.isalpha() else " " for x in ascii_) + bases.lower(), len(ascii_)


def fold(c: Column) -> Column:
    """Accents and marks off, compatibility characters as the ASCII letters and digits they decompose to; ASCII texts
    aren't touched."""
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(expand(c), *folding())).otherwise(c)


def norm(c: Column, null_as: str = "") -> Column:
    """Accents folded, lower case, runs of anything but a-z and 0-9 one space, none at the ends.  By tables of characters:
    a pattern that stops at every word takes several times as long."""
    characters, become, n = normal_table()
    text = F.coalesce(c.cast("string"), F.lit(null_as))
    folded = F.regexp_replace(F.translate(expand(text), characters, become), r"[^\x00-\x7f]+", " ")
    spaced = F.when(text.rlike(r"[^\x00-\x7f]"), folded).otherwise(F.translate(text, characters[:n], become[:n]))
    # no control character is left: one after each space, then those before a space go with it, then the others
    return F.trim(F.replace(F.replace(F.replace(spaced, F.lit(" "), F.lit(" \u0001")), F.lit("\u0001 "), F.lit("")), F.lit("\u0001"), F.lit("")))


class _Normal(dict):
    """norm's table for str.translate, which keeps U+0001: what it lacks is a space."""

    def __missing__(self, code: int) -> str:
        return " "


@lru_cache(maxsize=1)
def _normal() -> _Normal:
    return _Normal({ord(x): "".join(b.lower() if b.isalnum() else " " for b in base) for x, base in [*decompositions().items(), *((chr(i), chr(i)) for i in range(0x80))]} | {1: "\x01"})


_SENTENCE_END = re.compile(r"[.!?][ \t\n\x0b\f\r]+")


def _sentences(text: str, longer: int) -> tuple[str, list[bytes]]:
    # U+0001 stands between sentences; one of the text's own is a control character as good as U+0002
    parts, at, text = [], 0, text.replace("\x01", "\x02")
    for m in _SENTENCE_END.finditer(text):
        parts.append(text[at : m.start() + 1])
        at = m.end()
    parts.append(text[at:])
    table, plain = _normal(), "\x01".join(parts)
    foreign = [x for x in set(plain) if x > "\x7f"]
    for x in foreign if len(foreign) < 100 else ():  # ASCII texts are translated many times as fast
        plain = plain.replace(x, table[ord(x)])
    normal = [" ".join(n.split()) for n in plain.translate(table).split("\x01")]
    return " ".join(filter(None, normal)), [sha256(n.encode()).digest() for p, n in zip(parts, normal, strict=True) if len(p) > longer and len(p.strip(STRIPPED)) > longer]


def normal_sentences(longer: int = 40) -> Callable[[Column], Column]:
    """A struct of n, the normalised text, and keys, the digests of the normalised sentences of more characters than
    longer, white space around them apart.  What lies between sentences is white space, so their normalised texts joined
    by spaces are the text's.  An Arrow UDF, as whole texts take several times as long by expressions."""

    def both(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_sentences(t or "", longer) for t in texts], columns=["n", "keys"])

    return F.pandas_udf(both, "n string, keys array<binary>")


def plain_text(v: str) -> str:
    """Without accents, in lower case; for words of a configuration."""
    return "".join(c for c in unicodedata.normalize("NFKD", v or "") if not unicodedata.combining(c)).lower()


def exact_norm(values: pd.Series) -> pd.Series:
    def one(v):
        return " ".join(re.sub(r"[^a-z0-9\s]", " ", plain_text(v)).split())

    return values.map(one)


#: White space as text functions understand it: Unicode's, and the four separators U+001C to U+001F.
_SPACE = r"[\s\x1c-\x1f]"
#: Its characters.
STRIPPED = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, however often body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_empty(c: Column) -> Column:
    """Null or nothing but white space."""
    return c.isNull() | ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


_LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\u0085\u2028\u2029]"


def lines(c: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(c, _LINE_END), strip), lambda x: x != "")


#: What makes a numeric line, how short a short line is, and the shares from which a text looks garbled.
NUMERIC_LINE = r"^[\d\s.,/\-+€%]+$"
SHORT_LINE = 5
GARBLED_NUMERIC = 0.25
GARBLED_SHORT = 0.35


def text_quality(c: Column) -> Column:
    """lines, numeric_lines and short_lines, the shares of the latter two (0 without lines) and whether the text looks
    garbled."""

    def described(held: Column) -> Column:
        n = F.size(held)
        numeric = F.size(F.filter(held, lambda x: x.rlike(NUMERIC_LINE)))
        short = F.size(F.filter(held, lambda x: F.length(x) <= SHORT_LINE))
        share = lambda k: F.coalesce(F.try_divide(k.cast("double"), n.cast("double")), F.lit(0.0))
        return F.struct(
            n.cast("long").alias("lines"),
            numeric.cast("long").alias("numeric_lines"),
            short.cast("long").alias("short_lines"),
            share(numeric).alias("numeric_share"),
            share(short).alias("short_share"),
            ((share(numeric) > GARBLED_NUMERIC) | (share(short) > GARBLED_SHORT)).alias("garbled"),
        )

    return bind(lines(c), described)


def fixed_chunks(c: Column, size: int = 1500, overlap: int = 200) -> Column:
    """Windows of size characters, each overlap into the one before, the last where a window first reaches the end."""
    text = strip(F.coalesce(c, F.lit("")))
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - overlap - 1, F.lit(0)), F.lit(size - overlap))
    return F.transform(starts, lambda s: F.substring(text, s + 1, F.lit(size)))


#: Where a text may be cut, after a blank line or after the end of a sentence with its closing marks.
BOUNDARIES = (r"\n\n+", r"[.!?。！？][\"'»”)]*\s+")


def _boundaries(text: str) -> list[int]:
    return sorted({m.end() for p in BOUNDARIES for m in re.finditer(p, text)})


def _cut(text: str, limit: int) -> list[str]:
    if len(text) <= limit:
        return [text]
    ends, out, at = [*_boundaries(text), len(text)], [], 0
    while at < len(text):
        i = bisect_right(ends, at + limit) - 1
        to = ends[i] if i >= 0 and ends[i] > at else at + limit
        out.append(text[at:to])
        at = to
    return out


def lossless_chunks(limit: int = 8000) -> Callable[[Column], Column]:
    """Chunks of at most limit characters whose concatenation is the text: cut at the last boundary within the limit,
    else at the limit."""
    return F.pandas_udf(lambda s: s.map(lambda t: _cut(t or "", limit)), T.ArrayType(T.StringType()))


def _halve(text: str) -> list[str] | None:
    middle = len(text) // 2
    inner = [b for b in _boundaries(text) if 0 < b < len(text)]
    at = min(inner, key=lambda b: (abs(b - middle), b)) if inner else middle
    return [text[:at], text[at:]] if 0 < at < len(text) else None


def halves() -> Callable[[Column], Column]:
    """The text in two at the boundary nearest its middle, else there; null for texts of fewer than two characters."""
    return F.pandas_udf(lambda s: s.map(lambda t: _halve(t or "")), T.ArrayType(T.StringType()))


def _pack(text: str, limit: int) -> list[str]:
    out, held = [], ""
    for block in re.split(r"\n\s*\n", text):
        for part in [block[i : i + limit] for i in range(0, len(block), limit)] or [""]:
            if held and len(held) + 2 + len(part) > limit:
                out.append(held)
                held = part
            else:
                held = f"{held}\n\n{part}" if held else part
    return [*out, held]


def paragraph_chunks(limit: int = 50_000) -> Callable[[Column], Column]:
    """Paragraphs packed into chunks of at most limit characters; longer paragraphs are cut."""
    return F.pandas_udf(lambda s: s.map(lambda t: _pack(t or "", limit)), T.ArrayType(T.StringType()))


def truncate_middle(c: Column, limit: int, marker: str = "\n[...]\n") -> Column:
    half = limit // 2
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(half)), F.lit(marker), F.right(c, F.lit(half)))).otherwise(c)


def safe_text(c: Column, limit: int) -> Column:
    flat = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(flat) > limit, F.concat(F.rtrim(F.left(flat, F.lit(limit - 2))), F.lit(" …"))).otherwise(flat)


def human_size(c: Column) -> Column:
    def step(value: Column, units: list[str]) -> Column:
        shown = F.concat(F.format_string("%.1f", F.bround(value, 1)), F.lit(" " + units[0]))
        return shown if len(units) == 1 else F.when(value < 1024, shown).otherwise(step(value / 1024, units[1:]))

    return F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B"))).otherwise(step(c / 1024, ["KB", "MB", "GB", "TB"]))


def slug(c: Column, limit: int = 60) -> Column:
    """Lower-case words joined by hyphens; senza-titolo where nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(fold(c), r"[^\x00-\x7f]", ""), r"[^a-zA-Z0-9]+", "-")
    cut = F.left(F.lower(F.regexp_replace(plain, r"^-+|-+$", "")), F.lit(limit))
    return F.coalesce(F.nullif(F.regexp_replace(cut, r"^-+|-+$", ""), F.lit("")), F.lit("senza-titolo"))


def short_hash(c: Column) -> Column:
    return F.left(F.sha1(c), F.lit(8))


def normalize_url(c: Column) -> Column:
    """Without scheme, leading www., query, fragment and trailing slashes; the host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"[?#].*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/]*", 0)), r"^www\.", "")
    return F.regexp_replace(F.concat(host, F.regexp_extract(bare, r"^[^/]*(.*)$", 1)), r"/+$", "")


def year(c: Column) -> Column:
    """The first year from 1000 to 2099 that is a word by itself; empty if none."""
    return F.regexp_extract(c, r"(?U)\b(1[0-9]{3}|20[0-9]{2})\b", 1)


def year_in(c: Column) -> Column:
    """The first year from 1000 to 2099 that isn't part of a longer number, also behind a letter; empty if none."""
    return F.regexp_extract(c, r"(?<!\d)(1[0-9]{3}|20[0-9]{2})(?!\d)", 1)


def parse_date(c: Column) -> Column:
    """The part before a T or an arrow as y-m-d, d/m/y, d-m-y, y/m/d, d.m.y or y; else the first year from 1800 to 2099
    that is a word in it; null if there is none."""
    head = lambda v: strip(F.regexp_extract(strip(v), r"(?s)\A(.*?)(?:[T\u2192]|\s+->\s+|\z)", 1))
    forms = [
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
        (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
        (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
        (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    ]

    def parsed(h: Column) -> Column:
        tries = [F.when(h.rlike(shape), F.try_to_date(h, fmt)) for shape, fmt in forms]
        whole = F.when(h.rlike(r"^\d{4}$") & (h > "0000"), F.try_to_date(F.concat(h, F.lit("-01-01")), "yyyy-MM-dd"))
        bare = F.regexp_extract(h, r"(?U)\b(1[89]\d{2}|20\d{2})\b", 1)
        return F.coalesce(*tries, whole, F.when(bare != "", F.try_to_date(F.concat(bare, F.lit("-01-01")), "yyyy-MM-dd")))

    def plain(v: Column) -> Column:  # most values are a date and nothing else, which needs no cutting
        iso = F.when(v.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z") & (v >= "0001"), v.try_cast("date"))
        return F.coalesce(iso, F.when(v.rlike(r"\A\d{1,2}/\d{1,2}/\d{4}\z"), F.try_to_date(v, "d/M/yyyy")), bind(head(v), parsed))

    return bind(c, plain)


@lru_cache(maxsize=1)
def _named_references() -> dict[str, str]:
    """HTML's names of characters, as the standard library has them, that a semicolon ends."""
    return {name: char for name, char in html5.items() if name.endswith(";")}


@lru_cache(maxsize=1)
def _old_references() -> dict[str, str]:
    """The names that count without a semicolon too, also as the beginning of a longer word."""
    return {name: char for name, char in html5.items() if not name.endswith(";")}


def _reference(x: Column) -> Column:
    """The character of a reference (&name; or &#number;), or of the longest old name that it begins with, before the
    rest; what names none stays as it is, and numbers of control characters and of no characters are nothing."""
    decimal, hexed = F.regexp_extract(x, r"^&#([0-9]+);?$", 1), F.regexp_extract(x, r"^&#[xX]([0-9a-fA-F]+);?$", 1)
    digits = F.regexp_replace(hexed, "^0+", "")
    code = F.when(decimal != "", decimal.try_cast("bigint")).when(F.length(digits) <= 8, F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("bigint"))
    # numbers from 128 to 159 stand for what Windows-1252 has there
    old = {n: bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
    windows = F.element_at(F.create_map(*[F.lit(v) for n, c in old.items() if c for v in (n, c)]), code.cast("int"))
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    shown = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(code)), 8, "0")), "UTF-32")
    void = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code % 0x10000 >= 0xFFFE)
    shown = F.when(~bad & void, "").otherwise(shown)
    mapped = lambda names, key: F.element_at(F.create_map(*[F.lit(v) for p in names.items() for v in p]), key)
    named = F.when(x.endswith(";"), mapped(_named_references(), F.substring(x, 2, F.length(x))))
    begun = F.regexp_extract(x, "^&(" + "|".join(sorted(_old_references(), key=len, reverse=True)) + ")", 1)
    old_named = F.when(begun != "", F.concat(mapped(_old_references(), begun), F.substring(x, F.length(begun) + 2, F.length(x))))
    return F.when(x.startswith("&#"), F.coalesce(F.when(code.between(0x80, 0x9F), windows), shown)).otherwise(F.coalesce(named, old_named, x))


def unescape(c: Column, closed: bool = False) -> Column:
    """Character references, named and numeric, as their characters; with closed only those that a semicolon ends."""
    pieces = F.regexp_extract_all(c, F.lit(r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)|&|[^&]+"), F.lit(0))
    whole = F.array_join(F.transform(pieces, lambda x: F.when(x.startswith("&") & (x.endswith(";") if closed else F.length(x) > 2), _reference(x)).otherwise(x)), "")
    return F.when(c.contains("&"), whole).otherwise(c)


#: The rest of a tag: quoted values may hold ">"; past 400 attributes a tag ends at the first ">".
_REST = r"[^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"']))[^>=]*+){0,400}+"
#: HTML from left to right: comments, marked sections, scripts and styles with what they hold, tags, declarations, what
#: breaks off at the end, and text.
HTML_TOKEN = "|".join(
    [
        r"(?is)<!--.*?(?:--\s*>|\z)",
        r"<!\[cdata\[.*?(?:\]\s*\]\s*>|\z)",
        rf"<(script|style)(?=[\s/>]){_REST}(?<!/)>.*?(?:</\s*\1\s*>|\z)",
        rf"<[a-z]{_REST}(?:>|\z|=\s*+(?:\"[^\"]*+|'[^']*+)\z)",
        r"<[a-z/!?][^>]*+(?:>|\z)",
        r"<\z",
        r"<",
        r"[^<]+",
    ]
)


def html_to_text(c: Column, closed: bool = False) -> Column:
    """Comments, script and style dropped, tags br, p, div, tr and li a newline, other tags nothing, character references
    their characters, three newlines or more two.  Markup is taken from left to right, so that what looks like markup
    within a comment, a script or a quoted value is none; a script, a comment or a quoted value without an end
    reaches to the end of the text, a tag without one goes, and so does text at the end that an unfinished character reference closes.  With closed
    a reference without its semicolon is text like any other, at the end too."""

    def text(tokens: Column) -> Column:
        def piece(t: Column, i: Column) -> Column:
            cut = (i == F.size(tokens) - 1) & t.rlike(r"&[^\s;&]{0,33}\z")
            data = ~t.startswith("<") | ((t == "<") & (i < F.size(tokens) - 1))
            return F.when(data, unescape(t, True) if closed else F.when(~cut, unescape(t))).when(t.rlike(r"(?i)\A<(br|p|div|tr|li)[\s/>]"), F.lit("\n"))

        return F.array_join(F.transform(tokens, piece), "")

    joined = bind(F.regexp_extract_all(c, F.lit(HTML_TOKEN), F.lit(0)), text)
    return strip(F.regexp_replace(joined, r"\n{3,}", "\n\n"))


#: How a quoted message or a footer begins.
REPLY_MARKERS = (
    r"-{2,}\s*(original message|messaggio originale)",
    r"(on|il giorno)\s.+\s(wrote|ha scritto):?\s*$",
    r"sent with proton mail",
    r"confidentiality notice",
)


def strip_quoted(c: Column) -> Column:
    """The lines before a reply marker, without those that start with > and without blanks at their ends."""
    marker = r"(?i)^(" + "|".join(REPLY_MARKERS) + ")"

    def kept(held: Column) -> Column:
        mark = F.array_position(F.transform(held, lambda x: strip(x).rlike(marker)), True)
        before = F.when(mark > 0, F.slice(held, F.lit(1), (mark - 1).cast("int"))).otherwise(held)
        own = F.filter(before, lambda x: ~strip(x).startswith(">"))
        return F.array_join(F.transform(own, lambda x: F.regexp_replace(x, r"\s+\z", "")), "\n")

    return strip(F.regexp_replace(bind(F.split(c, _LINE_END), kept), r"\n{3,}", "\n\n"))


def is_bulk(list_unsubscribe: Column, precedence: Column) -> Column:
    """Whether a message's headers say that it went to many."""
    many = F.lower(F.coalesce(precedence, F.lit(""))).isin("bulk", "list", "junk")
    return (F.coalesce(list_unsubscribe, F.lit("")) != "") | many


def clean_layout(c: Column) -> Column:
    """Form feeds as blank lines, runs of four spaces or more as three, no blanks at line ends, at most one blank line."""
    each = F.transform(F.split(F.replace(c, F.lit("\f"), F.lit("\n\n")), _LINE_END), lambda x: F.regexp_replace(F.regexp_replace(x, r"\s+\z", ""), r" {4,}", "   "))
    return strip(F.regexp_replace(F.array_join(each, "\n"), r"\n{3,}", "\n\n"))


#: Whose values are kept out of records, and the longest field of one.
SECRET = r"(?i)(password|passwd|token|secret|authorization)(\s*[=:]\s*)([^\s]+)"
MAX_FIELD = 4096


def redact(c: Column, limit: int | None = MAX_FIELD) -> Column:
    """Values after password, token, authorization and the like replaced; at most limit characters."""
    out = F.regexp_replace(c, SECRET, "$1$2[REDACTED]")
    return out if limit is None else F.left(out, F.lit(limit))


#: What must not be in a file that is kept under version control.
SENSITIVE = {
    "personal_absolute_path": r"(?:^|[\s'\"=`])(?:/Users/[^/\s]+|/home/[^/\s]+)(?:/|\b)",
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "credential_assignment": r"(?i)\b(?:password|passwd|token|secret|authorization)\s*[:=]\s*['\"]?[A-Za-z0-9_./+\-=]{8,}",
    "api_key": r"\bsk-[A-Za-z0-9_-]{20,}\b",
}


def sensitive_findings(c: Column) -> Column:
    """Names of the patterns a text holds, in their order."""
    return F.filter(F.array(*[F.when(c.rlike("(?U)" + p), F.lit(n)) for n, p in SENSITIVE.items()]), lambda x: x.isNotNull())


def split_multi(c: Column, delimiters: str = r"[,;•|/]") -> Column:
    return F.filter(F.transform(F.split(c, delimiters), strip), lambda x: x != "")


def as_list(c: Column) -> Column:
    """A JSON array of strings as it is, else what commas separate."""
    parsed = F.from_json(c, "array<string>")
    return F.when(F.trim(c).startswith("["), F.coalesce(parsed, F.array().cast("array<string>"))).otherwise(split_multi(F.coalesce(c, F.lit("")), ","))


#: The header keys that are generated; others are kept as they stand.
HEADER_KEYS = ("title", "type", "tags", "date", "source_kind", "source_hash")


def split_frontmatter(c: Column) -> Column:
    """known (generated key -> value without quotes), other (the remaining header lines) and body of a text that starts
    with a --- block; a text without one is all body."""
    key = r"^(" + "|".join(HEADER_KEYS) + r"):\s*(.*)$"

    def parts(end: Column) -> Column:
        has = c.startswith("---\n") & (end > 0)
        block = F.when(has, F.split(F.substring(c, F.lit(5), F.greatest(end - 5, F.lit(0))), "\n")).otherwise(F.array().cast("array<string>"))
        pairs = F.transform(F.filter(block, lambda x: x.rlike(key)), lambda x: F.struct(F.regexp_extract(x, key, 1).alias("k"), F.regexp_replace(F.trim(F.regexp_extract(x, key, 2)), r"^[\"']+|[\"']+$", "").alias("v")))
        last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda y: y["k"] == x["k"]))
        body = F.when(has, F.regexp_replace(F.substring(c, end + 4, F.length(c)), r"\A\n+", "")).otherwise(c)
        return F.struct(F.map_from_entries(last).alias("known"), F.filter(block, lambda x: ~x.rlike(key)).alias("other"), body.alias("body"))

    return bind(F.locate("\n---", c, 5), parts)


def quoted(c: Column) -> Column:
    """A JSON string."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)\A\{\"v\":(.*)\}\z", 1)


def render_frontmatter(fields: dict[str, Column], other: Column) -> Column:
    """A header block of fields (strings or arrays of strings, in this order) and other lines."""
    rows = [F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()]
    return F.array_join(F.concat(F.array(F.lit("---"), *rows), other, F.array(F.lit("---"))), "\n")


def quoted_list(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(c, quoted), ", "), F.lit("]"))


def marker_at(c: Column, phrase: str) -> Column:
    """Where (from 0) the phrase first stands, its words apart by any white space; -1 if nowhere."""
    pattern = r"\s+".join(re.escape(w) for w in phrase.lower().split())
    return F.regexp_instr(F.lower(c), F.lit(pattern)) - 1


def near_top(c: Column, phrase: str, within: int) -> Column:
    return marker_at(c, phrase).between(0, within)


#: Phrases that set a deadline relative to the day.
DEADLINES = (
    r"entro\s+la\s+fine\s+del\s+mese",
    r"entro\s+la\s+fine\s+dell.anno",
    r"entro\s+la\s+fine\s+della\s+settimana",
    r"entro\s+il\s+(\d+\s+del\s+)?(mese|trimestre|anno)\s+prossimo",
    r"entro\s+\d+\s+giorni",
    r"entro\s+\d+\s+settiman[ae]",
    r"entro\s+breve",
    r"quanto\s+prima",
)
DEADLINE = "(?i)" + "|".join(DEADLINES)


def deadline_present(c: Column, p: Column, threshold: float = 0.5) -> Column:
    return (p >= threshold) | c.rlike(DEADLINE)


def deadline_excerpt(c: Column, around: int = 80, most: int = 300) -> Column:
    """A deadline phrase with up to around characters on both sides; without one the first characters."""

    def cut(at: Column) -> Column:
        start = F.greatest(at - around, F.lit(1))
        return F.substring(c, start, at - start + F.length(F.regexp_extract(c, DEADLINE, 0)) + around)

    at = F.regexp_instr(c, F.lit(DEADLINE))
    return strip(bind(at, lambda a: F.when(a > 0, cut(a)).otherwise(F.left(c, F.lit(most)))))


def risk_level(high: Column, medium: Column, low: Column, threshold: float = 0.5) -> Column:
    """The first of three levels whose probability reaches the threshold."""
    return F.when(high >= threshold, "alto").when(medium >= threshold, "medio").when(low >= threshold, "basso").otherwise("nessuno")


def headings(c: Column, most: int = 8) -> Column:
    found = F.filter(lines(c), lambda x: x.rlike(r"^#{1,6}\s+\S"))
    return F.slice(F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"^#{1,6}\s+", ""))), 1, most)


def key_lines(c: Column, words: list[str], longest: int = 220, most: int = 12) -> Column:
    pattern = "(?i)" + "|".join(map(re.escape, words))
    return F.slice(F.filter(lines(c), lambda x: (F.length(x) <= longest) & x.rlike(pattern)), 1, most)


def key_numbers(c: Column, patterns: list[str], most: int = 20) -> Column:
    return F.slice(F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in patterns]))), 1, most)


def name_form(title: Column) -> Column:
    """A name's words in order of the alphabet, "Last, First" turned round, single letters dropped."""
    turned = F.when(title.contains(","), F.concat_ws(" ", F.trim(F.regexp_replace(title, r"^[^,]*,", "")), F.substring_index(title, ",", 1))).otherwise(title)
    return F.array_join(F.array_sort(F.filter(F.split(norm(turned), " "), lambda w: F.length(w) > 1)), " ")


def oid_ok(c: Column) -> Column:
    return c.rlike(r"^[A-Z]{3}-[0-9]{6}$") & ~c.endswith("-000000")


OID_TYPES = {"COR": "Core", "PER": "Person", "PLG": "Plugin", "RES": "Resource", "SRV": "Service", "SYS": "System"}


def oid_type(c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for p in OID_TYPES.items() for x in p]), F.left(c, F.lit(3)))


def path_ok(c: Column) -> Column:
    """POSIX, relative, no empty, . or .. component, no backslash."""
    return ~c.startswith("/") & ~c.contains("\\") & ~c.rlike(r"(^|/)(\.{1,2})?(/|$)") & (c != "")


def content_hash(*columns: Column) -> Column:
    """sha256 of the values apart by U+001F, null as empty."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)


def length_prefixed(*columns: Column) -> Column:
    """sha256 of the values, each after its length in bytes and a colon, so that no two rows of values read alike."""
    each = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat(*[x for v in each for x in (F.octet_length(v).cast("string"), F.lit(":"), v)]), 256)


def canonical_name(c: Column) -> Column:
    """The last word in capitals, then the others, with underscores."""
    w = F.split(F.trim(c), r"\s+")
    rest = F.transform(F.slice(w, F.lit(1), F.size(w) - 1), F.initcap)
    return F.array_join(F.concat(F.array(F.upper(F.element_at(w, -1))), rest), "_")


def pipe_row(*columns: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
