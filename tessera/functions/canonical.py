"""Canonical JSON as an expression: keys in order at every depth, no spaces, numbers as Python writes them.

A VARIANT holds the fields of each object in order of their names, so parsing a text and writing it again sorts it at
every depth.  Numbers with a fraction or an exponent would lose their form on the way, so they travel as marked strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import bind

#: A JSON text's strings, white space, numbers and the rest.
_TOKEN = r'"(?:[^"\\]|\\.)*+"|[ \t\r\n]+|-?[0-9][0-9.eE+\-]*|[^"0-9 \t\r\n\-]+|-'
_MARK = "\\u0001"


def python_float(c: Column) -> Column:
    """A double as Python's repr writes it: shortest digits, an exponent from 1e16 on and below 1e-4."""
    shown = c.cast("string")  # 12.5, 1.25E10 or 1.0E-5
    digits = F.regexp_replace(F.regexp_extract(shown, r"^-?([0-9.]+)", 1), r"\.0$", "")
    power = F.regexp_extract(shown, r"E(-?[0-9]+)$", 1)
    exponent = F.concat(digits, F.lit("e"), F.when(power.startswith("-"), "-").otherwise("+"), F.lpad(F.regexp_replace(power, "-", ""), F.greatest(F.lit(2), F.length(F.regexp_replace(power, "-", ""))), F.lit("0")))
    plain = F.regexp_replace(F.abs(shown.try_cast("decimal(38,21)")).cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.abs(c)
    body = F.when(size == 0, "0.0").when((size >= 1e16) | (size < 1e-4), exponent).otherwise(plain)
    return F.concat(F.when(shown.startswith("-"), "-").otherwise(""), body)


def _number(token: Column) -> Column:
    """A number with a fraction or an exponent, or too long for 64 bits, as a marked string."""
    whole = token.rlike(r"^-?[0-9]{1,18}$")
    long_ = token.rlike(r"^-?[0-9]+$")
    shown = F.when(long_, token).otherwise(python_float(token.try_cast("double")))
    return F.when(whole, F.when(token == "-0", "0").otherwise(token)).otherwise(F.concat(F.lit('"' + _MARK), shown, F.lit('"')))


def _marked(text: Column) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(r"^-?[0-9]"), _number(t)).otherwise(t)), "")


def _finished(shown: Column) -> Column:
    """Marked numbers as they are, and the letters of escaped control characters in lower case."""

    def lowered(out: Column) -> Column:
        odd = out
        for letter in "ABCDEF":
            odd = F.regexp_replace(odd, rf"(?<!\\)((?:\\\\)*)\\u00([01]){letter}", rf"$1\\u00$2{letter.lower()}")
        return F.when(out.rlike(r"\\u00[01][A-F]"), odd).otherwise(out)

    return bind(F.regexp_replace(shown, r'"\\u0001([0-9.e+\-]*)"', "$1"), lowered)


def _whole(marked: Column) -> Column:
    """Whether a text is one JSON value and nothing after it (which the parser doesn't look at)."""

    def one(alone: Column) -> Column:
        return F.try_variant_get(alone, "$[0]", "variant").isNotNull() & F.try_variant_get(alone, "$[1]", "variant").isNull()

    return bind(F.try_parse_json(F.concat(F.lit("["), marked, F.lit("]"))), one)


def canonical(text: Column) -> Column:
    """A JSON text with keys in order at every depth and without spaces, as Python's json.dumps(..., sort_keys=True,
    separators=(",", ":"), ensure_ascii=False) writes it; null where it isn't JSON or names a key twice."""
    return bind(_marked(text), lambda marked: F.when(_whole(marked), _finished(F.to_json(F.try_parse_json(marked)))))


def canonical_without(text: Column, key: str) -> Column:
    """The same of a JSON object without one of its own keys.  Every text is taken apart once, not once a key."""

    def shown(kept: Column) -> Column:
        each = F.transform(F.array_sort(F.map_keys(kept)), lambda k: F.concat(_quoted(k), F.lit(":"), F.to_json(F.element_at(kept, k))))
        return _finished(F.concat(F.lit("{"), F.array_join(each, ","), F.lit("}")))

    def whole(marked: Column) -> Column:
        fields = F.from_json(marked, "map<string,variant>")
        return F.when(_whole(marked), bind(F.map_filter(fields, lambda k, v: k != key), lambda kept: F.when(kept.isNotNull(), shown(kept))))

    return bind(_marked(text), whole)


def _quoted(c: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)\A\{\"v\":(.*)\}\z", 1)


def ascii_escaped(text: Column) -> Column:
    """JSON with every character beyond ASCII escaped, as json.dumps does unless told otherwise."""
    units = F.regexp_extract_all(text, F.lit(r"(?s)[\x00-\x7f]+|[^\x00-\x7f]"), F.lit(0))

    def escaped(x: Column) -> Column:
        utf16 = F.lower(F.hex(F.encode(x, "UTF-16BE")))
        pair = F.when(F.length(utf16) == 8, F.concat(F.lit("\\u"), F.left(utf16, F.lit(4)), F.lit("\\u"), F.right(utf16, F.lit(4))))
        return F.when(x.rlike(r"^[\x00-\x7f]"), x).otherwise(F.coalesce(pair, F.concat(F.lit("\\u"), utf16)))

    return F.when(text.rlike(r"[^\x00-\x7f]"), F.array_join(F.transform(units, escaped), "")).otherwise(text)
