"""Typed page properties against plain Python that reads and writes the same values."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import properties as P
from tessera.operators import inventory as V
from tessera.sources import page_properties

TEXT = st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=12)


def joined(parts):
    return "".join(p.get("plain_text") or (p.get("text") or {}).get("content") or "" for p in parts or [])


def read(prop):
    """What a property holds."""
    kind = prop.get("type")
    held = prop.get(kind)
    match kind:
        case "title" | "rich_text":
            return joined(held)
        case "select" | "status":
            return held["name"] if held else ""
        case "multi_select":
            return [x.get("name", "") for x in held or []]
        case "relation":
            return [x["id"] for x in held or [] if x.get("id")]
        case "date":
            return held or {}
        case "formula":
            return read(held) if held else None
    return held


def decoded(spark, props):
    rows = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(props)], "i int, p string")
    got = {r["i"]: r["v"] for r in rows.select("i", F.to_json(P.decoded(F.col("p"))).alias("v")).collect()}
    return [None if got[i] is None else json.loads(got[i]) for i in range(len(props))]


PART = st.one_of(st.fixed_dictionaries({"plain_text": TEXT}), st.fixed_dictionaries({"text": st.fixed_dictionaries({"content": TEXT})}), st.fixed_dictionaries({"plain_text": TEXT, "text": st.fixed_dictionaries({"content": TEXT})}), st.just({}))
NAMED = st.fixed_dictionaries({"name": TEXT, "color": st.just("red")})
HELD = {
    "title": st.one_of(st.none(), st.lists(PART, max_size=3)),
    "rich_text": st.lists(PART, max_size=3),
    "select": st.one_of(st.none(), NAMED),
    "status": st.one_of(st.none(), NAMED),
    "multi_select": st.one_of(st.none(), st.lists(st.one_of(NAMED, st.just({})), max_size=3)),
    "relation": st.one_of(st.none(), st.lists(st.one_of(st.fixed_dictionaries({"id": TEXT}), st.just({})), max_size=3)),
    "date": st.one_of(st.none(), st.fixed_dictionaries({"start": TEXT, "end": st.one_of(st.none(), TEXT)})),
    "number": st.one_of(st.none(), st.integers(-(2**53), 2**53), st.decimals(-1000, 1000, places=2).map(float)),
    "checkbox": st.booleans(),
    "url": st.one_of(st.none(), TEXT),
    "email": TEXT,
    "people": st.lists(st.fixed_dictionaries({"id": TEXT, "name": TEXT}), max_size=2),
    "created_time": TEXT,
}
PLAIN = st.sampled_from(sorted(HELD)).flatmap(lambda k: HELD[k].map(lambda v: {"id": "x", "type": k, k: v}))
PROPERTY = st.one_of(PLAIN, st.one_of(st.none(), PLAIN).map(lambda p: {"type": "formula", "formula": p}))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PROPERTY, min_size=40, max_size=80))
def test_every_type_reads_as_in_plain_python(spark, props):
    assert decoded(spark, props) == [read(p) for p in props]


def test_what_is_no_property_is_null(spark):
    rows = spark.createDataFrame([("bad",), (None,), ("[]",), ("{}",), ('{"type":"a.b","a":{"b":1}}',), ('{"type":"title","title":7}',)], "p string")
    assert [r["v"] for r in rows.select(F.to_json(P.decoded(F.col("p"))).alias("v")).collect()] == [None] * 5 + ['""']


@pytest.mark.parametrize(
    ("kind", "value", "want"),
    [
        ("title", "a\"b\\c\n", {"title": [{"type": "text", "text": {"content": "a\"b\\c\n"}}]}), ("title", None, {"title": [{"type": "text", "text": {"content": "None"}}]}),
        ("rich_text", "", {"rich_text": [{"type": "text", "text": {"content": ""}}]}), ("number", " 12 ", {"number": 12.0}), ("number", "", {"number": None}), ("number", None, {"number": None}), ("number", "1e3", {"number": 1000.0}),
        ("select", "x", {"select": {"name": "x"}}), ("select", "", {"select": None}), ("multi_select", "a, b;c|d/e• ,", {"multi_select": [{"name": x} for x in "abcde"]}), ("multi_select", "", {"multi_select": []}),
        ("date", "2024-01-02", {"date": {"start": "2024-01-02"}}), ("date", None, {"date": None}), ("url", "", {"url": None}), ("url", "http://a/b", {"url": "http://a/b"}),
        ("checkbox", " SÌ\t", {"checkbox": True}), ("checkbox", "1", {"checkbox": True}), ("checkbox", "on", {"checkbox": False}), ("checkbox", None, {"checkbox": False}),
    ],
)
def test_what_writes_a_value(spark, kind, value, want):
    got = spark.createDataFrame([(kind, value)], "k string, v string").select(P.payload(F.col("k"), F.col("v"))).first()[0]
    assert json.loads(got) == want


def test_values_that_fit_no_type_are_skipped_and_the_last_operation_holds(spark):
    ops = spark.createDataFrame(
        [("p", "t", "ADD", "old", 1), ("p", "t", "UPDATE", "new", 2), ("p", "n", "ADD", "many", 3), ("p", "n\"]", "ADD", "4", 4), ("p", "f", "ADD", "x", 5), ("p", "q", "ADD", "x", 6), ("p", "t", "CONFLICT", "never", 7)],
        "page_id string, property string, action string, value string, ord int",
    )
    schema = spark.createDataFrame([("t", "title"), ("n", "number"), ("n\"]", "number"), ("f", "people")], "property string, type string")
    made = V.property_payload(ops, schema)
    assert sorted(r["skipped"] for r in made.filter("skipped IS NOT NULL").collect()) == ["INVALID_VALUE:number", "UNSUPPORTED_NOTION_TYPE:None", "UNSUPPORTED_NOTION_TYPE:people"]
    got = json.loads(V.page_payloads(made, "ord").first()["properties"])
    assert got == {"t": {"title": [{"type": "text", "text": {"content": "new"}}]}, "n\"]": {"number": 4.0}}


def test_properties_of_pages(spark):
    page = json.dumps({"Name": {"type": "title", "title": [{"plain_text": "x"}]}, "Of": {"type": "relation", "relation": [{"id": "r"}]}, "N": {"type": "number", "number": None}})
    got = {r["property"]: (r["type"], r["value"]) for r in page_properties(spark.createDataFrame([("p", page), ("q", None)], "page_id string, properties string")).collect()}
    assert got == {"Name": ("title", '"x"'), "Of": ("relation", '["r"]'), "N": ("number", None)}
