from __future__ import annotations

import pytest

from quillview.config import ConfigError, Tag, TagSyntaxError, build_config, parse_tags
from quillview.plans import demo

PAIR = [Tag("tag", ("value",)), Tag("tag2", ("VALUE2",))]


@pytest.mark.parametrize(
    ("comment", "tags"),
    [
        ("", []),
        (None, []),
        ('tag:"value"', PAIR[:1]),
        ('tag:"value" tag2:"VALUE2"', PAIR),
        ('tag:"value"tag2:"VALUE2"', PAIR),
        ('tag:"val1"tag:"val2" tag:"val3"', [Tag("tag", (f"val{k}",)) for k in (1, 2, 3)]),
        ('tag:"value" tag2:"VALUE2"    for people', PAIR),
        ('tag:"value"tag2:"VALUE2"#for people', PAIR),
        ('tag:"value"tag2:"VALUE2"#tag3:"value3"', PAIR),
        ('index:"-"', [Tag("index", ("-",))]),
        ('index:",id"', [Tag("index", ("", "id"))]),
        ('a:"x\\"y"', [Tag("a", ('x"y',))]),
        ('a:" x , y "', [Tag("a", (" x ", " y "))]),
    ],
)
def test_tags(comment, tags):
    assert parse_tags(comment) == tags


@pytest.mark.parametrize("comment", ["a plain sentence", 'tag:"value"   three spaces', 'tag:"open', 'tag:"a"\ttag:"b"'])
def test_no_tags(comment):
    with pytest.raises(TagSyntaxError):
        parse_tags(comment)


def test_demo_config():
    c = demo.config()
    assert [t.name for t in c.ordered()] == ["customer", "orders", "lineitem"]
    orders, items = c.table("orders"), c.table("lineitem")
    assert (orders.pk, orders.prefix_id, orders.routing, orders.doc_type) == ("o_orderkey", True, "o_custkey", "order")
    assert orders.needed_columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    assert not items.indexed and items.inlined_in == orders.inlines and items.inlined_in[0].pk == "l_item"
    assert c.index_name("public") == "shop" and c.index_name("x") == "shop_x"


@pytest.mark.parametrize(
    "tables",
    [
        {"a": ("", {"x": 'inline:"nowhere,pk"'}, ())},
        {"a": ('inline:"i"', {"x": ""}, ()), "b": ("", {"y": 'inline:"i,pk"'}, ())},
        {"a": ('inline:"i"', {"x": ""}, ()), "b": ("", {"y": 'inline:"i,parent"'}, ()), "c": ("", {"z": 'inline:"i,parent"'}, ())},
        {"a": ("", {"x": 'join:"sideways"'}, ())},
        {"a": ("", {"x": 'index:"f,primary"'}, ())},
    ],
)
def test_config_errors(tables):
    with pytest.raises(ConfigError):
        build_config("db", demo.catalog_rows(tables))


def test_composite_key_needs_a_choice():
    rows = demo.catalog_rows({"a": ("", {"x": "", "y": ""}, ())})
    for r in rows:
        r["pk"] = True
    with pytest.raises(ConfigError):
        build_config("db", rows)


def test_sources_after_parents_in_chains():
    tables = {
        "a": ('inline:"ca"', {"id": 'index:",id" inline:"ba,pk"', "up": 'inline:"ba,parent"'}, ()),
        "b": ('inline:"ba"', {"id": 'index:",id"'}, ()),
        "c": ("", {"id": 'index:",id" inline:"ca,pk"', "up": 'inline:"ca,parent"'}, ()),
    }
    assert [t.name for t in build_config("db", demo.catalog_rows(tables)).ordered()] == ["b", "a", "c"]
