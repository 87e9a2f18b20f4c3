"""Parsing and encoding of JSON messages."""

from __future__ import annotations

import math

from roadstats.schemas import EVENT_COLUMNS, EVENT_SCHEMA
from roadstats.sources.codec import encode_events, parse_events
from tests.conftest import ev


def _parse(spark, payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    return parse_events(df).collect()


def test_schema_fields_in_order():
    assert list(EVENT_COLUMNS) == ["name", "dn", "orig", "dest", "t", "link", "x", "s", "v"]
    assert [f.dataType.simpleString() for f in EVENT_SCHEMA.fields] == [
        "string", "int", "string", "string", "double", "string", "double", "double", "double"
    ]


def test_full_record_round_trip(spark, events_df):
    rows = [ev(12.5, "I2I1", 33.3, name="v7", dn=5, orig="I2", dest="W1", x=40.0, s=12.0), ev(13, "trip_end", name="v8")]
    df = events_df(rows)
    back = parse_events(encode_events(df)).collect()
    assert [tuple(r) for r in back] == rows
    assert back[1].v == -1.0


def test_binary_payload(spark):
    df = spark.createDataFrame([(bytearray(b'{"name":"a","t":1.0,"link":"L","v":2.5}'),)], "value binary")
    r = parse_events(df).first()
    assert (r.name, r.t, r.link, r.v, r.dn) == ("a", 1.0, "L", 2.5, None)


def test_malformed_payloads_become_all_null_rows(spark):
    rows = _parse(spark, ["not json", "", "null", "[]", '[{"name":"a"},{"name":"b"}]'])
    assert len(rows) == 5
    assert all(all(v is None for v in r) for r in rows)


def test_one_bad_field_only_nulls_that_field(spark):
    t_str, dn_frac, v_str, v_nan, name_num, extra = _parse(
        spark,
        [
            '{"name":"a","t":"abc","link":"L"}',
            '{"name":"a","dn":5.0,"link":"L"}',
            '{"name":"a","v":"3.5","link":"L"}',
            '{"name":"a","v":NaN,"link":"L"}',
            '{"name":7,"link":"L"}',
            '{"name":"a","link":"L","unknown":1}',
        ],
    )
    assert t_str.t is None and t_str.name == "a" and t_str.link == "L"
    assert dn_frac.dn is None and dn_frac.link == "L"
    assert v_str.v is None
    assert math.isnan(v_nan.v)
    assert name_num.name == "7"
    assert extra.name == "a" and extra.link == "L"


def test_null_fields_survive_round_trip(events_df):
    df = events_df([(None, None, None, None, None, None, None, None, None), ev(1, "L", 3.0)])
    assert sorted(map(tuple, parse_events(encode_events(df)).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_special_doubles_round_trip(events_df):
    inf = float("inf")
    df = events_df([ev(1, "L", float("nan")), ev(2, "L", inf), ev(3, "L", -inf)])
    back = {r.t: r.v for r in parse_events(encode_events(df)).collect()}
    assert math.isnan(back[1.0]) and back[2.0] == inf and back[3.0] == -inf
