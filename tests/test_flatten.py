from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import flatten


def documents(spark, *found):
    rows = [("file", 7, json.dumps(d)) for d in found]
    return spark.createDataFrame(rows, "path string, round int, j string").select("path", "round", F.parse_json("j").alias("document"))


def records(df):
    return [json.loads(r[0]) for r in df.select(F.to_json("record")).collect()]


@pytest.mark.parametrize("flat", [flatten.fixture_stats, flatten.live_elements, flatten.season_events])
def test_an_entry_is_taken_at_once(spark, monkeypatch, flat):
    """Nested lists aren't copied level by level: what is taken of a document says all that is needed of an entry."""
    asked, get = [], F.try_variant_get
    monkeypatch.setattr(F, "try_variant_get", lambda value, path, kind: asked.append(kind) or get(value, path, kind))
    flat(documents(spark, []))
    assert asked[0] != "array<variant>"


def test_odd_fixtures(spark):
    entry = {"element": 1, "value": 2}
    stats = [
        {"identifier": "a", "h": [entry, "odd", {"value": None}, {}], "a": "odd"}, "odd", {"h": [entry]}, {"identifier": None, "a": [entry | {"more": 1}]},
    ]
    found = documents(spark, [{"id": 5, "stats": stats}, {"id": None, "stats": stats}, {"stats": stats}, {"id": 6, "stats": {}}, {"id": 7}, "odd", None], {"id": 8, "stats": stats})
    h, a = {"fixture_id": 5, "side": "h"}, {"fixture_id": 5, "side": "a"}
    assert records(flatten.fixture_stats(found)) == [
        h | {"identifier": "a"} | entry, h | {"identifier": "a"}, h | {"identifier": "a", "value": None}, h | {"identifier": "a"},
        h | {"identifier": ""} | entry, a | {"identifier": None} | entry,
    ]


def test_odd_elements_and_events(spark):
    elements = [{"id": 1, "stats": {"minutes": 3, "id": 4}}, "odd", {"id": None, "stats": {}}, {"id": 2, "stats": [1]}, {"id": {"x": 1}}]
    assert records(flatten.live_elements(documents(spark, {"elements": elements}, {"elements": "odd"}, []))) == [
        {"element_id": 1, "round": 7, "minutes": 3, "id": 4}, {"element_id": 2, "round": 7}, {"element_id": {"x": 1}, "round": 7},
    ]
    events = [{"id": 1, "top_element_info": {"points": 3}, "chip_plays": [{"n": 1}]}, "odd", None, {"id": 2, "top_element_points": 9, "chip_plays": []}]
    got = records(flatten.season_events(documents(spark, {"events": events})))
    assert [(r["id"], r["top_element_points"], r["chip_plays_json"]) for r in got] == [(1, 3, '[{"n":1}]'), (2, None, None)]
