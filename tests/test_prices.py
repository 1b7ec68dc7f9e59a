"""Price documents: units, completeness, quarantine."""

import pytest
from pyspark.sql import functions as F

from hourmart.sources import price_documents as pd_
from hourmart.sources.documents import quarantine
from tests.helpers import plan_of, rows, ts

KEYS = ["doc"]
BASE = 1787529600  # 2026-08-24 00:00 UTC


def xml(*periods):
    body = "".join(
        f"<TimeSeries><Period><timeInterval><start>{start}</start></timeInterval>"
        f"<resolution>{res}</resolution>"
        + "".join(
            f"<Point><position>{p}</position>" + (f"<price.amount>{v}</price.amount>" if v is not None else "") + "</Point>"
            for p, v in points
        )
        + "</Period></TimeSeries>"
        for start, res, points in periods
    )
    text = f'<?xml version="1.0"?><Doc xmlns="urn:x:y:7:3"><mRID>1</mRID>{body}</Doc>'
    return text


@pytest.fixture
def xml_hours(spark):
    def run(*periods):
        docs = spark.createDataFrame([("a", xml(*periods))], "doc string, content string")
        parsed = pd_.parse_xml(docs, "content", KEYS)
        out = pd_.hours_from_units(pd_.xml_points(parsed, KEYS), KEYS)
        return rows(out, "hour_utc", "price_eur_mwh")

    return run


@pytest.fixture
def json_hours(spark):
    def run(*points):
        payload = {"unix_seconds": [s for s, _ in points], "price": [p for _, p in points]}
        import json

        docs = spark.createDataFrame([("a", json.dumps(payload))], "doc string, content string")
        parsed = pd_.parse_json(docs, "content", KEYS)
        out = pd_.hours_from_points(pd_.json_points(parsed, KEYS), KEYS)
        return rows(out, "hour_utc", "price_eur_mwh")

    return run


def quarters(hour, values):
    return [(BASE + hour * 3600 + i * 900, v) for i, v in enumerate(values)]


def test_hourly_document(xml_hours):
    got = xml_hours(("2026-08-24T00:00Z", "PT60M", [(1, 52.31), (2, 48.75), (3, -12.40)]))
    assert got == [
        (ts("2026-08-24 00:00"), 52.31),
        (ts("2026-08-24 01:00"), 48.75),
        (ts("2026-08-24 02:00"), -12.40),
    ]


def test_quarters_average_to_their_hour(xml_hours):
    points = [(1, 70.0), (2, 71.25), (3, 69.5), (4, 73.1)]
    [(hour, price)] = xml_hours(("2026-08-24T22:00Z", "PT15M", points))
    assert hour == ts("2026-08-24 22:00")
    assert price == pytest.approx(70.9625)


def test_hour_with_a_missing_quarter_is_dropped(xml_hours):
    points = [(p, 10.0 * p) for p in (1, 2, 3, 4, 5, 7, 8)]
    assert xml_hours(("2026-08-24T22:00Z", "PT15M", points)) == [(ts("2026-08-24 22:00"), 25.0)]


def test_point_without_price_and_mixed_units(xml_hours):
    missing = ("2026-08-24T00:00Z", "PT15M", [(1, 1.0), (2, None), (3, 1.0), (4, 1.0)])
    assert xml_hours(missing) == []
    mixed = ("2026-08-24T00:00Z", "PT15M", quarter_points()), ("2026-08-24T00:00Z", "PT60M", [(1, 5.0)])
    assert xml_hours(*mixed) == []


def quarter_points():
    return [(1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0)]


def test_broken_document_is_set_aside(spark):
    good_text = xml(("2026-08-24T00:00Z", "PT60M", [(1, 1.0)]))
    docs = spark.createDataFrame([("good", good_text), ("bad", good_text[:-6])], "doc string, content string")
    parsed = pd_.parse_xml(docs, "content", KEYS)
    good, bad = quarantine(parsed)
    assert rows(good, "doc") == [("good",)]
    assert rows(bad, "doc") == [("bad",)]
    assert rows(pd_.xml_points(parsed, KEYS), "doc", "price_eur_mwh") == [("good", 1.0)]


def test_documents_are_parsed_once(spark):
    docs = spark.createDataFrame([("a", "x")], "doc string, content string")
    xml_plan = plan_of(pd_.xml_points(pd_.parse_xml(docs, "content", KEYS), KEYS))
    json_plan = plan_of(pd_.json_points(pd_.parse_json(docs, "content", KEYS), KEYS))
    assert xml_plan.count("from_xml(") == 1
    assert json_plan.count("from_json(") == 1


def test_four_quarters(json_hours):
    assert json_hours(*quarters(0, [10, 20, 30, 40])) == [(ts("2026-08-24 00:00"), 25.0)]


@pytest.mark.parametrize("gone", [0, 1, 3])
def test_partial_quarter_hours_are_dropped(json_hours, gone):
    second = quarters(1, [1, 2, 3, 4])
    del second[gone]
    assert json_hours(*quarters(0, [10, 20, 30, 40]), *second) == [(ts("2026-08-24 00:00"), 25.0)]


def test_lone_points_stay_among_lone_points(json_hours):
    got = json_hours((BASE, 5.0), (BASE + 3600, 6.0), (BASE + 7200, None), (BASE + 10800, 7.0))
    assert [p for _, p in got] == [5.0, 6.0, 7.0]


def test_lone_point_next_to_a_quarter_hour_is_dropped(json_hours):
    got = json_hours((BASE - 3600, 1.0), *quarters(0, [10, 20, 30, 40]), (BASE + 2 * 3600, 9.0), (BASE + 3 * 3600, 8.0))
    assert got == [(ts("2026-08-24 00:00"), 25.0), (ts("2026-08-24 03:00"), 8.0)]


def test_lone_points_across_chunks(json_hours):
    """Neighbours are found across the calendar chunks of the window."""
    far = 40 * 86400
    assert json_hours(*quarters(0, [1, 1, 1, 1]), (BASE + far, 9.0)) == [(ts("2026-08-24 00:00"), 1.0)]


def test_empty_and_uneven_arrays(spark, json_hours):
    assert json_hours() == []
    docs = spark.createDataFrame(
        [("a", f'{{"unix_seconds": [{BASE}, {BASE + 3600}], "price": [4.5]}}')], "doc string, content string"
    )
    points = pd_.json_points(pd_.parse_json(docs, "content", KEYS), KEYS)
    assert rows(points, "price_eur_mwh") == [(4.5,)]


def test_zone_translation(frame):
    df = frame("code string", ("10YNL----------L",), ("DE-LU",))
    assert [r[0] for r in df.select(pd_.translate_zone(F.col("code"))).collect()] == ["NL", "DE-LU"]
