"""Decoding and refusing records; the accepted-event log."""

import json

from clickweave.schemas import RECORD
from clickweave.sources import changelog, records
from clickweave.sources.scenario import at, scenario
from pyspark.sql import functions as F


def decode(spark, *values, topic="ad_clicks"):
    rows = [(topic, 0, n, value if isinstance(value, (str, type(None))) else json.dumps(value))
            for n, value in enumerate(values)]
    return records.decode(spark.createDataFrame(rows, RECORD))


def payload(**changes):
    click = {"user_id": "u", "event_time": "2024-01-01T12:00:00", "campaign_id": "camp", "click_id": "c"}
    return {name: value for name, value in {**click, **changes}.items() if value is not ...}


def test_good_records(spark):
    spellings = ["2024-01-01T12:00:00", "2024-01-01T12:00:00Z", "2024-01-01T12:00:00.000Z",
                 "2024-01-01T12:00:00.000000", "2024-01-01T14:00:00+02:00"]
    decoded = decode(spark, *(payload(event_time=text) for text in spellings), payload(extra=[1, 2]))
    good = records.good(decoded).collect()
    assert len(good) == 6
    assert {row.event_time for row in good} == {at("12:00:00")}
    assert {(row.is_view, row.user_id, row.id, row.label) for row in good} == {(False, "u", "c", "camp")}
    assert records.quarantined(decoded).count() == 0


def test_refused_records(spark):
    decoded = decode(
        spark, payload(user_id=None), payload(click_id=...), payload(event_time="noon"), '{"user_id": "u', "[]", None, "",
        payload(user_id=None, campaign_id=None))
    reasons = [row.reason for row in records.quarantined(decoded).orderBy("offset").collect()]
    assert reasons[:3] == ["missing user_id", "missing id", "missing event_time"]
    assert reasons[3] == "malformed" and len(reasons) == 8
    assert reasons[7] == "missing user_id,label"
    assert records.good(decoded).count() == 0


def test_round_trip(spark):
    events = scenario(spark)
    sent = events.select(
        F.when(F.col("is_view"), "page_views").otherwise("ad_clicks").alias("topic"), "partition", "offset",
        records.encode().alias("value"))
    back = records.good(records.decode(sent)).select(*events.columns)
    assert sorted(back.collect()) == sorted(events.collect())


def test_log_keeps_coordinates(spark, tmp_path):
    events = scenario(spark)
    for _ in range(2):  # a retried write replaces the first
        changelog.write_log(events, str(tmp_path / "log"))
    assert {path.name for path in (tmp_path / "log").rglob("log=*")} == {
        "log=ad_clicks-changelog", "log=page_views-changelog"}
    back = changelog.read_log(spark, str(tmp_path / "log"), events.schema)
    assert sorted(back.collect()) == sorted(events.collect())
