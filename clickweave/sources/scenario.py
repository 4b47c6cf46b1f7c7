"""The six-user walk-through used by the tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from clickweave.schemas import EVENT

# Fixed values, in arrival order: is_view, offset, user, time of day on 2024-01-01, id, label, arrival.
ARRIVALS = [
    (False, 0, "user_1", "12:05:00", "click_1", "campaign_A", "12:05:01"),
    (True, 0, "user_1", "12:10:00", "pv_1", "https://example.com/product1", "12:10:02"),
    (True, 1, "user_2", "12:15:00", "pv_2", "https://example.com/product2", "12:15:01"),
    (False, 1, "user_2", "12:12:00", "click_2", "campaign_B", "12:16:00"),
    (False, 2, "user_3", "12:20:00", "click_3a", "campaign_C", "12:20:01"),
    (False, 3, "user_3", "12:25:00", "click_3b", "campaign_D", "12:25:01"),
    (True, 2, "user_3", "12:30:00", "pv_3", "https://example.com/product3", "12:30:02"),
    (False, 4, "user_4", "12:35:00", "click_4", "campaign_E", "12:35:01"),
    (True, 3, "user_5", "12:45:00", "pv_5", "https://example.com/product5", "12:45:02"),
    (False, 5, "user_5", "12:58:00", "click_5_a", "campaign_G", "12:58:01"),
    (False, 6, "user_5", "12:40:00", "click_5_b", "campaign_F", "13:00:00"),
    (True, 4, "user_4", "13:10:00", "pv_4", "https://example.com/product4", "13:10:02"),
    (True, 5, "user_6", "13:20:00", "pv_6", "https://example.com/product6", "13:20:01"),
]

# View, campaign and click of the expected result.
EXPECTED = {
    "pv_1": ("campaign_A", "click_1"),
    "pv_2": ("campaign_B", "click_2"),
    "pv_3": ("campaign_D", "click_3b"),
    "pv_4": (None, None),
    "pv_5": (None, None),
    "pv_6": (None, None),
}
LATE = {"click_5_b"}


def at(time_of_day: str) -> datetime:
    return datetime.fromisoformat(f"2024-01-01T{time_of_day}")


def event_row(is_view: bool, offset: int, user: str, time: str, id: str, label: str, partition: int = 0) -> tuple:
    return (is_view, partition, offset, user, at(time), id, label)


def scenario(spark: SparkSession, arrivals: list[tuple] = ARRIVALS) -> DataFrame:
    return spark.createDataFrame([event_row(*arrival[:6]) for arrival in arrivals], EVENT)
