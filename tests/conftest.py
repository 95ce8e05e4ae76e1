import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lateline.contract import OBSERVATION_SCHEMA  # noqa: E402
from lateline.workspace import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def ns(text):
    """Nanoseconds of an ISO wall-clock time, sub-second digits included."""
    whole, _, fraction = text.partition(".")
    seconds = int(datetime.fromisoformat(whole).replace(tzinfo=timezone.utc).timestamp())
    return seconds * 1_000_000_000 + int((fraction or "0").ljust(9, "0"))


DEFAULTS = {
    "station_name": "Aville",
    "xml_station_name": "Aville",
    "eva": "0800",
    "train_number": "12",
    "line_number": "1",
    "final_destination_station": "Btown",
    "delay_in_min": 0,
    "is_canceled": False,
    "train_type": "RE",
    "train_line_ride_id": "r1",
    "train_line_station_num": 1,
}


def observation(id, planned="2026-01-10T10:00:00", change=None, **columns):
    """One contract row; both events take the given times unless a column says otherwise."""
    planned_ns = ns(planned)
    change_ns = ns(change) if change else planned_ns
    row = {
        **DEFAULTS,
        "id": id,
        "arrival_planned_time": planned_ns,
        "arrival_change_time": change_ns,
        "departure_planned_time": planned_ns,
        "departure_change_time": change_ns,
        **columns,
    }
    effective = row["departure_change_time"] if row["departure_change_time"] is not None else row["arrival_change_time"]
    row.setdefault("time", effective)
    return row


@pytest.fixture
def observations(spark):
    def make(*rows):
        return spark.createDataFrame([[row[c] for c in OBSERVATION_SCHEMA.fieldNames()] for row in rows], OBSERVATION_SCHEMA)

    return make
