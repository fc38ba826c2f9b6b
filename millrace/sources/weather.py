"""Hourly weather readings: CSV contract, typed points, strict rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.clock import offset_timestamp_utc
from ..functions.once import compute_once
from ..functions.text import finite_double, optional_text, required_text, strip
from ..operators.contracts import fail_fast, judge
from .files import POSITION, position, read_csv_contract

# The CSV contract and the names its columns are stored under.
HEADER = (
    "Formatted Date",
    "Summary",
    "Precip Type",
    "Temperature (C)",
    "Apparent Temperature (C)",
    "Humidity",
    "Wind Speed (km/h)",
    "Wind Bearing (degrees)",
    "Visibility (km)",
    "Loud Cover",
    "Pressure (millibars)",
    "Daily Summary",
)
NUMERIC = {
    "Temperature (C)": "temperature_c",
    "Apparent Temperature (C)": "apparent_temperature_c",
    "Humidity": "humidity",
    "Wind Speed (km/h)": "wind_speed_kmh",
    "Wind Bearing (degrees)": "wind_bearing_degrees",
    "Visibility (km)": "visibility_km",
    "Loud Cover": "cloud_cover",
    "Pressure (millibars)": "pressure_millibars",
}
REQUIRED = {"Summary": "summary", "Daily Summary": "daily_summary"}
OPTIONAL = {"Precip Type": "precip_type"}
LOCATION = "Szeged"

IDENTITY = ("location", "time")
FIELDS = (*NUMERIC.values(), *REQUIRED.values(), *OPTIONAL.values())


def read_weather_cells(spark: SparkSession, path: str) -> DataFrame:
    """Raw text cells with their reading position."""
    cells = read_csv_contract(spark, path, HEADER)
    return cells.select(
        *[F.col(f"`{name}`") for name in HEADER],
        "_corrupt_record",
        position(),
    )


def judge_weather(cells: DataFrame, location: str = LOCATION) -> DataFrame:
    """Typed points with ``reject_reason``; keeps the position of each record."""
    typed = compute_once(
        cells,
        [name for name in ("_corrupt_record", POSITION) if name in cells.columns],
        location=F.lit(location),
        time=offset_timestamp_utc(strip(F.col("Formatted Date"))),
        **{field: finite_double(F.col(f"`{name}`")) for name, field in NUMERIC.items()},
        **{field: required_text(F.col(f"`{name}`")) for name, field in REQUIRED.items()},
        **{field: optional_text(F.col(f"`{name}`")) for name, field in OPTIONAL.items()},
    )
    shape = [(F.col("_corrupt_record").isNull(), "row does not match the header")] \
        if "_corrupt_record" in cells.columns else []
    rules = [
        *shape,
        (F.col("time").isNotNull(), "Formatted Date is not a timestamp with offset"),
        *[(F.col(field).isNotNull(), f"{name} is not a finite number") for name, field in NUMERIC.items()],
        *[(F.col(field).isNotNull(), f"{name} is empty") for name, field in REQUIRED.items()],
    ]
    return judge(typed, rules).drop("_corrupt_record")


def read_weather(spark: SparkSession, path: str, location: str = LOCATION) -> DataFrame:
    """Points of a weather CSV; the first malformed record stops the job with its position."""
    judged = judge_weather(read_weather_cells(spark, path), location)
    return fail_fast(judged, F.to_json(POSITION))
