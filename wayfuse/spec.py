"""Canonical schema, source adapters and the fixed limits of the checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Canonical row. (name, logical type, nullable) in output order: fixed values.
# ---------------------------------------------------------------------------
CANONICAL = [
    ("crash_id", "string", False),
    ("source_id", "string", False),
    ("source_record_id", "string", False),
    ("crash_timestamp_utc", "timestamp", False),
    ("police_notified_timestamp_utc", "timestamp", True),
    ("source_local_timezone", "string", False),
    ("city", "string", False),
    ("country", "string", False),
    ("latitude", "float", True),
    ("longitude", "float", True),
    ("has_valid_coordinates", "boolean", False),
    ("severity", "enum", False),
    ("source_severity_raw", "string", True),
    ("num_injured_total", "integer", True),
    ("num_killed", "integer", True),
    ("num_vehicles_involved", "integer", True),
    ("crash_type", "string", True),
    ("primary_cause", "string", True),
    ("weather_condition", "string", True),
    ("lighting_condition", "string", True),
    ("posted_speed_limit_mph", "integer", True),
    ("hit_and_run", "boolean", False),
    ("ingested_at_utc", "timestamp", False),
    ("batch_id", "string", False),
    ("source_row_raw_ref", "string", True),
]
CANONICAL_FIELDS = [name for name, _, _ in CANONICAL]
NON_NULLABLE = [name for name, _, nullable in CANONICAL if not nullable]

SPARK_TYPES = {
    "string": T.StringType(),
    "enum": T.StringType(),
    "timestamp": T.TimestampType(),
    "float": T.DoubleType(),
    "integer": T.IntegerType(),
    "boolean": T.BooleanType(),
}
PARTITION_KEYS = ["source_id", "year", "month"]

STAGED_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in CANONICAL_FIELDS])
CURATED_SCHEMA = T.StructType(
    [T.StructField(n, SPARK_TYPES[t]) for n, t, _ in CANONICAL]
    + [T.StructField("crash_date_key", T.DateType()),
       T.StructField("year", T.IntegerType()),
       T.StructField("month", T.IntegerType())]
)
DQ_LOG_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_checked", T.LongType()),
    T.StructField("rows_failed", T.LongType()),
    T.StructField("details", T.StringType()),
    T.StructField("run_timestamp", T.TimestampType()),
])

# Columns of the warehouse fact, in load order: fixed values.
FACT_COLUMNS = [
    "crash_id", "source_id", "source_record_id", "crash_timestamp_utc", "crash_date_key",
    "police_notified_timestamp_utc", "city", "country", "latitude", "longitude",
    "has_valid_coordinates", "severity", "source_severity_raw", "num_injured_total",
    "num_killed", "num_vehicles_involved", "crash_type", "primary_cause",
    "weather_condition", "lighting_condition", "posted_speed_limit_mph", "hit_and_run",
    "batch_id", "source_row_raw_ref",
]


# ---------------------------------------------------------------------------
# Adapters
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Literal:
    """The same value on every row."""
    value: Any


@dataclass(frozen=True)
class From:
    """A source column, optionally freed of the sentinel and translated."""
    column: str
    null_sentinel: bool = False
    values: dict | None = None
    default: Any = None


@dataclass(frozen=True)
class Derive:
    """A derivation of the registry, by name."""
    name: str


@dataclass(frozen=True)
class Expression:
    """SQL text over source columns; may use the box and the date helper."""
    text: str


@dataclass(frozen=True)
class Adapter:
    source_id: str
    timezone: str
    timestamp_layout: str
    bounding_box: dict
    fields: dict
    null_sentinel: str | None = None
    refresh: dict = field(default_factory=dict)


# Layouts, time zones, boxes, mappings and refresh limits of the
# three sources.
CHICAGO = Adapter(
    source_id="chicago_us",
    timezone="America/Chicago",
    timestamp_layout="M/d/yyyy h:m:s a",
    bounding_box={"latitude": (41.60, 42.05), "longitude": (-87.95, -87.50)},
    refresh={"method": "local_file", "max_unchanged_days": 14,
             "incoming_pattern": "Traffic_Crashes_-_Crashes_*.csv"},
    fields={
        "source_id": Literal("chicago_us"),
        "source_local_timezone": Literal("America/Chicago"),
        "crash_id": Derive("chicago_crash_id"),
        "source_record_id": From("CRASH_RECORD_ID"),
        "crash_timestamp_utc": From("CRASH_DATE"),
        "police_notified_timestamp_utc": From("DATE_POLICE_NOTIFIED"),
        "city": Literal("Chicago"),
        "country": Literal("US"),
        "latitude": From("LATITUDE"),
        "longitude": From("LONGITUDE"),
        "has_valid_coordinates": Derive("chicago_has_valid_coordinates"),
        "severity": From("MOST_SEVERE_INJURY", values={
            "FATAL": "fatal",
            "INCAPACITATING INJURY": "serious",
            "NONINCAPACITATING INJURY": "minor",
            "REPORTED, NOT EVIDENT": "minor",
            "NO INDICATION OF INJURY": "none",
            None: "unknown",
        }, default="unknown"),
        "source_severity_raw": From("MOST_SEVERE_INJURY"),
        "num_injured_total": From("INJURIES_TOTAL"),
        "num_killed": From("INJURIES_FATAL"),
        "num_vehicles_involved": From("NUM_UNITS"),
        "crash_type": From("FIRST_CRASH_TYPE"),
        "primary_cause": From("PRIM_CONTRIBUTORY_CAUSE"),
        "weather_condition": From("WEATHER_CONDITION"),
        "lighting_condition": From("LIGHTING_CONDITION"),
        "posted_speed_limit_mph": From("POSTED_SPEED_LIMIT"),
        "hit_and_run": From("HIT_AND_RUN_I", values={"Y": True, None: False}, default=False),
    },
)

NYC = Adapter(
    source_id="nyc_us",
    timezone="America/New_York",
    timestamp_layout="iso",
    bounding_box={"latitude": (40.49, 40.92), "longitude": (-74.26, -73.68)},
    refresh={"method": "api", "max_publication_lag_days": 180},
    fields={
        "source_id": Literal("nyc_us"),
        "source_local_timezone": Literal("America/New_York"),
        "crash_id": Derive("nyc_crash_id"),
        "source_record_id": From("collision_id"),
        "crash_timestamp_utc": Derive("nyc_crash_timestamp"),
        "police_notified_timestamp_utc": Literal(None),
        "city": Literal("New York City"),
        "country": Literal("US"),
        "latitude": From("latitude"),
        "longitude": From("longitude"),
        "has_valid_coordinates": Derive("nyc_has_valid_coordinates"),
        "severity": Derive("nyc_severity"),
        "source_severity_raw": Derive("nyc_source_severity_raw"),
        "num_injured_total": From("number_of_persons_injured"),
        "num_killed": Derive("nyc_num_killed"),
        "num_vehicles_involved": Derive("nyc_num_vehicles"),
        "crash_type": Literal(None),
        "primary_cause": From("contributing_factor_vehicle_1"),
        "weather_condition": Literal(None),
        "lighting_condition": Literal(None),
        "posted_speed_limit_mph": Literal(None),
        "hit_and_run": Literal(False),
    },
)

UK = Adapter(
    source_id="uk_stats19",
    timezone="Europe/London",
    timestamp_layout="d/M/yyyy H:m",
    bounding_box={"latitude": (49.85, 60.55), "longitude": (-7.60, 1.80)},
    null_sentinel="-1",
    refresh={"method": "local_file", "max_unchanged_days": 400,
             "incoming_pattern": "dft-road-casualty-statistics-collision-{year}.csv"},
    fields={
        "source_id": Literal("uk_stats19"),
        "source_local_timezone": Literal("Europe/London"),
        "crash_id": Derive("uk_crash_id"),
        "source_record_id": From("collision_index"),
        "crash_timestamp_utc": Derive("uk_crash_timestamp"),
        "police_notified_timestamp_utc": Literal(None),
        "city": Derive("uk_city"),
        "country": Literal("GB"),
        "latitude": From("latitude", null_sentinel=True),
        "longitude": From("longitude", null_sentinel=True),
        "has_valid_coordinates": Derive("uk_has_valid_coordinates"),
        "severity": From("collision_severity", null_sentinel=True,
                         values={1: "fatal", 2: "serious", 3: "minor", None: "unknown"},
                         default="unknown"),
        "source_severity_raw": From("collision_severity"),
        "num_injured_total": From("number_of_casualties"),
        "num_killed": Literal(None),
        "num_vehicles_involved": From("number_of_vehicles"),
        "crash_type": Literal(None),
        "primary_cause": Literal(None),
        "weather_condition": From("weather_conditions", null_sentinel=True),
        "lighting_condition": From("light_conditions", null_sentinel=True),
        "posted_speed_limit_mph": From("speed_limit", null_sentinel=True),
        "hit_and_run": Literal(False),
    },
)

ADAPTERS = {a.source_id: a for a in (CHICAGO, NYC, UK)}

# ---------------------------------------------------------------------------
# Fixed values of the checks
# ---------------------------------------------------------------------------
STRUCTURAL_GAPS = {
    "chicago_us": set(),
    "nyc_us": {"police_notified_timestamp_utc", "crash_type", "weather_condition",
               "lighting_condition", "posted_speed_limit_mph"},
    "uk_stats19": {"police_notified_timestamp_utc", "city", "num_killed", "crash_type",
                   "primary_cause"},
}
DATE_LOGIC_TOLERANCE = {"chicago_us": 5, "nyc_us": 0, "uk_stats19": 0}
NUMERIC_RANGES = {
    "num_injured_total": (0, None),
    "num_killed": (0, None),
    "num_vehicles_involved": (0, None),
    "posted_speed_limit_mph": (0, 200),
}
SPEED_BAND = (5, 70)
ACCEPTED_VALUES = {
    "severity": ["fatal", "serious", "minor", "none", "unknown"],
    "country": ["US", "GB"],
}
MAX_EXCLUDED_FRACTION = 0.001
MIN_EXCLUDED_ALLOWANCE = 25
MIN_PLAUSIBLE = "2000-01-01 00:00:00"
FUTURE_SLACK_DAYS = 1
TRAILING_WINDOW_DAYS = 90
EXPECTED_YEARS = [2021, 2022, 2023, 2024, 2025]

# Fixed values of the like-for-like comparisons.
CITY_OF_SOURCE = {"chicago_us": "Chicago", "nyc_us": "New York City", "uk_stats19": "London"}
RESIDENTS = {"Chicago": 2_746_388, "New York City": 8_804_190, "London": 8_799_800}
AREA_KM2 = {"Chicago": 589.8, "New York City": 778.2, "London": 1572.0}
INJURY_SEVERITIES = ["fatal", "serious", "minor"]
SEVERITY_ORDER = ["fatal", "serious", "minor", "none", "unknown"]
FRAMES = [
    ("Chicago vs London", ["Chicago", "London"]),
    ("Chicago vs New York City", ["Chicago", "New York City"]),
    ("All three cities", ["Chicago", "New York City", "London"]),
]

# Fixed values of the hotspot search.
EARTH_RADIUS_M = 6_371_000.0
EPS_METERS = 150.0
DENSITY_RATIO = 10
MIN_SAMPLES_FLOOR = 5
STABILITY_SEEDS = [0, 1, 2]
STABILITY_FRACTION = 0.8

# (source_id, provider, dataset_url, city, country, timezone, licence): fixed values.
DIM_SOURCE = [
    ("chicago_us", "City of Chicago Data Portal (Socrata)",
     "https://data.cityofchicago.org/Transportation/Traffic-Crashes-Crashes/85ca-t3if",
     "Chicago", "US", "America/Chicago", "Public domain / open data"),
    ("nyc_us", "NYC OpenData (Socrata)",
     "https://data.cityofnewyork.us/Public-Safety/Motor-Vehicle-Collisions-Crashes/h9gi-nx95",
     "New York City", "US", "America/New_York", "Public domain / open data"),
    ("uk_stats19", "UK Department for Transport (data.gov.uk)",
     "https://www.data.gov.uk/dataset/road-accidents-safety-data",
     None, "GB", "Europe/London", "Open Government Licence v3.0"),
]
