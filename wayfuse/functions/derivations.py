"""Named derivations an adapter may refer to, each one Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfuse.functions.scalars import is_missing, to_double, to_int, total
from wayfuse.spec import Adapter

_KILLED = ["number_of_pedestrians_killed", "number_of_cyclist_killed", "number_of_motorist_killed"]
_VEHICLES = ["vehicle_type_code1", "vehicle_type_code2", "vehicle_type_code_3",
             "vehicle_type_code_4", "vehicle_type_code_5"]
# Police areas that form Greater London, as code or label: fixed values.
_LONDON = ["1", "48", "metropolitan police", "city of london"]


def prefixed_id(adapter: Adapter, column: str) -> Column:
    return F.concat(F.lit(adapter.source_id + ":"), F.col(column))


def combine_date_time(date: Column, time: Column) -> Column:
    """``date time`` when both are given, else null."""
    return F.when(~is_missing(date) & ~is_missing(time), F.concat_ws(" ", date, time))


def inside_box(lat: Column, lon: Column, box: dict) -> Column:
    """Both numeric, not (0, 0), within the box edges included; never null."""
    la, lo = to_double(lat), to_double(lon)
    ok = la.between(*box["latitude"]) & lo.between(*box["longitude"]) & ~((la == 0) & (lo == 0))
    return F.coalesce(ok, F.lit(False))


def greater_london(force: Column) -> Column:
    code = F.regexp_replace(F.lower(F.trim(force)), r"\.0$", "")
    return F.when(code.isin(*_LONDON), F.lit("London"))


def sum_components(columns: list[str]) -> Column:
    return total([F.coalesce(to_int(F.col(c)), F.lit(0)) for c in columns])


def count_filled(columns: list[str]) -> Column:
    return total([F.when(is_missing(F.col(c)), 0).otherwise(1) for c in columns])


def severity_from_counts(injured: str, killed: list[str]) -> Column:
    hurt = to_int(F.col(injured))
    dead = sum_components(killed)
    known = F.coalesce(*[to_int(F.col(c)) for c in killed]).isNotNull()
    return (F.when(known & (dead > 0), "fatal")
            .when(hurt > 0, "minor")
            .when(F.coalesce(hurt == 0, F.lit(True)) & known & (dead == 0), "none")
            .otherwise("unknown"))


def counts_audit(killed: str, injured: str) -> Column:
    def shown(c):
        return F.when(is_missing(F.col(c)), F.lit("0")).otherwise(F.col(c))
    return F.concat(F.lit("killed="), shown(killed), F.lit(",injured="), shown(injured))


def _box(lat: str, lon: str) -> Callable[[Adapter], Column]:
    return lambda adapter: inside_box(F.col(lat), F.col(lon), adapter.bounding_box)


# name -> builder of the column for an adapter
REGISTRY: dict[str, Callable[[Adapter], Column]] = {
    "chicago_crash_id": lambda a: prefixed_id(a, "CRASH_RECORD_ID"),
    "chicago_has_valid_coordinates": _box("LATITUDE", "LONGITUDE"),
    "uk_crash_id": lambda a: prefixed_id(a, "collision_index"),
    "uk_crash_timestamp": lambda a: combine_date_time(F.col("date"), F.col("time")),
    "uk_city": lambda a: greater_london(F.col("police_force")),
    "uk_has_valid_coordinates": _box("latitude", "longitude"),
    "nyc_crash_id": lambda a: prefixed_id(a, "collision_id"),
    "nyc_crash_timestamp": lambda a: combine_date_time(F.col("crash_date"), F.col("crash_time")),
    "nyc_has_valid_coordinates": _box("latitude", "longitude"),
    "nyc_num_killed": lambda a: sum_components(_KILLED),
    "nyc_num_vehicles": lambda a: count_filled(_VEHICLES),
    "nyc_severity": lambda a: severity_from_counts("number_of_persons_injured", _KILLED),
    "nyc_source_severity_raw": lambda a: counts_audit("number_of_persons_killed",
                                                      "number_of_persons_injured"),
}
