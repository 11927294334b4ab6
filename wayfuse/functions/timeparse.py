"""Local wall-clock text to UTC, and calendar parts in local time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def parse_local(text: Column, layout: str) -> Column:
    """Strict parse of wall-clock text; null when it does not fit the layout.

    ``iso`` is a date, with or without a midnight suffix, followed by a time of
    its own: ``2026-04-01T00:00:00.000 6:00``, ``2026-04-01 06:00``.
    """
    if layout == "iso":
        plain = F.regexp_replace(F.trim(text), r"T\S* ", " ")
        plain = F.regexp_replace(plain, r"^(\d{4}-\d{2}-\d{2})T", "$1 ")
        return F.try_to_timestamp(plain, F.lit("yyyy-MM-dd[ H:mm[:ss[.SSS]]]"))
    return F.try_to_timestamp(text, F.lit(layout))


def is_certain(local: Column, utc: Column, zone: str) -> Column:
    """The clock shows this wall-clock time exactly once.

    False in the autumn hour that comes twice and the spring hour that never comes: the
    instant cannot be known there. A change of the clock lies within a day of such a time,
    so the offsets a day before and a day after are the only two it can have; whatever the
    size of the change, the time is certain if just one of them reads back as itself.
    """
    def read(shift: str) -> Column:
        at = F.expr(shift) + utc
        offset = F.unix_micros(F.from_utc_timestamp(at, zone)) - F.unix_micros(at)
        return F.timestamp_micros(F.unix_micros(local) - offset)

    before, after = read("INTERVAL -1 DAY"), read("INTERVAL 1 DAY")
    shown = lambda at: F.from_utc_timestamp(at, zone) == local
    return F.when(before == after, shown(before)).otherwise(shown(before) != shown(after))


def local_to_utc(local: Column, zone: str) -> Column:
    """UTC instant of a wall-clock time, null where that is ambiguous or never was."""
    utc = F.to_utc_timestamp(local, zone)
    return F.when(is_certain(local, utc, zone), utc)


def by_source(build, adapters, otherwise: Column) -> Column:
    """CASE over the source; a constant source leaves the optimizer one branch."""
    out = None
    for adapter in adapters:
        match, value = F.col("source_id") == adapter.source_id, build(adapter)
        out = F.when(match, value) if out is None else out.when(match, value)
    return out.otherwise(otherwise)


def with_utc(df: DataFrame, columns: list[str], adapters) -> DataFrame:
    """Replace wall-clock text by UTC timestamps, by each row's source.

    Three projections on purpose: parsed text, converted instant and test are
    each computed once, where one nested expression would parse the text again
    for every mention of it.
    """
    parsed = {f"_local_{c}": by_source(lambda a, c=c: parse_local(F.col(c), a.timestamp_layout),
                                       adapters, parse_local(F.col(c), "iso")) for c in columns}
    shifted = {f"_utc_{c}": by_source(
        lambda a, c=c: F.to_utc_timestamp(f"_local_{c}", a.timezone),
        adapters, F.col(f"_local_{c}")) for c in columns}
    certain = {c: F.when(by_source(
        lambda a, c=c: is_certain(F.col(f"_local_{c}"), F.col(f"_utc_{c}"), a.timezone),
        adapters, F.lit(True)), F.col(f"_utc_{c}")) for c in columns}
    return (df.withColumns(parsed).withColumns(shifted).withColumns(certain)
            .drop(*parsed, *shifted))


def parse_mixed(text: Column) -> Column:
    """Month-first text with a 12-hour clock, or a 24-hour clock without seconds."""
    t = F.trim(text)
    return F.coalesce(F.try_to_timestamp(t, F.lit("M/d/yyyy h:m:s a")),
                      F.try_to_timestamp(t, F.lit("M/d/yyyy H:m")))


def add_local_time(df: DataFrame) -> DataFrame:
    """local_date, local_hour, local_dow (0 = Monday), local_year, is_weekend per row zone."""
    local = F.from_utc_timestamp("crash_timestamp_utc", F.col("source_local_timezone"))
    return (df.withColumn("_local", local)
            .withColumns({
                "local_date": F.to_date("_local"),
                "local_hour": F.hour("_local"),
                "local_dow": F.weekday("_local"),
                "local_year": F.year("_local"),
                "is_weekend": F.weekday("_local") >= 5,
            }).drop("_local"))

