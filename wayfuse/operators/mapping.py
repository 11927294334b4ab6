"""Adapter to canonical row: the whole mapping is one projection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfuse.functions.derivations import REGISTRY
from wayfuse.functions.scalars import to_double
from wayfuse.spec import CANONICAL_FIELDS, Adapter, Derive, Expression, From, Literal


def _text(value) -> str | None:
    if value is None:
        return None
    return str(value).lower() if isinstance(value, bool) else str(value)


def translate(source: Column, values: dict, default=None) -> Column:
    """Value translation; integer keys match their text form, the None key matches null."""
    out = F.when(source.isNull(), F.lit(_text(values.get(None, default))))
    for key, value in values.items():
        if key is not None:
            out = out.when(source == str(key), F.lit(_text(value)))
    return out.otherwise(F.lit(_text(default)))


def expression_column(text: str, adapter: Adapter) -> Column:
    """SQL text with ``combine_date_and_time(a, b)`` and ``between(x, bounding_box.axis)``."""
    text = re.sub(
        r"combine_date_and_time\(\s*(\w+)\s*,\s*(\w+)\s*\)",
        r"CASE WHEN trim(\1) <> '' AND trim(\2) <> '' THEN concat(\1, ' ', \2) END", text)
    for axis, (low, high) in adapter.bounding_box.items():
        text = re.sub(
            rf"between\(\s*(\w+)\s*,\s*bounding_box\.{axis}\s*\)",
            rf"coalesce(try_cast(trim(\1) AS DOUBLE) BETWEEN {low!r}D AND {high!r}D, false)", text)
    return F.expr(text)


def field_column(name: str, spec, adapter: Adapter, columns: set[str]) -> Column:
    """The column expression of one mapped field."""
    if isinstance(spec, Literal):
        return F.lit(_text(spec.value)).cast("string")
    if isinstance(spec, Derive):
        if spec.name not in REGISTRY:
            raise ValueError(f"{name}: no derivation named {spec.name!r}")
        return REGISTRY[spec.name](adapter).cast("string")
    if isinstance(spec, Expression):
        return expression_column(spec.text, adapter).cast("string")
    if isinstance(spec, From):
        if spec.column not in columns:
            raise KeyError(f"{name} is mapped from {spec.column!r}, which the raw data lacks; "
                           f"it has {sorted(columns)[:15]}")
        out = F.col(spec.column).cast("string")
        if spec.null_sentinel and adapter.null_sentinel is not None:
            out = F.nullif(out, F.lit(adapter.null_sentinel))
        return out if spec.values is None else translate(out, spec.values, spec.default)
    raise ValueError(f"{name}: unknown mapping {spec!r}")


def is_zero_point(lat: Column, lon: Column) -> Column:
    """The (0, 0) stand-in for 'no position'; both must be exactly zero."""
    return F.coalesce((to_double(lat) == 0) & (to_double(lon) == 0), F.lit(False))


def to_canonical(raw: DataFrame, adapter: Adapter, batch_id: str,
                 ingested_at: Column | None = None) -> DataFrame:
    """Canonical text rows of a raw frame: one select, no shuffle, no Python."""
    have = set(raw.columns)
    mapped = {n: field_column(n, s, adapter, have)
              for n, s in adapter.fields.items() if n in CANONICAL_FIELDS}
    mapped.setdefault("batch_id", F.lit(batch_id))
    now = F.current_timestamp() if ingested_at is None else ingested_at
    mapped.setdefault("ingested_at_utc", now.cast("string"))
    if "latitude" in mapped and "longitude" in mapped:
        lat, lon = mapped["latitude"], mapped["longitude"]
        zero = is_zero_point(lat, lon)
        mapped["latitude"] = F.when(~zero, lat)
        mapped["longitude"] = F.when(~zero, lon)
    empty = F.lit(None).cast("string")
    return raw.select([mapped.get(n, empty).alias(n) for n in CANONICAL_FIELDS])
