import pytest
from pyspark.sql import functions as F

from wayfuse.functions import derivations as D
from wayfuse.functions.scalars import percent, to_bool, to_double, to_int, to_whole
from wayfuse.operators.mapping import (expression_column, field_column, to_canonical, translate)
from wayfuse.spec import CANONICAL_FIELDS, CHICAGO, NYC, UK, Adapter, Derive, Expression, From, Literal


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first().v


def many(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_literal_and_null_literal(spark):
    assert one(spark, field_column("city", Literal("Chicago"), CHICAGO, {"c"}), c="x") == "Chicago"
    assert one(spark, field_column("city", Literal(None), CHICAGO, {"c"}), c="x") is None
    assert one(spark, field_column("hit_and_run", Literal(False), NYC, {"c"}), c="x") == "false"


def test_unknown_column_names_the_field():
    with pytest.raises(KeyError, match="severity"):
        field_column("severity", From("NOPE"), CHICAGO, {"c"})


def test_unknown_derivation():
    with pytest.raises(ValueError, match="no_such"):
        field_column("severity", Derive("no_such"), CHICAGO, {"c"})


def test_sentinel_is_exact_text(spark):
    c = field_column("x", From("c", null_sentinel=True), UK, {"c"})
    assert many(spark, c, ["-1", "-1.0", "30", None]) == [None, "-1.0", "30", None]


def test_map_keys_null_and_default(spark):
    c = translate(F.col("c"), {1: "fatal", None: "unknown"}, "other")
    assert many(spark, c, ["1", "2", None, "1.0"]) == ["fatal", "other", "unknown", "other"]
    assert many(spark, translate(F.col("c"), {"a": "b"}), ["a", "x", None]) == ["b", None, None]


def test_inline_expression(spark):
    c = expression_column("between(c, bounding_box.latitude)", CHICAGO)
    assert many(spark, c, ["41.7", "50", None, "x"]) == [True, False, False, False]
    spec = Expression("upper(c)")
    assert one(spark, field_column("x", spec, CHICAGO, {"c"}), c="ab") == "AB"


def test_box_and_zero_point(spark):
    rows = [("41.88", "-87.62"), ("0", "0"), ("50", "-87.62"), (None, None), ("41.6", "-87.95"), ("x", "1")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r.v for r in df.select(D.inside_box(F.col("a"), F.col("b"), CHICAGO.bounding_box).alias("v")).collect()]
    assert got == [True, False, False, False, True, False]


def test_severity_from_counts(spark):
    cols = ["number_of_persons_injured", *D._KILLED]
    rows = [("0", "0", "0", "0"), ("2", "0", "0", "0"), ("0", "1", "0", "0"), ("1", None, None, None),
            ("0", None, None, None), (None, "0", None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = [r.v for r in df.select(D.REGISTRY["nyc_severity"](NYC).alias("v")).collect()]
    assert got == ["none", "minor", "fatal", "minor", "unknown", "none", "unknown"]


@pytest.mark.parametrize("force,city", [("1", "London"), ("48", "London"), ("1.0", "London"), (" 48 ", "London"),
                                        ("Metropolitan Police", "London"), ("City of London", "London"),
                                        ("20", None), ("", None), (None, None), ("10", None)])
def test_london(spark, force, city):
    assert many(spark, D.greater_london(F.col("c")), [force, "x"])[0] == city


def test_combine_needs_both(spark):
    df = spark.createDataFrame([("d", "t"), ("d", ""), (None, "t"), ("d", " ")], "a string, b string")
    got = [r.v for r in df.select(D.combine_date_time(F.col("a"), F.col("b")).alias("v")).collect()]
    assert got == ["d t", None, None, None]


def test_casts(spark):
    assert many(spark, to_int(F.col("c")), ["2.0", "2.7", "x", None, " 3 "]) == [2, 2, None, None, 3]
    assert many(spark, to_whole(F.col("c")), ["2.0", "2.7", "x"]) == [2, None, None]
    assert many(spark, to_double(F.col("c")), ["1.5", "", "NA"]) == [1.5, None, None]
    assert many(spark, to_bool(F.col("c")), ["Y", "0", "", "maybe", None, " TRUE "]) == [
        True, False, False, None, None, True]


def test_percent_rounds_half_up(spark):
    row = spark.range(1).select(percent(F.lit(1), F.lit(8), 2).alias("a"), percent(F.lit(5), F.lit(1000), 0).alias("b"),
                                percent(F.lit(1), F.lit(0), 2).alias("c")).first()
    assert (row.a, row.b, row.c) == (12.5, 1.0, None)


def test_canonical_row(spark):
    adapter = Adapter("s", "UTC", "iso", {"latitude": (0, 1), "longitude": (0, 1)},
                      {"crash_id": Literal("s:1"), "latitude": From("a"), "longitude": From("b"), "unheard_of": From("a")})
    df = spark.createDataFrame([("0", "0.0"), ("0", "1"), ("2", "3")], "a string, b string")
    out = to_canonical(df, adapter, "batch")
    assert out.columns == CANONICAL_FIELDS
    rows = out.collect()
    assert [(r.latitude, r.longitude) for r in rows] == [(None, None), ("0", "1"), ("2", "3")]
    assert rows[0].batch_id == "batch" and rows[0].severity is None and rows[0].ingested_at_utc
