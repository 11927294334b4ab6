"""The three raw feeds as projections of the given tables.

Arithmetic on keys and fixed-width text only, so that the same formulas can be
written in plain SQL. ``raw_orders`` plays the bulk text export, ``raw_events``
the paged JSON feed, ``raw_lineitem`` the annual day-first files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.operators.curate import typed_rows
from wayfuse.operators.mapping import to_canonical
from wayfuse.spec import CHICAGO, NYC, UK

BATCHES = {"chicago_us": "chicago_us_b1", "nyc_us": "nyc_us_b1", "uk_stats19": "uk_stats19_b1"}
INGESTED_AT = "2026-01-05 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _pick(cases: list[tuple[Column, Column | None]], other: Column) -> Column:
    out = None
    for condition, value in cases:
        value = F.lit(None).cast("string") if value is None else value
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(other)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    t = F.col("o_orderdate").cast("timestamp") + F.make_interval(years=F.lit(23),
                                                               mins=(k * 37 % 1440).cast("int"))
    notified = F.when(k % 5000 == 1, F.col("t") - F.expr("INTERVAL 1 DAY")).otherwise(
        F.col("t") + F.make_interval(mins=(k % 90).cast("int")))
    layout = "MM/dd/yyyy hh:mm:ss a"
    p = F.col("o_orderpriority")
    injury = _pick([
        ((p == "1-URGENT") & (k % 10 == 0), F.lit("FATAL")),
        (p == "1-URGENT", F.lit("INCAPACITATING INJURY")),
        (p == "2-HIGH", F.lit("NONINCAPACITATING INJURY")),
        (p == "3-MEDIUM", F.lit("REPORTED, NOT EVIDENT")),
        ((p == "4-NOT SPECIFIED") & (k % 20 == 0), None),
    ], F.lit("NO INDICATION OF INJURY"))
    q = F.floor(k / 5)
    spot = k % 15
    lat_suffix, lon_suffix = _pad(q * 3 % 10, 2), _pad(q * 7 % 10, 2)

    def coordinate(at0, at5, at10, suffix, spread):
        return _pick([
            (k % 97 == 0, F.lit("0")), (k % 53 == 0, None),
            (spot == 0, F.concat(F.lit(at0), suffix)),
            (spot == 5, F.concat(F.lit(at5), suffix)),
            (spot == 10, F.concat(F.lit(at10), suffix)),
        ], spread)

    return (
        table(spark, sf_dir, "orders").withColumn("t", t)
        .select(
            k.cast("string").alias("CRASH_RECORD_ID"),
            F.date_format("t", layout).alias("CRASH_DATE"),
            F.date_format(notified, layout).alias("DATE_POLICE_NOTIFIED"),
            injury.alias("MOST_SEVERE_INJURY"),
            (k % 4).cast("string").alias("INJURIES_TOTAL"),
            F.when(injury == "FATAL", "1").otherwise("0").alias("INJURIES_FATAL"),
            (k % 4 + 1).cast("string").alias("NUM_UNITS"),
            coordinate("41.88", "41.75", "41.92", lat_suffix,
                       F.concat(F.lit("41."), _pad(6500 + k * 7919 % 3000, 4))).alias("LATITUDE"),
            coordinate("-87.62", "-87.65", "-87.70", lon_suffix,
                       F.concat(F.lit("-87."), _pad(5500 + k * 104729 % 3500, 4))).alias("LONGITUDE"),
            _pick([(k % 211 == 0, F.lit("0")), (k % 307 == 0, F.lit("99"))],
                  (15 + k % 5 * 5).cast("string")).alias("POSTED_SPEED_LIMIT"),
            F.concat(F.lit("TYPE_"), k % 6).alias("FIRST_CRASH_TYPE"),
            F.concat(F.lit("CAUSE_"), k % 12).alias("PRIM_CONTRIBUTORY_CAUSE"),
            F.concat(F.lit("W_"), k % 4).alias("WEATHER_CONDITION"),
            F.concat(F.lit("L_"), k % 3).alias("LIGHTING_CONDITION"),
            F.when(F.col("o_orderstatus") == "F", "Y").alias("HIT_AND_RUN_I"),
            ((k % 25 + 1) * 100 + k % 30).cast("string").alias("BEAT_OF_OCCURRENCE"),
        )
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, kind, ts = F.col("event_id"), F.col("event_type"), F.col("ts").cast("timestamp")
    gap = e % 200 == 7

    def slot(i):
        filled = F.when(i <= F.col("user_id") % 5 + 1, F.lit(f"V{i}"))
        return F.when(e % 11 == 0, F.lit("")).otherwise(filled) if i == 2 else filled

    return table(spark, sf_dir, "events").select(
        e.cast("string").alias("collision_id"),
        F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T00:00:00.000")).alias("crash_date"),
        F.concat(F.hour(ts), F.lit(":"), _pad(F.minute(ts), 2)).alias("crash_time"),
        _pick([(kind == "error", (e % 3).cast("string")), (kind == "click", F.lit("0")),
               (kind == "signup", None)], (e % 2).cast("string")).alias("number_of_persons_injured"),
        F.when(e % 9 == 0, "0").alias("number_of_persons_killed"),
        F.when(~gap, F.when((kind == "purchase") & (e % 40 == 0), "1").otherwise("0"))
         .alias("number_of_pedestrians_killed"),
        F.when(~gap, "0").alias("number_of_cyclist_killed"),
        F.when(~gap, "0").alias("number_of_motorist_killed"),
        slot(1).alias("vehicle_type_code1"), slot(2).alias("vehicle_type_code2"),
        slot(3).alias("vehicle_type_code_3"), slot(4).alias("vehicle_type_code_4"),
        slot(5).alias("vehicle_type_code_5"),
        F.when(e % 43 == 0, "0").otherwise(
            F.concat(F.lit("40."), _pad(5000 + e * 7919 % 4000, 4))).alias("latitude"),
        F.when(e % 43 == 0, "0").otherwise(
            F.concat(F.lit("-73."), _pad(7000 + e * 6007 % 2500, 4))).alias("longitude"),
        F.get_json_object("props", "$.k").alias("contributing_factor_vehicle_1"),
    )


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    day = F.add_months(F.to_date(F.col("l_shipdate").cast("timestamp")), 240)
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", o, p, s, n).alias("collision_index"),
        F.date_format(day, "dd/MM/yyyy").alias("date"),
        F.concat(_pad(p % 24, 2), F.lit(":"), _pad(s % 60, 2)).alias("time"),
        _pick([(p % 400 == 13, F.lit("-1")), ((n == 1) & (p % 50 == 0), F.lit("1")),
               (F.col("l_returnflag") == "R", F.lit("2"))], F.lit("3")).alias("collision_severity"),
        _pick([(s % 5 == 0, F.lit("1")), (s % 50 == 1, F.lit("48"))], F.lit("20")).alias("police_force"),
        (o % 5 + 1).cast("string").alias("number_of_casualties"),
        (p % 4 + 1).cast("string").alias("number_of_vehicles"),
        F.when(p % 90 == 0, "-1").otherwise((20 + p % 6 * 10).cast("string")).alias("speed_limit"),
        F.when(p % 70 == 0, "-1").otherwise((p % 9 + 1).cast("string")).alias("weather_conditions"),
        F.when(p % 80 == 0, "-1").otherwise((p % 5 + 1).cast("string")).alias("light_conditions"),
        F.concat(F.lit("51."), _pad(3000 + o * 7919 % 4000, 4)).alias("latitude"),
        F.concat(F.lit("-0."), _pad(1000 + p * 6007 % 3000, 4)).alias("longitude"),
    )


RAW = {"chicago_us": (raw_orders, CHICAGO), "nyc_us": (raw_events, NYC),
       "uk_stats19": (raw_lineitem, UK)}


def raw(spark: SparkSession, sf_dir: str, source_id: str) -> DataFrame:
    return RAW[source_id][0](spark, sf_dir)


def staged(spark: SparkSession, sf_dir: str, *sources: str) -> DataFrame:
    """Canonical text rows of the named sources, of all three by default."""
    parts = None
    for source_id in sources or RAW:
        build, adapter = RAW[source_id]
        rows = to_canonical(build(spark, sf_dir), adapter, BATCHES[source_id],
                            F.lit(INGESTED_AT).cast("timestamp"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def curated(spark: SparkSession, sf_dir: str, *sources: str) -> DataFrame:
    """Typed rows with a valid UTC time, plus date key and partition columns."""
    return typed_rows(staged(spark, sf_dir, *sources))
