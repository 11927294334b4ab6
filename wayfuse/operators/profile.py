"""Profile of a raw text table: every section is one DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfuse.functions.scalars import count_if, percent, to_double
from wayfuse.functions.timeparse import parse_mixed
from wayfuse.session import saved
from wayfuse.spec import CHICAGO, SPEED_BAND

# Flag columns in which blank means no, and the columns of a full export: fixed values.
YES_ONLY = ["INTERSECTION_RELATED_I", "NOT_RIGHT_OF_WAY_I", "HIT_AND_RUN_I", "PHOTOS_TAKEN_I",
            "STATEMENTS_TAKEN_I", "DOORING_I", "WORK_ZONE_I", "WORKERS_PRESENT_I",
            "CRASH_DATE_EST_I"]
EXPECTED = [
    "CRASH_RECORD_ID", "CRASH_DATE_EST_I", "CRASH_DATE", "POSTED_SPEED_LIMIT",
    "TRAFFIC_CONTROL_DEVICE", "DEVICE_CONDITION", "WEATHER_CONDITION", "LIGHTING_CONDITION",
    "FIRST_CRASH_TYPE", "TRAFFICWAY_TYPE", "LANE_CNT", "ALIGNMENT", "ROADWAY_SURFACE_COND",
    "ROAD_DEFECT", "REPORT_TYPE", "CRASH_TYPE", "INTERSECTION_RELATED_I", "NOT_RIGHT_OF_WAY_I",
    "HIT_AND_RUN_I", "DAMAGE", "DATE_POLICE_NOTIFIED", "PRIM_CONTRIBUTORY_CAUSE",
    "SEC_CONTRIBUTORY_CAUSE", "STREET_NO", "STREET_DIRECTION", "STREET_NAME",
    "BEAT_OF_OCCURRENCE", "PHOTOS_TAKEN_I", "STATEMENTS_TAKEN_I", "DOORING_I", "WORK_ZONE_I",
    "WORK_ZONE_TYPE", "WORKERS_PRESENT_I", "NUM_UNITS", "CRASH_MONTH", "MOST_SEVERE_INJURY",
    "INJURIES_TOTAL", "INJURIES_FATAL", "INJURIES_INCAPACITATING",
    "INJURIES_NON_INCAPACITATING", "INJURIES_REPORTED_NOT_EVIDENT", "INJURIES_NO_INDICATION",
    "INJURIES_UNKNOWN", "CRASH_HOUR", "CRASH_DAY_OF_WEEK", "IDOT_CONTROL_NO", "LATITUDE",
    "LONGITUDE", "LOCATION",
]
CATEGORIES = ["CRASH_TYPE", "MOST_SEVERE_INJURY", "FIRST_CRASH_TYPE", "WEATHER_CONDITION",
              "LIGHTING_CONDITION", "TRAFFIC_CONTROL_DEVICE", "PRIM_CONTRIBUTORY_CAUSE",
              "REPORT_TYPE"]
DATES = ["CRASH_DATE", "DATE_POLICE_NOTIFIED"]
COVERAGE_CUTOFF = "2017-09-01"


def _unpivot(one_row: DataFrame, entries: dict[str, dict[str, Column]], name: str) -> DataFrame:
    """A one-row aggregate turned to one row per entry."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(key).alias(name), *[c.alias(k) for k, c in cells.items()])
        for key, cells in entries.items()]))
    return one_row.select(rows.alias("r")).select("r.*")


def schema_report(df: DataFrame, expected: list[str] = EXPECTED) -> DataFrame:
    """Every expected or present column with its type and status, and the row count."""
    types = dict(df.dtypes)
    entries = {}
    for c in sorted(set(expected) | set(df.columns)):
        status = "missing" if c not in types else "ok" if c in expected else "extra"
        entries[c] = {"data_type": F.lit(types.get(c)).cast("string"), "status": F.lit(status),
                      "n_rows": F.col("n"), "n_columns": F.lit(len(df.columns)).cast("long")}
    return _unpivot(df.agg(F.count("*").alias("n")), entries, "column_name")


def missingness_report(df: DataFrame) -> DataFrame:
    """Nulls per column, flag columns told apart: one pass whatever the width."""
    counted = df.agg(F.count("*").alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = {c: {"kind": F.lit("yes_only_flag" if c in YES_ONLY else "ordinary"),
                   "null_count": F.col(c), "pct_null": percent(F.col(c), F.col("_n"), 2)}
               for c in df.columns}
    return _unpivot(counted, entries, "column_name")


def near_empty_columns(df: DataFrame, threshold: float = 95.0) -> DataFrame:
    counted = df.agg(F.count("*").alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = {c: {"_empty": F.col(c) * 100 >= F.lit(threshold) * F.col("_n")} for c in df.columns}
    return _unpivot(counted, entries, "column_name").where("_empty").select("column_name")


def row_digest(columns: list[str]) -> Column:
    """128 bits of the values of ``columns``; a null and an empty text differ, and no value runs into the next."""
    cells = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws(",", *cells)))


def extra_copies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows beyond the first of each distinct value of ``columns``; nulls are equal."""
    return extra_copies_by(df, {"all": columns}).select(F.col("extra_rows"))


def extra_copies_by(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """``kind`` and ``extra_rows`` for each named set of columns, in one scan and one more for each set.

    The first shuffles 16 bytes for each row and set, combined in the map tasks. Rows that share no digest
    are no copies. The others, as a rule few, are read again and counted by their values.
    """
    marks = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), row_digest(c).alias("digest")) for k, c in keys.items()]))
    met = saved(df.select(marks.alias("m")).groupBy("m.kind", "m.digest").agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1").select(F.col("kind").alias("_kind"), "digest"), "met-digests")
    found = None
    for kind, columns in keys.items():
        again = df.select(*columns, row_digest(columns).alias("_digest")).join(
            met.where(F.col("_kind") == kind).select(F.col("digest").alias("_digest")), "_digest", "left_semi")
        counted = again.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.lit(kind).alias("kind"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("extra_rows"))
        found = counted if found is None else found.unionByName(counted)
    return found


def duplicate_report(df: DataFrame, key: str = "CRASH_RECORD_ID") -> DataFrame:
    return extra_copies_by(df, {"full_row": df.columns, key: [key]})


def date_report(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Per date column: range, clock styles, failed parses, dates in the future."""
    columns = [c for c in DATES if c in df.columns]
    parsed = df.select(*columns).withColumns({f"_t_{c}": parse_mixed(F.col(c)) for c in columns})
    now = F.current_timestamp() if now is None else now
    cells, entries = [], {}
    for c in columns:
        t, twelve = F.col(f"_t_{c}"), F.col(c).rlike("(?i)AM|PM")
        parts = {"min_value": F.min(t), "max_value": F.max(t), "with_ampm": count_if(twelve),
                 "without_ampm": count_if(~twelve),
                 "failed_to_parse": count_if(t.isNull() & F.col(c).isNotNull()),
                 "future_rows": count_if(t > now)}
        cells += [v.alias(f"{c}.{k}") for k, v in parts.items()]
        entries[c] = {k: F.col(f"`{c}.{k}`") for k in parts}
    return _unpivot(parsed.agg(*cells), entries, "column_name")


def yearly_coverage(df: DataFrame) -> DataFrame:
    return (df.select(F.year(parse_mixed(F.col("CRASH_DATE"))).alias("year")).where("year IS NOT NULL")
            .groupBy("year").agg(F.count("*").alias("n_rows")))


def district_coverage(df: DataFrame, cutoff: str = COVERAGE_CUTOFF) -> DataFrame:
    """First date per district (beat // 100) and whether it is before the cutoff."""
    district = F.floor(to_double(F.col("BEAT_OF_OCCURRENCE")) / 100).cast("int")
    return (df.select(district.alias("district"), parse_mixed(F.col("CRASH_DATE")).alias("_t"))
            .where("district IS NOT NULL AND _t IS NOT NULL").groupBy("district")
            .agg(F.min("_t").alias("first_date"))
            .withColumn("before_cutoff", F.col("first_date") < F.lit(cutoff).cast("timestamp")))


def district_summary(df: DataFrame, cutoff: str = COVERAGE_CUTOFF) -> DataFrame:
    missing = df.agg(count_if(F.col("BEAT_OF_OCCURRENCE").isNull()).alias("rows_missing_beat"))
    found = district_coverage(df, cutoff).agg(
        F.count("*").alias("n_districts"), count_if(F.col("before_cutoff")).alias("n_before_cutoff"),
        F.min("first_date").alias("earliest"))
    return missing.join(F.broadcast(found))


def date_logic(df: DataFrame) -> DataFrame:
    """Rows notified before the crash, and the longest delay in days."""
    t = df.select(parse_mixed(F.col(DATES[0])).alias("c"), parse_mixed(F.col(DATES[1])).alias("p"))
    gap = F.unix_micros("p") - F.unix_micros("c")
    return t.agg(count_if(F.col("p") < F.col("c")).alias("rows_notified_before_crash"),
                 (F.max(gap) / F.lit(86_400_000_000)).alias("max_gap_days"))


def coordinate_report(df: DataFrame, box: dict = CHICAGO.bounding_box) -> DataFrame:
    """Missing and zero coordinates (a zero in either is bad here) and those outside the box."""
    lat, lon = to_double(F.col("LATITUDE")), to_double(F.col("LONGITUDE"))
    d = df.select(lat.alias("lat"), lon.alias("lon"))
    both = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    zero = both & ((F.col("lat") == 0) | (F.col("lon") == 0))
    valid = both & (F.col("lat") != 0) & (F.col("lon") != 0)
    inside = F.col("lat").between(*box["latitude"]) & F.col("lon").between(*box["longitude"])
    return d.agg(F.count("*").alias("_n"), count_if(~both).alias("rows_missing"),
                 count_if(zero).alias("rows_zero"), count_if(valid & ~inside).alias("rows_outside_box"),
                 *[getattr(F, how)(F.when(valid, F.col(axis))).alias(f"{how}_{axis}")
                   for axis in ("lat", "lon") for how in ("min", "max")]) \
        .withColumn("pct_missing", percent(F.col("rows_missing"), F.col("_n"), 2)).drop("_n")


def speed_report(df: DataFrame) -> DataFrame:
    v = to_double(F.col("POSTED_SPEED_LIMIT"))
    return df.select(v.alias("v")).agg(
        F.min("v").alias("min_speed"), F.max("v").alias("max_speed"),
        count_if((F.col("v") < SPEED_BAND[0]) | (F.col("v") > SPEED_BAND[1])).alias("rows_outside_band"))


def speed_histogram(df: DataFrame) -> DataFrame:
    return (df.select(to_double(F.col("POSTED_SPEED_LIMIT")).alias("speed")).where("speed IS NOT NULL")
            .groupBy("speed").agg(F.count("*").alias("n_rows")))


def category_report(df: DataFrame, columns: list[str] = CATEGORIES, top: int = 15) -> DataFrame:
    """The most frequent values per column, null counted as a value.

    Values are counted before anything is ranked, and the rank limit is applied
    in the map tasks, so a column of very many values does not pile up.
    """
    columns = [c for c in columns if c in df.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                         F.col(c).cast("string").alias("value")) for c in columns]))
    counted = (df.select(pairs.alias("p")).select("p.*").groupBy("column_name", "value")
               .agg(F.count("*").alias("n_rows")))
    w = W.partitionBy("column_name").orderBy(F.desc("n_rows"), F.col("value").asc_nulls_last())
    return counted.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= top).drop("_rank")


def injury_report(df: DataFrame) -> DataFrame:
    """Sum of every INJURIES_ column, fatal rows, rows without any injury data."""
    columns = [c for c in df.columns if c.startswith("INJURIES_")]
    sums = {c: F.coalesce(F.sum(to_double(F.col(c))), F.lit(0.0)) for c in columns}
    more = {}
    if "INJURIES_FATAL" in columns:
        more["fatal_rows"] = count_if(to_double(F.col("INJURIES_FATAL")) > 0)
    if {"INJURIES_TOTAL", "MOST_SEVERE_INJURY"} <= set(df.columns):
        more["rows_without_injury_data"] = count_if(
            F.col("INJURIES_TOTAL").isNull() & F.col("MOST_SEVERE_INJURY").isNull())
    every = {**sums, **more}
    counted = df.agg(*[c.alias(k) for k, c in every.items()])
    return _unpivot(counted, {k: {"value": F.col(k).cast("double")} for k in every}, "measure")


# -- the whole report ------------------------------------------------------------------

_CELLS = "section string, entry string, measure string, number double, text string, time timestamp"
SECTIONS = ("schema", "missingness", "near_empty", "duplicates", "dates", "date_logic", "yearly_coverage", "district_coverage",
            "district_summary", "coordinates", "speed_limit", "speed_histogram", "injuries", "top_categories")


def _cell(section: str, entry: Column | str, measure: str, number: Column | None = None, text: Column | None = None,
          time: Column | None = None) -> Column:
    entry = F.lit(entry) if isinstance(entry, str) else entry
    return F.struct(F.lit(section).alias("section"), entry.alias("entry"), F.lit(measure).alias("measure"),
                    (F.lit(None) if number is None else number).cast("double").alias("number"),
                    (F.lit(None) if text is None else text).cast("string").alias("text"),
                    (F.lit(None) if time is None else time).cast("timestamp").alias("time"))


def _as_rows(cells: list[Column], of: DataFrame) -> DataFrame:
    return of.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _single_values(df: DataFrame, now: Column, threshold: float, box: dict, expected: list[str]) -> DataFrame:
    """All cells that are one value for the table: one wide aggregation, one scan."""
    columns, lat, lon = df.columns, F.col("_lat"), F.col("_lon")
    read = df.withColumns({"_crash": parse_mixed(F.col(DATES[0])), "_told": parse_mixed(F.col(DATES[1])),
                           "_lat": to_double(F.col("LATITUDE")), "_lon": to_double(F.col("LONGITUDE")),
                           "_speed": to_double(F.col("POSTED_SPEED_LIMIT"))})
    both = lat.isNotNull() & lon.isNotNull()
    valid = both & (lat != 0) & (lon != 0)
    inside = lat.between(*box["latitude"]) & lon.between(*box["longitude"])
    injuries = [c for c in columns if c.startswith("INJURIES_")]
    wanted: dict[str, Column] = {"n": F.count(F.lit(1))}
    wanted |= {f"null.{c}": count_if(F.col(c).isNull()) for c in columns}
    for c, t in zip(DATES, ("_crash", "_told")):
        twelve = F.col(c).rlike("(?i)AM|PM")
        wanted |= {f"{c}.min_value": F.min(t), f"{c}.max_value": F.max(t), f"{c}.with_ampm": count_if(twelve),
                   f"{c}.without_ampm": count_if(~twelve),
                   f"{c}.failed_to_parse": count_if(F.col(t).isNull() & F.col(c).isNotNull()),
                   f"{c}.future_rows": count_if(F.col(t) > now)}
    gap = F.unix_micros("_told") - F.unix_micros("_crash")
    logic = {"rows_notified_before_crash": count_if(F.col("_told") < F.col("_crash")),
             "max_gap_days": F.max(gap) / F.lit(86_400_000_000)}
    places = {"rows_missing": count_if(~both), "rows_zero": count_if(both & ((lat == 0) | (lon == 0))),
              "rows_outside_box": count_if(valid & ~inside)}
    places |= {f"{how}_{a[1:]}": getattr(F, how)(F.when(valid, F.col(a))) for a in ("_lat", "_lon") for how in ("min", "max")}
    speeds = {"min_speed": F.min("_speed"), "max_speed": F.max("_speed"),
              "rows_outside_band": count_if((F.col("_speed") < SPEED_BAND[0]) | (F.col("_speed") > SPEED_BAND[1]))}
    hurt = {c: F.coalesce(F.sum(to_double(F.col(c))), F.lit(0.0)) for c in injuries}
    if "INJURIES_FATAL" in columns:
        hurt["fatal_rows"] = count_if(to_double(F.col("INJURIES_FATAL")) > 0)
    if {"INJURIES_TOTAL", "MOST_SEVERE_INJURY"} <= set(columns):
        hurt["rows_without_injury_data"] = count_if(F.col("INJURIES_TOTAL").isNull() & F.col("MOST_SEVERE_INJURY").isNull())
    told = {"date_logic": logic, "coordinates": places, "speed_limit": speeds, "injuries": hurt}
    wanted |= {f"{section}.{k}": v for section, parts in told.items() for k, v in parts.items()}
    one = read.agg(*[v.alias(k) for k, v in wanted.items()])

    def got(name: str) -> Column:
        return F.col(f"`{name}`")
    cells = [_cell("schema", "table", "n_rows", got("n")), _cell("schema", "table", "n_columns", F.lit(len(columns)))]
    types = dict(df.dtypes)
    for c in sorted(set(expected) | set(columns)):
        status = "missing" if c not in types else "ok" if c in expected else "extra"
        cells += [_cell("schema", c, "data_type", text=F.lit(types.get(c))), _cell("schema", c, "status", text=F.lit(status))]
    for c in columns:
        empty = got(f"null.{c}")
        cells += [_cell("missingness", c, "kind", text=F.lit("yes_only_flag" if c in YES_ONLY else "ordinary")),
                  _cell("missingness", c, "null_count", empty), _cell("missingness", c, "pct_null", percent(empty, got("n"), 2)),
                  _cell("near_empty", c, "near_empty", (empty * 100 >= F.lit(threshold) * got("n")).cast("int"))]
    for c in DATES:
        cells += [_cell("dates", c, m, time=got(f"{c}.{m}")) for m in ("min_value", "max_value")]
        cells += [_cell("dates", c, m, got(f"{c}.{m}")) for m in ("with_ampm", "without_ampm", "failed_to_parse", "future_rows")]
    cells += [_cell(section, "all", k, got(f"{section}.{k}")) for section, parts in told.items() for k in parts]
    cells += [_cell("coordinates", "all", "pct_missing", percent(got("coordinates.rows_missing"), got("n"), 2)),
              _cell("district_summary", "all", "rows_missing_beat", got("null.BEAT_OF_OCCURRENCE"))]
    return _as_rows(cells, one).where("section <> 'near_empty' OR number = 1")


def _grouped_values(df: DataFrame, cutoff: str, categories: list[str], top: int) -> DataFrame:
    """All sections with a row for each value: the groupings side by side, one scan and one shuffle of counts."""
    t = parse_mixed(F.col(DATES[0]))
    district = F.floor(to_double(F.col("BEAT_OF_OCCURRENCE")) / 100).cast("int").cast("string")
    speed = to_double(F.col("POSTED_SPEED_LIMIT")).cast("string")

    def value(section: str, entry: Column, text: Column, at: Column, counts: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), entry.alias("entry"), text.alias("text"), at.alias("time"), counts.alias("counts"))
    none, no_time = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    values = [value("yearly_coverage", F.year("_t").cast("string"), none, no_time, F.col("_t").isNotNull()),
              value("district_coverage", district, none, F.col("_t"), district.isNotNull() & F.col("_t").isNotNull()),
              value("speed_histogram", speed, none, no_time, speed.isNotNull())]
    values += [value("top_categories", F.lit(c), F.col(c).cast("string"), no_time, F.lit(True)) for c in categories if c in df.columns]
    counted = (df.withColumn("_t", t).select(F.explode(F.array(*values)).alias("v")).where("v.counts")
               .groupBy("v.section", "v.entry", "v.text").agg(F.count(F.lit(1)).alias("n_rows"), F.min("v.time").alias("first")))
    counted = saved(counted, "profile-values")  # a row for each value: read three times
    early = F.col("first") < F.lit(cutoff).cast("timestamp")
    rank = W.partitionBy("section", "entry").orderBy(F.desc("n_rows"), F.col("text").asc_nulls_last())
    frequent = (counted.where("section = 'top_categories'").withColumn("_rank", F.row_number().over(rank))
                .where(F.col("_rank") <= top))
    kinds = {k: f.alias(k) for k, f in (("number", F.col("n_rows").cast("double")), ("text", F.col("text")), ("time", no_time))}
    plain = counted.where("section IN ('yearly_coverage', 'speed_histogram')").unionByName(frequent.drop("_rank")).select(
        "section", "entry", F.lit("n_rows").alias("measure"), *kinds.values())
    districts = counted.where("section = 'district_coverage'")
    covered = districts.select(F.explode(F.array(
        _cell("district_coverage", F.col("entry"), "first_date", time=F.col("first")),
        _cell("district_coverage", F.col("entry"), "before_cutoff", early.cast("int")))).alias("c")).select("c.*")
    summed = districts.agg(F.count(F.lit(1)).alias("n"), count_if(early).alias("early"), F.min("first").alias("earliest"))
    told = _as_rows([_cell("district_summary", "all", "n_districts", F.col("n")), _cell("district_summary", "all", "n_before_cutoff", F.col("early")),
                     _cell("district_summary", "all", "earliest", time=F.col("earliest"))], summed)
    return plain.unionByName(covered).unionByName(told)


def build_report(df: DataFrame, now: Column | None = None, cutoff: str = COVERAGE_CUTOFF, threshold: float = 95.0,
                 key: str = "CRASH_RECORD_ID", box: dict = CHICAGO.bounding_box, expected: list[str] = EXPECTED,
                 categories: list[str] = CATEGORIES, top: int = 15) -> DataFrame:
    """All sections as rows (section, entry, measure, number, text, time); of the last three the one that fits is filled.

    Five scans whatever the number of columns and sections: the single values, the values by group, and the copies (digests of
    rows, then the rows whose digests meet, by row and by key). Category rows carry the value in ``text``.
    """
    now = F.current_timestamp() if now is None else now
    copies = duplicate_report(df, key).select(
        F.lit("duplicates").alias("section"), F.col("kind").alias("entry"), F.lit("extra_rows").alias("measure"),
        F.col("extra_rows").cast("double").alias("number"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("timestamp").alias("time"))
    return (_single_values(df, now, threshold, box, expected)
            .unionByName(_grouped_values(df, cutoff, categories, top)).unionByName(copies))


def write_report(df: DataFrame, path: str, **told) -> None:
    """The report as JSON lines, a folder for each section."""
    build_report(df, **told).repartition("section").write.mode("overwrite").partitionBy("section").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_CELLS).json(path).select("section", "entry", "measure", "number", "text", "time")
