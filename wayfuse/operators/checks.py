"""Checks on staged rows: one result row per batch and check.

All row-level rules of a batch are counted in one aggregation grouped by source
and batch; keys and the source dimension each add one more. Nothing here brings
rows to the driver: a result is a small DataFrame.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfuse.functions.scalars import count_if, to_double, total
from wayfuse.operators.curate import TIME_COLUMNS
from wayfuse.functions.timeparse import by_source, parse_local
from wayfuse.session import in_rounds, rounds_for, saved
from wayfuse.sources.text import latest_per_key
from wayfuse.spec import (ACCEPTED_VALUES, ADAPTERS, CANONICAL_FIELDS, DATE_LOGIC_TOLERANCE,
                          DQ_LOG_SCHEMA, NON_NULLABLE, NUMERIC_RANGES, SPEED_BAND,
                          STRUCTURAL_GAPS)

BATCH = ["source_id", "batch_id"]
RESULT = ["source_id", "batch_id", "check_name", "status", "rows_checked", "rows_failed", "details"]


def result(check: str, status: Column, checked: Column, failed: Column, details: Column) -> Column:
    return F.struct(F.lit(check).alias("check_name"), status.alias("status"),
                    checked.cast("long").alias("rows_checked"),
                    failed.cast("long").alias("rows_failed"), details.alias("details"))


def pass_or(fail: Column, warn: Column | None = None) -> Column:
    out = F.when(fail, "fail")
    if warn is not None:
        out = out.when(warn, "warn")
    return out.otherwise("pass")


def _source_case(values: dict, other) -> Column:
    out = None
    for source_id, value in values.items():
        match = F.col("source_id") == source_id
        out = F.when(match, F.lit(value)) if out is None else out.when(match, F.lit(value))
    return out.otherwise(F.lit(other))


def named_counts(pairs: list[tuple[str, Column]]) -> Column:
    """'a=3, b=1' of the counts above zero."""
    return F.concat_ws(", ", *[F.when(n > 0, F.concat(F.lit(f"{name}="), n)) for name, n in pairs])


# -- the counters of the single pass ----------------------------------------

def _enforced(column: str) -> Column:
    gap_sources = [s for s, gaps in STRUCTURAL_GAPS.items() if column in gaps]
    if not gap_sources:
        return F.lit(True)
    return F.coalesce(~F.col("source_id").isin(*gap_sources), F.lit(True))


def nullability_counters(columns: list[str]) -> dict[str, Column]:
    return {f"null_{c}": count_if(F.col(c).isNull() & _enforced(c))
            for c in NON_NULLABLE if c in columns}


def accepted_counters(columns: list[str]) -> dict[str, Column]:
    return {f"bad_{c}": count_if(F.col(c).isNotNull() & ~F.col(c).isin(*allowed))
            for c, allowed in ACCEPTED_VALUES.items() if c in columns}


def range_counters(columns: list[str], adapters: dict = ADAPTERS) -> dict[str, Column]:
    out = {}
    for c, (low, high) in NUMERIC_RANGES.items():
        if c in columns:
            v = to_double(F.col(c))
            bad = v < low
            if high is not None:
                bad = bad | (v > high)
            out[f"range_{c}"] = count_if(bad)
    if "posted_speed_limit_mph" in columns:
        v = to_double(F.col("posted_speed_limit_mph"))
        out["soft_speed"] = count_if((v < SPEED_BAND[0]) | (v > SPEED_BAND[1]))
    if {"latitude", "longitude"} <= set(columns):
        for axis in ("latitude", "longitude"):
            v = to_double(F.col(axis))
            outside = by_source(
                lambda a: (v < a.bounding_box[axis][0]) | (v > a.bounding_box[axis][1]),
                adapters.values(), F.lit(False))
            out[f"range_{axis}_out_of_bbox"] = count_if(outside)
    return out


def _wall_clock(column: str, adapters: dict) -> Column:
    return by_source(lambda a: parse_local(F.col(column), a.timestamp_layout),
                     adapters.values(), parse_local(F.col(column), "iso"))


def date_logic_counters(columns: list[str]) -> dict[str, Column]:
    if not set(TIME_COLUMNS) <= set(columns):
        return {}
    return {"dates_both": F.count(F.when(F.col("_police").isNotNull(), F.col("_crash"))),
            "dates_inverted": count_if(F.col("_police") < F.col("_crash"))}


def batch_counters(staged: DataFrame, only: tuple[str, ...], adapters: dict = ADAPTERS) -> DataFrame:
    """One row per source and batch with the row-level counters of the named checks: one scan."""
    columns = staged.columns
    counters = {"n": F.count("*")}
    for check, build in (("nullability_check", nullability_counters), ("accepted_values_check", accepted_counters),
                         ("range_check", lambda c: range_counters(c, adapters))):
        if check in only:
            counters.update(build(columns))
    dates = date_logic_counters(columns) if "date_logic_check" in only else {}
    if dates:
        # a crash time is only looked at beside a police time, so the others are not parsed
        both = F.col(TIME_COLUMNS[1]).isNotNull()
        staged = staged.withColumns({"_crash": F.when(both, _wall_clock(TIME_COLUMNS[0], adapters)),
                                     "_police": F.when(both, _wall_clock(TIME_COLUMNS[1], adapters))})
    counters.update(dates)
    return staged.groupBy(*BATCH).agg(*[c.alias(k) for k, c in counters.items()])


def duplicate_counts(df: DataFrame, group: list[str], keys: dict[str, list[str]]) -> DataFrame:
    """Extra copies per key set (nulls equal), by one grouped count for each key set.

    Copies are counted before the shuffle, so a key with very many copies sends
    one row per task. The keys of a large table are counted in rounds, each written before the next.
    """
    out = None
    rounds = rounds_for(df)
    for name, cols in keys.items():
        by = list(dict.fromkeys([*group, *cols]))
        counted = [part.groupBy(*by).agg(F.count("*").alias("_copies"))
                   .groupBy(*group).agg(F.sum(F.col("_copies") - 1).cast("long").alias(name)) for part in in_rounds(df, cols[-1], rounds)]
        extra = counted[0]
        if rounds > 1:
            extra = (reduce(DataFrame.unionByName, [saved(part, "copies") for part in counted])
                     .groupBy(*group).agg(F.sum(name).alias(name)))
        # one row per group
        out = extra if out is None else out.join(F.broadcast(extra), [out[g].eqNullSafe(extra[g]) for g in group]).select(
            *[out[c] for c in out.columns], extra[name])
    return out


# -- the checks as rows ------------------------------------------------------

def _sum(names: list[str]) -> Column:
    return total([F.col(n) for n in names]) if names else F.lit(0)


def schema_result(columns: list[str]) -> Column:
    missing = sorted(set(CANONICAL_FIELDS) - set(columns))
    n = F.col("n")
    if missing:
        return result("schema_check", F.lit("fail"), n, n,
                      F.lit(f"columns absent: {', '.join(missing)}"))
    return result("schema_check", F.lit("pass"), n, F.lit(0),
                  F.lit(f"{len(CANONICAL_FIELDS)} of {len(CANONICAL_FIELDS)} columns there"))


def nullability_result(columns: list[str]) -> Column:
    names = [k for k in nullability_counters(columns)]
    bad = _sum(names)
    shown = named_counts([(k[5:], F.col(k)) for k in names])
    enforced = _source_case({s: len(set(NON_NULLABLE) - g) for s, g in STRUCTURAL_GAPS.items()},
                            len(NON_NULLABLE))
    details = (F.when(bad > 0, F.concat(F.lit("empty where a value is required: "), shown))
               .otherwise(F.concat(enforced, F.lit(" required columns are filled"))))
    return result("nullability_check", pass_or(bad > 0), F.col("n"), bad, details)


def uniqueness_result() -> Column:
    r, c = F.col("dup_record"), F.col("dup_crash")
    details = (F.when(r + c > 0, F.concat(F.lit("surplus copies by source_record_id="), r,
                                          F.lit(", by crash_id="), c))
               .otherwise("each key occurs once"))
    return result("uniqueness_check", pass_or(r + c > 0), F.col("n"), r + c, details)


def accepted_result(columns: list[str]) -> Column:
    names = list(accepted_counters(columns))
    bad = _sum(names)
    shown = F.concat_ws(", ", *[
        F.when(F.col(k) > 0, F.concat(F.lit(k[4:] + "="), F.col(k), F.lit(" ["),
                                      F.coalesce(F.col(f"sample_{k[4:]}"), F.lit("")), F.lit("]")))
        for k in names])
    details = (F.when(bad > 0, F.concat(F.lit("unlisted values: "), shown))
               .otherwise("only listed values occur"))
    return result("accepted_values_check", pass_or(bad > 0), F.col("n"), bad, details)


def accepted_samples(staged: DataFrame, limit: int = 5) -> DataFrame:
    """Up to five bad values per column and batch; the limit acts before the shuffle."""
    columns = [c for c in ACCEPTED_VALUES if c in staged.columns]
    unlisted = {c: ~F.col(c).isin(*ACCEPTED_VALUES[c]) for c in columns}
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.when(unlisted[c], F.col(c)).alias("value")) for c in columns]))
    w = W.partitionBy(*BATCH, "column").orderBy("value")
    bad = (staged.where(reduce(or_, unlisted.values())).select(*BATCH, pairs.alias("p")).select(*BATCH, "p.column", "p.value")
           .where(F.col("value").isNotNull()).distinct()
           .withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit))
    return bad.groupBy(*BATCH).agg(*[
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("column") == c, F.col("value")))), ", ")
         .alias(f"sample_{c}") for c in columns])


def range_result(columns: list[str]) -> Column:
    hard = [k for k in range_counters(columns) if k.startswith("range_")]
    bad = _sum(hard)
    soft = F.col("soft_speed") if "posted_speed_limit_mph" in columns else F.lit(0)
    details = (F.when(bad > 0, F.concat(F.lit("beyond the limits: "),
                                        named_counts([(k[6:], F.col(k)) for k in hard])))
               .when(soft > 0, F.concat(F.lit("unusual posted_speed_limit_mph="), soft))
               .otherwise("every number is within its limits"))
    return result("range_check", pass_or(bad > 0, soft > 0), F.col("n"),
                  F.when(bad > 0, bad).otherwise(soft), details)


def date_logic_result(columns: list[str]) -> Column:
    if not set(TIME_COLUMNS) <= set(columns):
        return result("date_logic_check", F.lit("warn"), F.col("n"), F.lit(0),
                      F.lit("needs both time columns"))
    gap = F.col("source_id").isin(*[s for s, g in STRUCTURAL_GAPS.items() if TIME_COLUMNS[1] in g])
    allowed = _source_case(DATE_LOGIC_TOLERANCE, 0)
    n = F.when(gap, F.lit(0)).otherwise(F.col("dates_inverted"))
    details = (F.when(gap, "Skipped: this source has no police time (structural gap)")
               .when(n > 0, F.concat(n, F.lit(" rows with the police time ahead of the crash, up to "),
                                     allowed, F.lit(" allowed")))
               .otherwise(F.concat(F.lit("times in order in "), F.col("dates_both"),
                                   F.lit(" rows that have both"))))
    return result("date_logic_check", pass_or(n > allowed, n > 0), F.col("n"), n, details)


def referential_result(named: bool = True) -> Column:
    """``named``: the rows have a source at all; without one they all fail."""
    unknown = F.col("_known").isNull() & F.col("source_id").isNotNull() if named else F.lit(True)
    details = (F.when(unknown, F.concat(F.lit("unknown source: "), F.coalesce("source_id", F.lit("none given"))))
               .otherwise(F.concat(F.lit("source found in the dimension: "),
                                   F.coalesce("source_id", F.lit("")))))
    return result("referential_check", pass_or(unknown), F.col("n"),
                  F.when(unknown, F.col("n")).otherwise(0), details)


def row_count_result() -> Column:
    n, raw = F.col("n"), F.col("raw_total")
    over = F.coalesce(n > raw, F.lit(False)) & (raw != 0)
    details = F.concat(n, F.lit(" rows staged"),
                       F.when(raw != 0, F.concat(F.lit(", "), raw, F.lit(" in the manifest"))).otherwise(""),
                       F.when(over, ", which is fewer").otherwise(""))
    details = F.when(n == 0, "nothing was staged").otherwise(details)
    return result("row_count_check", pass_or(n == 0, over), n, F.lit(0), details)


def expected_zero_rows(counters: DataFrame, batches: DataFrame | None) -> DataFrame:
    """A batch that was announced but staged no rows still gets its results."""
    if batches is None:
        return counters
    out = batches.select(*BATCH).join(counters, BATCH, "left")
    numeric = [c for c, t in counters.dtypes if c not in BATCH and t in ("bigint", "int")]
    return out.na.fill(0, numeric)


CHECKS = ("schema_check", "nullability_check", "uniqueness_check", "accepted_values_check", "range_check",
          "date_logic_check", "referential_check", "row_count_check")


def _built(wide: DataFrame, check: str, build) -> Column:
    """The check's result; one that cannot be resolved fails by itself and leaves the others alone."""
    try:
        out = build()
        wide.select(out)
        return out
    except AnalysisException as e:
        return result(check, F.lit("fail"), F.col("n"), F.col("n"), F.lit(f"Check raised: {str(e)[:200]}"))


def run_checks(staged: DataFrame, dim_source: DataFrame, totals: DataFrame | None = None,
               batches: DataFrame | None = None, only: tuple[str, ...] = CHECKS,
               adapters: dict = ADAPTERS) -> DataFrame:
    """The checks of every batch in ``staged``, all eight or those named, one row each.

    ``totals`` (source_id, batch_id, total_records_or_files) is the raw manifest;
    ``batches`` the batches that should be there. An absent column fails the checks that
    need it; the rest report as usual. ``adapters`` hold each source's layout and bounds. A check that is not asked for costs no pass.
    """
    columns = staged.columns
    for c in BATCH:
        if c not in columns:
            staged = staged.withColumn(c, F.lit(None).cast("string"))
    wide = expected_zero_rows(batch_counters(staged, only, adapters), batches)

    def with_rows(part):  # one row per batch
        match = [wide[c].eqNullSafe(part[c]) for c in BATCH]
        return wide.join(F.broadcast(part), match, "left").select(
            *[wide[c] for c in wide.columns], *[part[c] for c in part.columns if c not in BATCH])

    keyed = {"source_record_id", "crash_id"} <= set(columns)
    if "uniqueness_check" in only and keyed:
        wide = with_rows(duplicate_counts(staged, BATCH, {"dup_record": ["source_record_id"],
                                                          "dup_crash": ["crash_id"]})).na.fill(0, ["dup_record", "dup_crash"])
    if "accepted_values_check" in only and any(c in columns for c in ACCEPTED_VALUES):
        wide = with_rows(accepted_samples(staged))
    if "referential_check" in only:
        known = dim_source.select("source_id").distinct().withColumn("_known", F.lit(True))
        wide = wide.join(F.broadcast(known), "source_id", "left")
    if totals is None:
        wide = wide.withColumn("raw_total", F.lit(None).cast("long"))
    else:
        wide = with_rows(totals.select(*BATCH, F.col("total_records_or_files").alias("raw_total")))
    absent = result("uniqueness_check", F.lit("fail"), F.col("n"), F.col("n"), F.lit("a key column is absent"))
    builders = {"schema_check": lambda: schema_result(columns), "nullability_check": lambda: nullability_result(columns),
                "uniqueness_check": lambda: uniqueness_result() if keyed else absent,
                "accepted_values_check": lambda: accepted_result(columns), "range_check": lambda: range_result(columns),
                "date_logic_check": lambda: date_logic_result(columns),
                "referential_check": lambda: referential_result("source_id" in columns),
                "row_count_check": row_count_result}
    results = F.array(*[_built(wide, name, builders[name]) for name in CHECKS if name in only])
    return wide.select(*BATCH, F.explode(results).alias("r")).select(*BATCH, "r.*")


def log_rows(results: DataFrame, run_timestamp: Column | None = None) -> DataFrame:
    """Results in the log schema, details cut to 1000 characters."""
    now = F.current_timestamp() if run_timestamp is None else run_timestamp
    return (results.withColumns({"details": F.substring("details", 1, 1000), "run_timestamp": now})
            .select(*DQ_LOG_SCHEMA.fieldNames()))


def append_log(results: DataFrame, root: str, run_timestamp: Column | None = None) -> None:
    log_rows(results, run_timestamp).repartition(1).write.mode("append").parquet(root)


def require_passed(results: DataFrame) -> None:
    """Raise with every failed check; results are a few rows per batch."""
    failed = results.where("status = 'fail'").select("check_name", "source_id", "details").collect()
    if failed:
        raise RuntimeError(f"{len(failed)} check(s) failed: " + "; ".join(
            f"{r.check_name} ({r.source_id or 'all sources'}): {r.details}" for r in failed))


def table_constraints(fact: DataFrame, dim_source: DataFrame, dim_date: DataFrame,
                      log: DataFrame | None = None) -> DataFrame:
    """Violations of the fact table's contract, one row per constraint."""
    required = ["crash_id", "source_id", "source_record_id", "crash_timestamp_utc", "crash_date_key",
                "country", "has_valid_coordinates", "severity", "hit_and_run", "batch_id"]
    rules = {f"not_null_{c}": count_if(F.col(c).isNull()) for c in required}
    rules["severity_values"] = count_if(~F.col("severity").isin(*ACCEPTED_VALUES["severity"]))
    rules["country_length"] = count_if(F.length("country") != 2)
    for c in ("num_injured_total", "num_killed", "num_vehicles_involved"):
        rules[f"non_negative_{c}"] = count_if(F.col(c) < 0)
    counted = fact.agg(F.count("*").alias("n"), *[c.alias(k) for k, c in rules.items()])
    keys = duplicate_counts(fact.withColumn("_all", F.lit(1)), ["_all"], {
        "primary_key_crash_id": ["crash_id"],
        "unique_natural_key": ["source_id", "source_record_id"]}).drop("_all")
    no_source = (fact.join(F.broadcast(dim_source.select("source_id")), "source_id", "left_anti")
                 .where(F.col("source_id").isNotNull()).agg(F.count("*").alias("foreign_key_dim_source")))
    no_date = (fact.where(F.col("crash_date_key").isNotNull())
               .groupBy("crash_date_key").agg(F.count("*").alias("rows"))
               .join(dim_date.select(F.col("date_key").alias("crash_date_key")), "crash_date_key", "left_anti")
               .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("foreign_key_dim_date")))
    wide = counted
    for part in (keys, no_source, no_date):
        wide = wide.join(F.broadcast(part))
    names = [*rules, "primary_key_crash_id", "unique_natural_key", "foreign_key_dim_source",
             "foreign_key_dim_date"]
    out = wide.select("n", *names)
    if log is not None:
        bad = log.agg(count_if(~F.col("status").isin("pass", "fail", "warn")).alias("log_status_values"))
        out = out.join(F.broadcast(bad))
        names.append("log_status_values")
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("constraint_name"),
                                        F.coalesce(F.col(k), F.lit(0)).cast("long").alias("rows_failed")) for k in names]))
    return out.select("n", rows.alias("r")).select(
        "r.constraint_name", F.when(F.col("r.rows_failed") > 0, "fail").otherwise("pass").alias("status"),
        F.col("n").alias("rows_checked"), "r.rows_failed")


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DQ_LOG_SCHEMA)


def latest_results(log: DataFrame) -> DataFrame:
    return latest_per_key(log, ["source_id", "check_name"], [F.desc("run_timestamp")])
