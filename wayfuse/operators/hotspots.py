"""Density clustering of coordinates on the sphere, as joins on grid cells.

The result is that of DBSCAN with the haversine metric. Nothing compares all
points of a neighbourhood with each other:

* points at one coordinate become one weighted site;
* a cell is so small that all its sites are neighbours, so a cell that holds
  ``min_samples`` points needs no distances at all, and core sites of a cell
  are connected without looking at pairs;
* a site meets at most 25 cells; a cell wholly inside or outside its radius is
  decided by its bounding box, only cells the circle cuts are looked at in finer
  tiles, and only tiles the circle cuts in single sites.

So the number of rows is set by the number of sites and by the geometry, not by
the square of the number of points in a crowded place.

All of this holds on the whole sphere: longitudes are taken modulo a full turn, a circle that holds a pole reaches all
columns of the rows it meets, and the gap between two boxes is the shorter way round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfuse.functions.scalars import count_if, percent, round_half_up
from wayfuse.operators.components import components
from wayfuse.operators.frames import frame_windows, in_frames
from wayfuse.operators.ranking import ranked
from wayfuse.session import saved
from wayfuse.spec import (AREA_KM2, DENSITY_RATIO, EARTH_RADIUS_M, EPS_METERS, MIN_SAMPLES_FLOOR,
                          STABILITY_FRACTION, STABILITY_SEEDS)

CELL = ["g", "row", "col"]
SITE = ["g", "lat", "lon"]
LEVELS = [8, 64]          # tiles per cell side, coarse to fine
BOX = {"lat0": ("min", "lat"), "lat1": ("max", "lat"), "lon0": ("min", "lon"), "lon1": ("max", "lon")}


# -- geometry, all in radians ------------------------------------------------

def _half_chord(eps: float) -> float:
    return math.sin(min(eps / EARTH_RADIUS_M, math.pi) / 2)


def _side(eps: float) -> float:
    """Height of a row: the diagonal of its cells, as a chord, is below that of ``eps``."""
    return _half_chord(eps) * math.sqrt(2) * (1 - 1e-9)


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """``lat`` and ``lon`` in radians; one place has one pair: longitudes from -pi to below pi, 0 at the poles."""
    phi, turned = F.radians(lat), F.radians(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0)
    # inside the usual range nothing is added and taken away again: the value stays as it was read
    plain = F.when((F.col(lon) >= -180) & (F.col(lon) < 180), F.radians(lon)).otherwise(turned)
    return df.withColumns({"lat": phi, "lon": F.when(F.abs(F.col(lat)) >= 90, F.lit(0.0)).otherwise(plain)})


def _width(row: Column, side: float) -> Column:
    """Longitude width of the cells in a row, from its edge nearest the equator."""
    edge = F.abs(F.when(row >= 0, row).otherwise(row + 1)) * F.lit(side)
    return F.lit(side) / F.cos(edge)


def _half_sine(d: Column) -> Column:
    s = F.sin(d / 2)
    return s * s


def haversine(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Squared half chord; grows with the distance, so it can stand for it."""
    return _half_sine(lat_a - lat_b) + F.cos(lat_a) * F.cos(lat_b) * _half_sine(lon_a - lon_b)


def _limit(eps: float) -> Column:
    return F.lit(_half_chord(eps) ** 2)


def _box(prefix: str) -> tuple[Column, ...]:
    return tuple(F.col(prefix + k) for k in BOX)


def _gap_lon(a: tuple, b: tuple) -> Column:
    """Smallest difference in longitude as numbers, the long way round or not."""
    return F.greatest(F.lit(0.0), b[2] - a[3], a[2] - b[3])


def _nearest(a: tuple, b: tuple) -> Column:
    """Not above the smallest haversine between two boxes."""
    gap_lat = F.greatest(F.lit(0.0), b[0] - a[1], a[0] - b[1])
    round_ = F.lit(2 * math.pi) - (F.greatest(a[3], b[3]) - F.least(a[2], b[2]))
    gap_lon = F.least(_gap_lon(a, b), F.greatest(F.lit(0.0), round_))
    pole = F.greatest(*[F.abs(x) for x in (a[0], a[1], b[0], b[1])])
    return (_half_sine(gap_lat) + F.cos(pole) * F.cos(pole) * _half_sine(gap_lon)) * (1 - 1e-9)


def _farthest(a: tuple, b: tuple) -> Column:
    """Not below the largest haversine between two boxes."""
    span_lat = F.greatest(b[1] - a[0], a[1] - b[0])
    span, gap = F.greatest(b[3] - a[2], a[3] - b[2]), _gap_lon(a, b)
    # the difference runs from gap to span; half a turn is the farthest
    span_lon = F.when(span <= math.pi, span).when(gap >= math.pi, F.lit(2 * math.pi) - gap).otherwise(F.lit(math.pi))
    equator = F.least(*[F.abs(x) for x in (a[0], a[1], b[0], b[1])])
    return (_half_sine(span_lat) + F.cos(equator) * F.cos(equator) * _half_sine(span_lon)) * (1 + 1e-9)


def _with_cells(df: DataFrame, eps: float) -> DataFrame:
    side = _side(eps)
    df = df.withColumn("row", F.floor(F.col("lat") / side).cast("long"))
    return df.withColumn("col", F.floor(F.col("lon") / _width(F.col("row"), side)).cast("long"))


def _tile_columns(level: int) -> list[str]:
    return [f"tr{level}", f"tc{level}"]


def _with_tiles(df: DataFrame, eps: float) -> DataFrame:
    side = _side(eps)
    width = _width(F.col("row"), side)
    return df.withColumns({
        name: value for k in LEVELS for name, value in (
            (f"tr{k}", F.floor(F.col("lat") / side * k).cast("long")),
            (f"tc{k}", F.floor(F.col("lon") / width * k).cast("long")))})


def _boxes(sites: DataFrame, by: list[str], prefix: str = "") -> DataFrame:
    """Weight and tight bounding box of the sites in each cell or tile."""
    return sites.groupBy(*by).agg(
        F.sum("weight").alias(prefix + "n"),
        *[getattr(F, how)(c).alias(prefix + k) for k, (how, c) in BOX.items()])


def _probes(df: DataFrame, box: tuple, eps: float) -> DataFrame:
    """Each row once per cell that may hold something within ``eps`` of its box."""
    side, pi = _side(eps), math.pi
    df = df.withColumn("prow", F.explode(F.sequence(F.col("row") - 2, F.col("row") + 2)))
    prow = F.col("prow")
    df = df.where((prow * side < pi / 2 + side) & ((prow + 1) * side > -pi / 2 - side))
    pole = F.greatest(F.abs(box[0]), F.abs(box[1]), F.abs(prow * side), F.abs((prow + 1) * side))
    share = F.lit(_half_chord(eps)) / F.cos(F.least(pole, F.lit(pi / 2)))
    reach = F.when((pole >= pi / 2) | (share >= 1), F.lit(pi)).otherwise(2 * F.asin(F.least(share, F.lit(1.0)))) * (1 + 1e-6)
    width = _width(prow, side)
    df = df.withColumns({"_from": box[2] - reach, "_to": box[3] + reach, "_wide": width})

    def columns(first: Column, last: Column) -> Column:
        a, b = F.floor(first / F.col("_wide")).cast("long"), F.floor(last / F.col("_wide")).cast("long")
        return F.sequence(a, b)
    first, last, turn = F.col("_from"), F.col("_to"), F.lit(2 * pi)
    low, high = F.lit(-pi), F.lit(pi)
    # columns met the other way round come once more only where the circle crosses the meridian
    west = F.when(first < low, columns(F.greatest(first + turn, low), high))
    east = F.when(last >= high, columns(low, F.least(last - turn, high)))
    none = F.array().cast("array<bigint>")
    here = columns(F.greatest(first, low), F.least(last, high))
    met = (F.when((first >= low) & (last < high), here).when(last - first >= turn, columns(low, high))
           .otherwise(F.array_distinct(F.concat(here, F.coalesce(west, none), F.coalesce(east, none)))))
    return df.withColumn("pcol", F.explode(met)).drop("_from", "_to", "_wide")


# -- how much lies within eps of a site --------------------------------------

def _within(left: DataFrame, keys: list[str], right: DataFrame, eps: float) -> DataFrame:
    """``keys`` plus ``reached``: weight of right sites within eps of each left site.

    ``left`` holds the keys, lat, lon, row, col (of the site) and ``need``: once
    the weight known to be within reach meets it, or can no longer meet it, the
    row is not refined further, so ``reached`` is exact only as far as
    ``reached >= need`` goes. The lists of cut cells and tiles are bounded by the
    geometry: at most 25 cells, and the tiles a circle's edge crosses.
    """
    point = (F.col("lat"), F.col("lat"), F.col("lon"), F.col("lon"))
    cells = (_boxes(right, CELL, "b_").withColumnsRenamed({"row": "prow", "col": "pcol"}))
    near = (_probes(left, point, eps).join(cells, ["g", "prow", "pcol"])
            .withColumnsRenamed({"prow": "c_row", "pcol": "c_col"}))
    carried = [k for k in dict.fromkeys([*keys, "g", "lat", "lon", "need"]) if k not in ("need",)]
    at = ["c_row", "c_col"]
    reached = F.lit(0).cast("long")
    near = near.withColumn("reached", reached)
    for level in [*LEVELS, None]:
        inside = _farthest(point, _box("b_")) <= _limit(eps)
        cut = ~inside & (_nearest(point, _box("b_")) <= _limit(eps))
        near = near.withColumns({"_in": F.coalesce(inside, F.lit(False)),
                                 "_cut": F.coalesce(cut, F.lit(False))})
        state = near.groupBy(*carried).agg(
            F.max("need").alias("need"),
            (F.max("reached") + F.coalesce(F.sum(F.when(F.col("_in"), F.col("b_n"))), F.lit(0)))
            .alias("reached"),
            F.coalesce(F.sum(F.when(F.col("_cut"), F.col("b_n"))), F.lit(0)).alias("_open"),
            F.collect_list(F.when(F.col("_cut"), F.struct(*at))).alias("_cuts"))
        undecided = ((F.col("reached") < F.col("need"))
                     & (F.col("reached") + F.col("_open") >= F.col("need")))
        state = state.withColumn("_cuts", F.when(undecided, F.col("_cuts")))
        opened = (state.withColumn("_at", F.explode_outer("_cuts"))
                  .select(*carried, "need", "reached", *[F.col(f"_at.{c}").alias(c) for c in at]))
        if level is None:
            target = right.select(F.col("g"), F.col("row").alias("c_row"), F.col("col").alias("c_col"),
                                  *[F.col(c) for c in at if c.startswith("t")],
                                  F.col("lat").alias("q_lat"), F.col("lon").alias("q_lon"),
                                  F.col("weight").alias("q_w"))
            exact = haversine(F.col("lat"), F.col("lon"), F.col("q_lat"), F.col("q_lon")) <= _limit(eps)
            return (opened.join(target, ["g", *at], "left").groupBy(*carried)
                    .agg((F.max("reached") + F.coalesce(F.sum(F.when(exact, F.col("q_w"))), F.lit(0)))
                         .alias("reached"))
                    .select(*keys, "reached"))
        finer = [*at, *_tile_columns(level)]
        tiles = _boxes(right.withColumnsRenamed({"row": "c_row", "col": "c_col"}), ["g", *finer], "b_")
        near = opened.join(tiles, ["g", *at], "left")
        at = finer


def _core_sites(sites: DataFrame, eps: float) -> DataFrame:
    """Sites with ``core``: at least min_samples points within eps, itself included."""
    crowd = sites.groupBy(*CELL).agg(F.sum("weight").alias("in_cell"))
    placed = sites.join(crowd, CELL).withColumn(
        "dense", F.col("in_cell") >= F.col("min_samples"))
    sparse = placed.where(~F.col("dense")).select(
        *SITE, "row", "col", F.col("min_samples").cast("long").alias("need"))
    counted = _within(sparse, SITE, sites, eps).withColumnRenamed("reached", "_reached")
    return (placed.join(counted, SITE, "left")
            .withColumn("core", F.col("dense")
                        | F.coalesce(F.col("_reached") >= F.col("min_samples"), F.lit(False)))
            .drop("dense", "in_cell", "_reached"))


# -- links between cells, components -----------------------------------------

def _links(core: DataFrame, eps: float) -> DataFrame:
    """Pairs of nodes (cells with core sites) that hold core sites within eps of each other."""
    cells = _boxes(core, CELL, "a_").join(
        core.groupBy(*CELL).agg(F.min("first_id").alias("node")), CELL)
    other = cells.select("g", F.col("row").alias("prow"), F.col("col").alias("pcol"),
                         F.col("node").alias("to"), *[F.col("a_" + k).alias("b_" + k) for k in BOX])
    pairs = (_probes(cells, _box("a_"), eps).join(other, ["g", "prow", "pcol"])
             .where(F.col("node") < F.col("to"))
             .withColumnsRenamed({"row": "a_row", "col": "a_col", "prow": "b_row", "pcol": "b_col"})
             .select("g", "node", "to", "a_row", "a_col", "b_row", "b_col",
                     *["a_" + k for k in BOX], *["b_" + k for k in BOX]))
    a_at, b_at = ["a_row", "a_col"], ["b_row", "b_col"]
    found = None
    for level in [*LEVELS, None]:
        near = _nearest(_box("a_"), _box("b_")) <= _limit(eps)
        sure = _farthest(_box("a_"), _box("b_")) <= _limit(eps)
        # read three times: written once
        judged = saved(pairs.where(near).withColumn("_sure", sure), "judged")
        done = judged.where("_sure").select("g", "node", "to").distinct()
        found = done if found is None else found.unionByName(done)
        # a side is opened only as far as it can reach the other one's box
        still = judged.where(~F.col("_sure")).select("g", "node", "to", *a_at, *b_at, *["b_" + k for k in BOX]).join(
            done, ["g", "node", "to"], "left_anti")
        reached = _nearest(_box("a_"), _box("b_")) <= _limit(eps)
        if level is None:
            def ends(side, at):
                renamed = {"row": f"{side}_row", "col": f"{side}_col", "lat": f"{side}_lat",
                           "lon": f"{side}_lon"}
                renamed.update({c: f"{side}_{c}" for k in LEVELS for c in _tile_columns(k)})
                return core.withColumnsRenamed(renamed).select("g", *at, f"{side}_lat", f"{side}_lon")
            close = haversine(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")) <= _limit(eps)
            point = (F.col("a_lat"), F.col("a_lat"), F.col("a_lon"), F.col("a_lon"))
            opened = still.join(ends("a", a_at), ["g", *a_at]).where(_nearest(point, _box("b_")) <= _limit(eps))
            last = (opened.drop(*["b_" + k for k in BOX]).join(ends("b", b_at), ["g", *b_at])
                    .where(close).select("g", "node", "to").distinct())
            return found.unionByName(last).distinct()

        def tiles(side, at):
            cols = _tile_columns(level)
            renamed = {"row": f"{side}_row", "col": f"{side}_col"}
            renamed.update({c: f"{side}_{c}" for k in LEVELS for c in _tile_columns(k)})
            return (_boxes(core.withColumnsRenamed(renamed), ["g", *at, *[f"{side}_{c}" for c in cols]],
                           f"{side}_"))
        opened = still.join(tiles("a", a_at), ["g", *a_at]).where(reached).drop(*["b_" + k for k in BOX])
        pairs = opened.join(tiles("b", b_at), ["g", *b_at])
        a_at = a_at + [f"a_{c}" for c in _tile_columns(level)]
        b_at = b_at + [f"b_{c}" for c in _tile_columns(level)]


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(g, node, label): label is the smallest node of the component, whatever its length."""
    ends = links.select(F.struct("g", "node").alias("a"), F.struct("g", F.col("to").alias("node")).alias("b"))
    joined = components(ends, "a", "b").select("node.g", "node.node", F.col("component.node").alias("_least"))
    return nodes.select("g", "node").join(joined, ["g", "node"], "left").select(
        "g", "node", F.coalesce("_least", "node").alias("label"))


# -- the operator -------------------------------------------------------------

def cluster_hotspots(points: DataFrame, order: str, group: list[str] | None = None,
                     min_samples: Column | int = MIN_SAMPLES_FLOOR, eps_meters: float = EPS_METERS,
                     lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """``points`` plus ``cluster_id``, -1 for noise.

    Clusters are numbered from 0 by their first core point in ``order``, per
    group; a border point belongs to the lowest numbered cluster that reaches
    it. ``min_samples`` counts the point itself and may differ by group.
    """
    group = group or []
    g = F.struct(*group) if group else F.struct(F.lit(1).alias("all"))
    need = min_samples if isinstance(min_samples, Column) else F.lit(min_samples)
    keyed = _on_sphere(points.withColumns({"g": g, "_need": need}), lat, lon)
    sites = (keyed.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
             .groupBy(*SITE).agg(F.count("*").alias("weight"), F.min(order).alias("first_id"),
                                 F.max("_need").alias("min_samples")))
    sites = saved(_with_tiles(_with_cells(sites, eps_meters), eps_meters), "sites")
    placed = saved(_core_sites(sites, eps_meters), "core")
    core = placed.where("core")
    nodes = core.groupBy(*CELL).agg(F.min("first_id").alias("node"))
    labels = saved(connected_components(nodes, _links(core, eps_meters)), "labels")
    ordered = saved(ranked(labels.select("g", "label").distinct(), F.col("g"), F.col("label")), "numbers")
    first = ordered.groupBy("g").agg(F.min("rank").alias("_first"))
    numbers = ordered.join(first, "g").select("g", "label", (F.col("rank") - F.col("_first")).cast("int").alias("cluster_id"))
    cells = saved(nodes.join(labels, ["g", "node"]).join(numbers, ["g", "label"])
                  .select(*CELL, "cluster_id"), "cells")
    in_core = core.join(cells, CELL).select(*SITE, "cluster_id")
    # A border site may be reached by several cells: the lowest number wins.
    rim = placed.where(~F.col("core")).select(*SITE, "row", "col", F.lit(1).cast("long").alias("need"))
    pairs = (_probes(rim, (F.col("lat"), F.col("lat"), F.col("lon"), F.col("lon")), eps_meters)
             .join(cells.select("g", F.col("row").alias("prow"), F.col("col").alias("pcol"),
                                "cluster_id"), ["g", "prow", "pcol"]))
    asked = pairs.select(*SITE, "row", "col", "cluster_id", "need").distinct()
    owned = core.join(cells, CELL).withColumn("g", F.struct("g", "cluster_id"))
    asked = asked.withColumn("g0", F.col("g")).withColumn("g", F.struct("g", "cluster_id"))
    reached = _within(asked, ["g0", "lat", "lon", "cluster_id"], owned, eps_meters)
    in_rim = (reached.where("reached > 0").groupBy(F.col("g0").alias("g"), "lat", "lon")
              .agg(F.min("cluster_id").alias("cluster_id")))
    found = in_core.unionByName(in_rim)
    return (keyed.join(found, SITE, "left")
            .withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))
            .select(*points.columns, "cluster_id"))


def neighbour_counts(points: DataFrame, group: list[str], at_least: int,
                     eps_meters: float = EPS_METERS) -> DataFrame:
    """``points`` plus whether at least so many points, itself included, lie within eps."""
    keyed = _on_sphere(points.withColumn("g", F.struct(*group)), "latitude", "longitude")
    sites = keyed.groupBy(*SITE).agg(F.count("*").alias("weight"), F.lit(at_least).alias("min_samples"))
    sites = _with_tiles(_with_cells(sites, eps_meters), eps_meters)
    core = _core_sites(sites, eps_meters).select(*SITE, F.col("core").alias("has_neighbours"))
    return keyed.join(core, SITE).select(*points.columns, "has_neighbours")


# -- thresholds, frames, summaries --------------------------------------------

def min_samples_column(n_points: Column, area_km2: Column, eps_meters: float = EPS_METERS,
                       ratio: float = DENSITY_RATIO) -> Column:
    """Count a disc must reach to be ``ratio`` times the city's average density."""
    disc = math.pi * (eps_meters / 1000) ** 2
    return F.greatest(F.lit(MIN_SAMPLES_FLOOR),
                      F.ceil(F.lit(float(ratio)) * (n_points / area_km2 * F.lit(disc))).cast("int"))


def _areas() -> Column:
    return F.create_map(*[F.lit(x) for kv in AREA_KM2.items() for x in kv])


def with_min_samples(points: DataFrame, group: list[str]) -> DataFrame:
    """Points plus the threshold of their city; the counts are one row per group."""
    counted = points.groupBy(*group).agg(F.count("*").alias("_n"))
    level = counted.select(*group, min_samples_column(F.col("_n"), _areas()[F.col("city_area")])
                           .alias("min_samples"))
    return points.join(F.broadcast(level), group)


def frame_points(spark: SparkSession, points: DataFrame, frames: DataFrame, most: int | None = None,
                 seed: int = 0) -> DataFrame:
    """Points of each frame and city inside its window: all of them, or a sample of ``most`` each."""
    inside = in_frames(spark, points, frames)
    return inside if most is None else sampled_rows(inside, "crash_id", seed, most, ["frame", "city_area"])


def _sample_digest(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("/", F.col(key), F.lit(str(seed))).cast("binary"))


def sampled_rows(points: DataFrame, key: str, seed: int, most: int, group: list[str] | None = None) -> DataFrame:
    """``most`` rows of each group (all of a smaller one), the same ones whatever the partitioning.

    Those with the least md5 of key and seed, ties by the key; rows alike in the key are told apart by nothing, any of
    them may be the last. What is shuffled to find them are counts: how many rows of a group have a digest with the same first
    four digits, which says in which of the 65,536 ranges the last row lies. Ranges before it are taken whole; only
    the rows of that one range are put in order.
    """
    group = group or []
    bucket = F.conv(F.substring("_digest", 1, 4), 16, 10).cast("int")
    marked = points.withColumn("_digest", _sample_digest(key, seed)).withColumn("_bucket", bucket)
    counts = marked.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = (counts.withColumn("_upto", F.sum("_n").over(upto)).where(F.col("_upto") >= most)
            .groupBy(*[F.col(g).alias(f"_of_{g}") for g in group])
            .agg(F.min_by(F.struct(F.col("_bucket").alias("bucket"), (F.lit(most) - F.col("_upto") + F.col("_n")).alias("left")), "_upto")
                 .alias("_last")))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    # one row per group: with its size left to the estimate, all rows would be sent by group to meet it
    placed = marked.join(F.broadcast(last), same if group else None, "left")
    at = F.col("_last.bucket")
    whole = placed.where(at.isNull() | (F.col("_bucket") < at)).select(*points.columns)
    order = W.partitionBy(*group).orderBy("_digest", key)
    some = (placed.where(F.col("_bucket") == at).withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= F.col("_last.left")).select(*points.columns))
    return whole.unionByName(some)


def sampled(points: DataFrame, key: str, seed: int, fraction: float = STABILITY_FRACTION) -> DataFrame:
    """The same fraction of rows whatever the partitioning: the md5 of key and seed decides."""
    bucket = F.conv(F.substring(_sample_digest(key, seed), 1, 8), 16, 10).cast("long")
    return points.where(bucket < int(fraction * (1 << 32)))


def cluster_in_frames(points: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Hotspots of every frame and city in one run, each with its own threshold."""
    group = ["frame", "city_area", *(extra or [])]
    columns = [*group, "crash_id", "latitude", "longitude", "severity", "local_hour"]
    placed = saved(with_min_samples(points.select(*columns), group), "points")
    return saved(cluster_hotspots(placed, "crash_id", group, F.col("min_samples")), "clustered")


def concentration(spark: SparkSession, clustered: DataFrame, frames: DataFrame) -> DataFrame:
    """Shares inside hotspots, inside the ten largest, and fatal shares, per frame and city."""
    key = ["frame", "city_area"]
    hot = F.col("cluster_id") >= 0
    fatal = F.col("severity") == "fatal"
    sizes = (clustered.where(hot).groupBy(*key, "cluster_id").agg(F.count("*").alias("size")))
    w = W.partitionBy(*key).orderBy(F.desc("size"), "cluster_id")
    # the limit on the rank acts before the shuffle, so a group sends ten rows from each task
    top = (sizes.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= 10)
           .groupBy(*key).agg(F.sum("size").alias("_top")))
    largest = sizes.groupBy(*key).agg(F.count("*").alias("hotspots")).join(F.broadcast(top), key)
    counted = clustered.groupBy(*key).agg(
        F.count("*").alias("injury_crashes"), F.max("min_samples").alias("min_samples"),
        count_if(hot).alias("_hot"), count_if(hot & fatal).alias("_hot_fatal"),
        count_if(~hot & fatal).alias("_cold_fatal"))
    d = (frame_windows(spark, frames).select(*key)
         .join(F.broadcast(counted), key, "left").join(F.broadcast(largest), key, "left")
         .na.fill(0, ["injury_crashes", "hotspots", "_hot", "_top", "_hot_fatal", "_cold_fatal"])
         .na.fill(MIN_SAMPLES_FLOOR, ["min_samples"]))
    n, h = F.col("injury_crashes"), F.col("_hot")
    return d.select(*key, "injury_crashes", "min_samples", "hotspots",
                    percent(h, n, 1).alias("pct_in_hotspots"),
                    F.coalesce(percent(F.col("_top"), n, 1), F.lit(0.0)).alias("pct_in_top10_hotspots"),
                    percent(F.col("_hot_fatal"), h, 2).alias("pct_fatal_in_hotspots"),
                    percent(F.col("_cold_fatal"), n - h, 2).alias("pct_fatal_elsewhere"))


def summarize_clusters(clustered: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Size, centroid, severity mix and peak local hour of every hotspot."""
    key = [*(group or []), "cluster_id"]
    n = F.col("size")
    hours = (clustered.where("cluster_id >= 0").groupBy(*key, "local_hour")
             .agg(F.count("*").alias("_n")))
    peak = hours.groupBy(*key).agg(
        F.max_by("local_hour", F.struct("_n", -F.col("local_hour"))).alias("peak_local_hour"))
    counted = clustered.where("cluster_id >= 0").groupBy(*key).agg(
        F.count("*").alias("size"), F.avg("latitude").alias("_lat"), F.avg("longitude").alias("_lon"),
        *[count_if(F.col("severity") == s).alias(f"_{s}") for s in ("fatal", "serious", "minor")])
    return counted.join(peak, key).select(
        *key, "size", round_half_up(F.col("_lat"), 5).alias("centroid_lat"),
        round_half_up(F.col("_lon"), 5).alias("centroid_lon"),
        *[percent(F.col(f"_{s}"), n, 2).alias(f"pct_{s}") for s in ("fatal", "serious", "minor")],
        "peak_local_hour")


def stability(points: DataFrame, seeds: list[int] | None = None) -> DataFrame:
    """Hotspots and share inside them on seeded 80 % samples, one column pair per seed."""
    seeds = STABILITY_SEEDS if seeds is None else seeds
    parts = None
    for seed in seeds:
        part = sampled(points, "crash_id", seed).withColumn("seed", F.lit(seed))
        parts = part if parts is None else parts.unionByName(part)
    key = ["frame", "city_area", "seed"]
    clustered = cluster_in_frames(parts, ["seed"])
    hot = F.col("cluster_id") >= 0
    per_cluster = clustered.groupBy(*key, "cluster_id").agg(F.count("*").alias("n"))
    per_seed = per_cluster.groupBy(*key).agg(
        count_if(hot).alias("hotspots"),
        percent(F.coalesce(F.sum(F.when(hot, F.col("n"))), F.lit(0)), F.sum("n"), 1).alias("pct_in_hotspots"))
    return per_seed.groupBy("frame", "city_area").pivot("seed", seeds).agg(
        F.max("hotspots").alias("hotspots"), F.max("pct_in_hotspots").alias("pct_in_hotspots"))
