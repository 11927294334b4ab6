import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfuse.operators import hotspots as H


def brute_dbscan(lat, lon, eps, min_samples):
    """Sequential density clustering on the full distance matrix."""
    la, lo = np.radians(lat), np.radians(lon)
    h = (np.sin((la[:, None] - la) / 2) ** 2
         + np.cos(la)[:, None] * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2)
    near = 2 * np.arcsin(np.sqrt(h)) <= eps / 6_371_000
    core = near.sum(1) >= min_samples
    label = np.full(len(la), -1)
    number = 0
    for i in range(len(la)):
        if label[i] != -1 or not core[i]:
            continue
        stack = [i]
        label[i] = number
        while stack:
            p = stack.pop()
            if core[p]:
                for q in np.flatnonzero(near[p] & (label == -1)):
                    label[q] = number
                    stack.append(q)
        number += 1
    return label


def scene(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.uniform([51.40, -0.30], [51.46, -0.20], (n // 2, 2))
    knots = rng.uniform([51.40, -0.30], [51.46, -0.20], (6, 2))
    near = knots[rng.integers(0, 6, n // 4)] + rng.normal(0, 0.0009, (n // 4, 2))
    line = np.stack([np.linspace(51.41, 51.44, n // 8), np.full(n // 8, -0.25)], 1)
    same = np.repeat([[51.43, -0.22]], n // 8, 0)
    xy = np.concatenate([base, near, line, same])
    return xy[rng.permutation(len(xy))]


@pytest.mark.parametrize("seed,n,min_samples", [(1, 600, 5), (2, 900, 9), (3, 400, 40)])
def test_matches_brute_force(spark, seed, n, min_samples):
    xy = scene(seed, n)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)],
                               "id long, latitude double, longitude double")
    got = {r.id: r.cluster_id for r in H.cluster_hotspots(df, "id", min_samples=min_samples).collect()}
    want = brute_dbscan(xy[:, 0], xy[:, 1], 150, min_samples)
    assert [got[i] for i in range(len(xy))] == want.tolist()


def test_groups_are_independent(spark):
    xy = scene(4, 300)
    rows = [(g, i, float(a), float(b)) for g in "ab" for i, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "city string, id long, latitude double, longitude double")
    need = F.when(F.col("city") == "a", 5).otherwise(12)
    out = H.cluster_hotspots(df, "id", ["city"], need).collect()
    for g, m in (("a", 5), ("b", 12)):
        got = {r.id: r.cluster_id for r in out if r.city == g}
        assert [got[i] for i in range(len(xy))] == brute_dbscan(xy[:, 0], xy[:, 1], 150, m).tolist()


def test_one_coordinate_holds_most_points(spark):
    rows = [(i, 51.5, -0.1) for i in range(3000)] + [(5000, 51.5, -0.1005), (6000, 51.6, -0.1)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    out = {r.id: r.cluster_id for r in H.cluster_hotspots(df, "id", min_samples=50).collect()}
    assert out[0] == 0 and out[2999] == 0 and out[5000] == 0 and out[6000] == -1


def test_threshold(spark):
    row = spark.range(1).select(
        H.min_samples_column(F.lit(100_000), F.lit(589.8)).alias("big"),
        H.min_samples_column(F.lit(10), F.lit(589.8)).alias("small")).first()
    assert row.big == max(5, math.ceil(10 * 100_000 / 589.8 * math.pi * 0.15 ** 2))
    assert row.small == 5


@pytest.mark.parametrize("cells", [200, 2000])
def test_one_long_road_is_one_cluster(spark, cells):
    """Steps of 100 m due north, ids dealt at random, so labels have to travel through foreign basins."""
    rng = np.random.default_rng(cells)
    ids = rng.permutation(5 * cells)
    rows = [(int(ids[5 * i + k]), 40.0 + i * 100 / 111_195, -73.9) for i in range(cells) for k in range(5)]
    df = spark.createDataFrame(rows + [(10**6, 30.0, -73.9)], "id long, latitude double, longitude double")
    out = {r.id: r.cluster_id for r in H.cluster_hotspots(df, "id", min_samples=5).collect()}
    assert out.pop(10**6) == -1 and set(out.values()) == {0}


def spread(seed, where, n):
    """Points within a few hundred metres of a place on the sphere, however they are written."""
    rng = np.random.default_rng(seed)
    step = 700 / 111_195  # degrees
    if abs(where[0]) > 89:  # around a pole, some exactly on it
        away = np.abs(rng.normal(0, step, n))
        away[:4] = 0
        lat = np.sign(where[0]) * (90 - away)
        lon = rng.uniform(-180, 180, n)
    else:
        lat = where[0] + rng.normal(0, step, n)
        lon = where[1] + rng.normal(0, step, n) / np.cos(np.radians(where[0]))
    lon = (lon + 180) % 360 - 180
    lon[: n // 3] += 360 * rng.integers(-1, 2, n // 3)  # a full turn more or less is the same place
    return np.stack([lat, lon], 1)


@pytest.mark.parametrize("where, eps", [((-17.0, 180.0), 150), ((90.0, 0.0), 150), ((-90.0, 0.0), 150), ((84.0, 179.9999), 700)])
def test_across_the_meridian_and_the_poles(spark, where, eps):
    xy = spread(11, where, 260)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id long, latitude double, longitude double")
    got = {r.id: r.cluster_id for r in H.cluster_hotspots(df, "id", min_samples=6, eps_meters=eps).collect()}
    want = brute_dbscan(xy[:, 0], xy[:, 1], eps, 6)
    assert [got[i] for i in range(len(xy))] == want.tolist()
    assert want.max() >= 0


def test_large_circles_over_the_whole_globe(spark):
    """Circles of 900 km: boxes half a turn wide, poles inside circles, cells of many degrees."""
    rng = np.random.default_rng(12)
    v = rng.normal(0, 1, (350, 3))
    v /= np.linalg.norm(v, axis=1)[:, None]
    xy = np.degrees(np.stack([np.arcsin(v[:, 2]), np.arctan2(v[:, 1], v[:, 0])], 1))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id long, latitude double, longitude double")
    got = {r.id: r.cluster_id for r in H.cluster_hotspots(df, "id", min_samples=4, eps_meters=900_000).collect()}
    assert [got[i] for i in range(len(xy))] == brute_dbscan(xy[:, 0], xy[:, 1], 900_000, 4).tolist()


def test_neighbours_across_the_meridian(spark):
    rows = [("a", 1, 10.0, 179.9995), ("a", 2, 10.0, -179.9996), ("a", 3, 10.0, 179.99), ("b", 4, 10.0, 180.0), ("b", 5, 90.0, 5.0), ("b", 6, 90.0, -120.0)]
    df = spark.createDataFrame(rows, "city string, id long, latitude double, longitude double")
    got = {r.id: r.has_neighbours for r in H.neighbour_counts(df, ["city"], 2).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: True, 6: True}
