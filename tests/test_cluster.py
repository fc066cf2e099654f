"""Clustering against a brute-force refinement, and the cases that a grid gets wrong."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import cluster
from trailmark.operators.components import connected_components, least_labels

SCHEMA = "collectingeventid long, latitude1 double, longitude1 double, startdate string"


def km(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    return 2 * 6371 * math.asin(math.sqrt(min(1.0, math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2)))


def components(ids, near):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if label[i] != label[j] and near(i, j):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def brute(points, e_dist, e_days):
    """{id: least id of its block} at the fixpoint; points: id -> (lat, lon, day)."""
    block = {i: 0 for i in points}
    tests = [lambda i, j: km(points[i][:2], points[j][:2]) <= e_dist, lambda i, j: abs(points[i][2] - points[j][2]) <= e_days]
    k, still = 0, 0
    while still < 2:
        new = components(list(points), lambda i, j: block[i] == block[j] and tests[k % 2](i, j))
        same = len(set(new.values())) == len(set(block.values())) and k > 0
        still = still + 1 if same else 0
        block, k = new, k + 1
    return block


def frame(spark, points):
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).cast("string")
    return spark.createDataFrame([(i, *p) for i, p in points.items()], "collectingeventid long, latitude1 double, longitude1 double, d int").withColumn("startdate", day).drop("d")


@pytest.mark.parametrize("seed", [1, 2])
def test_fixpoint_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    points = {i: (rng.choice([rng.uniform(0, 0.5), 0.2]), rng.uniform(0, 0.5), rng.randint(0, 60)) for i in range(90)}
    got = cluster.iterative_clustering(frame(spark, points), 8.0, 4.0, max_iter=20)
    assert {r["collectingeventid"]: r["cluster_key"] for r in got.collect()} == brute(points, 8.0, 4.0)
    ids = [r[0] for r in got.select("spatiotemporal_cluster_id").distinct().collect()]
    assert sorted(ids) == list(range(len(ids)))
    cluster.validate_connectivity(got, 8.0, 4.0)


def test_poles_and_date_line(spark):
    points = {1: (10.0, 180.0, 0), 2: (10.0, -180.0, 0), 3: (10.0, 179.99, 0), 4: (90.0, 0.0, 0), 5: (90.0, 120.0, 0), 6: (89.999, -60.0, 0), 7: (-90.0, 3.0, 0)}
    got = {r[0]: r[1] for r in cluster.spatial_dbscan(frame(spark, points), 5.0).select("collectingeventid", "spatial_cluster_id").collect()}
    want = components(list(points), lambda i, j: km(points[i][:2], points[j][:2]) <= 5.0)
    assert len(set(want.values())) == 3 and len({(got[i], want[i]) for i in points}) == 3


@pytest.mark.parametrize("few", [0, 10_000])
def test_dense_cells(spark, few, monkeypatch):
    monkeypatch.setattr(cluster, "FEW_LINKS", few)
    monkeypatch.setattr(cluster, "MANY_PAIRS", 5)
    rng = np.random.default_rng(0)
    points = {i: (float(x), float(y), 0) for i, (x, y) in enumerate(rng.normal(0, 0.05, (60, 2)).round(3))}
    got = {r[0]: r[1] for r in cluster.spatial_dbscan(frame(spark, points), 3.0).select("collectingeventid", "spatial_cluster_id").collect()}
    want = components(list(points), lambda i, j: km(points[i][:2], points[j][:2]) <= 3.0)
    assert len({(got[i], want[i]) for i in points}) == len(set(want.values())) == len(set(got.values()))


def test_two_clusters(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, "2020-01-01"), (2, 0.001, 0.001, "2020-01-02"), (3, 10.0, 20.0, "2020-02-01"), (4, 10.001, 20.001, "2020-02-02")], SCHEMA)
    got = cluster.create_pipeline(1, 5).transform(df)
    assert sorted(r["count"] for r in got.groupBy("spatiotemporal_cluster_id").count().collect()) == [2, 2]
    assert [n for n, _ in cluster.create_pipeline().steps()] == ["preprocessor", "spatial_dbscan", "iterative_spatiotemporal", "validate_connectivity"]
    for c in ("spatial_cluster_id", "temporal_cluster_id", "spatiotemporal_cluster_id"):
        assert sorted({r[c] for r in got.collect()}) == [0, 1]


def test_steps_may_be_replaced_added_and_left_out(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, "2020-01-01"), (2, 0.001, 0.001, "2020-01-02"), (3, 10.0, 20.0, "2020-02-01")], SCHEMA)
    plain = cluster.create_pipeline(1, 5).without("spatial_dbscan")
    assert [n for n, _ in plain.steps()] == ["preprocessor", "iterative_spatiotemporal", "validate_connectivity"]
    marked = plain.added("only_first", lambda x: x.where("collectingeventid < 3"), before="iterative_spatiotemporal").replaced("validate_connectivity", lambda x: x.withColumn("checked", x["collectingeventid"] > 0))
    rows = marked.transform(df).collect()
    assert sorted(r["collectingeventid"] for r in rows) == [1, 2] and all(r["checked"] for r in rows)
    for wrong in (lambda: plain.without("spatial_dbscan"), lambda: plain.added("preprocessor", lambda x: x), lambda: plain.replaced("none", lambda x: x)):
        with pytest.raises(KeyError):
            wrong()


def test_disconnected_clusters_are_refused(spark):
    rows = [(1, 0.0, 0.0, "2020-01-01", 0), (2, 0.0, 2.0, "2020-01-01", 0)]
    df = spark.createDataFrame(rows, SCHEMA + ", spatiotemporal_cluster_id long")
    with pytest.raises(ValueError, match="spatially disconnected"):
        cluster.validate_connectivity(df, 1, 1)
    with pytest.raises(ValueError):
        cluster.validate_connectivity(df.drop("spatiotemporal_cluster_id"), 1, 1)


def test_bad_settings_and_empty_frames(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        cluster.create_pipeline(0, 5)
    assert cluster.iterative_clustering(df, 1, 1, max_iter=0).columns == df.columns
    got = cluster.create_pipeline(1, 5).transform(df)
    assert got.count() == 0 and "spatiotemporal_cluster_id" in got.columns


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(500 + i, 501 + i) for i in range(40)] + [(900, 900 + i) for i in range(30)]
    nodes = {x for p in links for x in p}
    near = {frozenset(p) for p in links}
    want = components(sorted(nodes), lambda i, j: frozenset((i, j)) in near)
    df = spark.createDataFrame([*links, links[0], (None, 4), (7, 7)], "src long, dst long")
    for few in (0, 1000):
        got = {r["node"]: r["component"] for r in connected_components(df, few=few).collect()}
        assert all(want[n] == c for n, c in got.items()) and {n for p in near if len(p) == 2 for n in p} <= set(got)
    assert connected_components(df.limit(0)).count() == 0
    a, b = least_labels(np.array([5, 3, 9]), np.array([3, 1, 8]))
    assert dict(zip(a.tolist(), b.tolist())) == {1: 1, 3: 1, 5: 1, 8: 8, 9: 8}
