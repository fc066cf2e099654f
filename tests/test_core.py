"""Sources, preparation, redaction, summaries, densities and evaluation on small frames."""

import datetime as dt
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import density, evaluate, prepare, redact, summary
from trailmark.sources import tables as sources

EVENT = "CollectingEventID long, StartDate string, EndDate string, Remarks string, LocalityID long"


@pytest.fixture(scope="module")
def core(spark):
    make = spark.createDataFrame
    return {
        "collectingevent": make([(1, "2020-01-01", "2020-01-01", "a", 10), (2, "2020-01-02", "2020-01-03", "b", 20)], EVENT),
        "collectionobject": make([(100, 1, "x"), (200, 2, "y"), (300, 99, "z")], "CollectionObjectID long, CollectingEventID long, Text1 string"),
        "locality": make([(10, 1.0, 4.0, 1000), (20, 2.0, 5.0, 2000), (30, 3.0, 6.0, 3000)], "LocalityID long, Latitude1 double, Longitude1 double, GeographyID long"),
        "geography": make([(1000, 10.0, 15.0), (2000, 20.0, 25.0), (4000, 40.0, 45.0)], "GeographyID long, CentroidLat double, CentroidLon double"),
    }


def test_merge(core):
    got = prepare.merge_core_tables(core).collect()
    assert len(got) == 2 and {r["collectingeventid"] for r in got} == {1, 2} and all(r["geographyid"] for r in got)


def test_null_keys_match_only_without_filtering(spark, core):
    events = core["collectingevent"].unionByName(spark.createDataFrame([(3, "2020-01-05", None, "c", None)], EVENT))
    objects = core["collectionobject"].unionByName(spark.createDataFrame([(400, 3, "w")], core["collectionobject"].schema))
    places = core["locality"].unionByName(spark.createDataFrame([(None, 9.0, 9.0, 1000)], core["locality"].schema))
    tables = core | {"collectingevent": events, "collectionobject": objects, "locality": places}
    lat = lambda **k: {r["collectingeventid"]: r["latitude1"] for r in prepare.merge_core_tables(tables, **k).collect()}
    assert lat()[3] is None and lat(filter_related=False)[3] == 9.0


def test_missing_tables(core):
    with pytest.raises(KeyError, match="geography, locality"):
        prepare.build_clean_dataframe({k: core[k] for k in ("collectingevent", "collectionobject")})


def test_clean(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-01", None, 1.0, 2.0, 10.0, 20.0, 1, 1), (2, "2020-01-02", None, None, None, 11.0, 21.0, 2, 2), (3, "bad", None, 1.0, None, None, float("nan"), 3, 3)],
        "CollectingEventID long, StartDate string, EndDate string, Latitude1 double, Longitude1 double, CentroidLat double, CentroidLon double, GeographyID long, LocalityID long",
    )
    got = prepare.clean_for_clustering(df).orderBy("collectingeventid").collect()
    assert [r["latitude1"] for r in got] == [1.0, 11.0] and all(c == c.lower() for c in got[0].asDict()) and [r["spatial_flag"] for r in got] == [1, 1]
    loose = prepare.clean_for_clustering(df, drop_missing_spatial=False, drop_missing_date=False)
    assert loose.count() == 3


def test_preprocess(spark):
    rows = [(1, 0.0, 0.0, "2020-01-01"), (1, 0.0, 0.0, "2020-01-01"), (2, 95.0, 50.0, "2020-01-01"), (3, 10.0, 190.0, "1700-01-01"), (4, -20.0, 200.0, "2021-06-01"), (5, 12.0, 12.0, "2022-03-15"), (6, 1.0, 1.0, "2999-01-01"), (7, float("nan"), 1.0, "2020-01-01"), (None, None, 1.0, None)]
    df = spark.createDataFrame(rows, "collectingeventid long, latitude1 double, longitude1 double, startdate string")
    assert {r["collectingeventid"] for r in prepare.preprocess(df).collect()} == {1, 5}
    assert prepare.preprocess(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="startdate"):
        prepare.preprocess(df.drop("startdate"))


def test_first_row_decides_before_filters(spark):
    df = spark.createDataFrame([(1, 1, 95.0, 0.0, "2020-01-01"), (1, 2, 5.0, 0.0, "2020-01-01")], "collectingeventid long, collectionobjectid long, latitude1 double, longitude1 double, startdate string")
    assert prepare.preprocess(df).count() == 0


def test_connection_options():
    made = sources.Connection(host="h", user="u", password="p", database="d", port=1, charset="latin1").options()
    assert made["url"].startswith("jdbc:mysql://h:1/d?characterEncoding=latin1") and (made["user"], made["password"]) == ("u", "p")
    assert "p" not in repr(sources.Connection(password="secret")).split("password")[-1] or "secret" not in repr(sources.Connection(password="secret"))


def test_jdbc(spark, core):
    """The database that Spark's own jars bring, in memory: what is read, pushed down, split and refused."""
    here = sources.Connection(url="jdbc:derby:memory:trailmark;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", user="APP", password="p")
    for name, df in core.items():
        df.write.format("jdbc").options(**here.options()).option("dbtable", name).mode("overwrite").save()
    with sources.connected(spark, here) as source:
        found = sources.fetch(source, "locality", ["LocalityID"], "Latitude1 > 1")
        assert {r[0] for r in found.collect()} == {20, 30}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(Latitude1,1.0)" in plan and "Longitude1" not in plan.split("ReadSchema")[-1]
        loaded = sources.load_core_tables(source, tuple(core), related_only=True)
        assert {k: v.count() for k, v in loaded.items()} == {"collectingevent": 2, "collectionobject": 3, "locality": 2, "geography": 2}
    with pytest.raises(RuntimeError, match="closed"):
        source("locality")
    split = here.source(spark, {"locality": ("LocalityID", 0, 40, 4)})("locality")
    assert split.rdd.getNumPartitions() == 4 and split.count() == 3


def test_related_falls_back_to_a_plain_load(spark, core, caplog):
    tables = core | {"geography": core["geography"].withColumn("GeographyID", F.col("GeographyID") + 1)}
    loaded = sources.load_core_tables(sources.frames_source(tables), tuple(core), related_only=True, table_limits={"geography": 2})
    assert sorted(r["GeographyID"] for r in loaded["geography"].collect()) == [1001, 2001] and "geography" in caplog.text


def test_fetch_and_load(spark, core):
    source = sources.frames_source(core)
    none = spark.createDataFrame([(None,), (None,)], "id long")
    empty = sources.fetch_by_ids(source, "locality", "LocalityID", none)
    assert empty.count() == 0 and empty.columns == core["locality"].columns
    assert sources.fetch(source, "locality", limit=0).count() == 3 and sources.fetch(source, "locality", "LocalityID", "Latitude1 > 1", 1, "LocalityID").first()[0] == 20
    names = tuple(core)
    loaded = sources.load_core_tables(source, names, related_only=True)
    assert {k: v.count() for k, v in loaded.items()} == {"collectingevent": 2, "collectionobject": 3, "locality": 2, "geography": 2}
    by_event = sources.load_core_tables(source, names, related_only=True, primary_table="collectingevent")
    assert by_event["collectionobject"].count() == 2
    limited = sources.load_core_tables(source, names, limit=1, table_limits={"locality": 2})
    assert limited["locality"].count() == 2 and limited["geography"].count() == 3
    with pytest.raises(ValueError):
        sources.load_core_tables(source, names, related_only=True, primary_table="locality")
    with pytest.raises(ValueError):
        sources.load_core_tables(source, ("locality",), related_only=True)


def test_csv_round_trip_in_place(spark, tmp_path):
    path = str(tmp_path / "deep" / "x.csv")
    df = spark.createDataFrame([(1, 'a "quoted"\nline, two'), (2, None)], "id int, text string")
    sources.write_csv(df, path)
    assert [tuple(r) for r in sources.read_csv(spark, path).orderBy("id").collect()] == [(1, 'a "quoted"\nline, two'), (2, None)]
    sources.write_csv(sources.read_csv(spark, path).where("id = 1"), path)
    assert sources.read_csv(spark, path).count() == 1


FRAME = "collectionobjectid long, localityname string, namedplace string, text1 string, remarks string, latitude1 double, longitude1 double, centroidlat double, centroidlon double"


def flags(spark, *rows):
    return spark.createDataFrame(rows, "collectionobjectid long, is_redacted int")


def test_redact_mask_and_drop(spark):
    df = spark.createDataFrame([(i, f"L{i}", "p", "t", "r", 1.0, 2.0, 3.0, 4.0) for i in (1, 2, 3)], FRAME)
    out, n = redact.redact(df, flags(spark, (2, 1), (1, 0)))
    rows = {r["collectionobjectid"]: r for r in out.collect()}
    assert n == 1 and "is_redacted" not in out.columns
    assert (rows[2]["localityname"], rows[2]["namedplace"], rows[2]["latitude1"], rows[2]["centroidlon"]) == ("*", "*", None, None)
    assert (rows[2]["text1"], rows[2]["remarks"]) == ("t", "r") and rows[1]["localityname"] == "L1"
    kept, n = redact.redact(df, flags(spark, (2, 1)), drop_redacted=True)
    assert n == 1 and {r[0] for r in kept.collect()} == {1, 3}
    assert redact.redact(df, flags(spark).limit(0))[1] == 0 and redact.redact(df, flags(spark, (2, 2)))[1] == 1
    with pytest.raises(KeyError):
        redact.redact(df.drop("collectionobjectid"), flags(spark, (2, 1)))


def test_verify(spark):
    df = spark.createDataFrame([(10, "*", None, None), (11, "Loc B", 5.0, 6.0)], "collectionobjectid long, localityname string, latitude1 double, longitude1 double")
    got = redact.verify_redaction(df, flags(spark, (10, 1), (11, 1)))
    assert (got.flagged_rows, got.bad_locality_rows, got.bad_coordinate_rows, got.ok, got.offenders.count()) == (2, 1, 1, False, 1)
    dropped = redact.verify_redaction_drop(df, flags(spark, (11, 1)))
    assert (dropped.flagged_rows, dropped.ok) == (1, False)
    assert redact.verify_redaction_drop(df, flags(spark, (12, 1))).ok


def test_flags_and_csv(spark, tmp_path):
    make = spark.createDataFrame
    source = sources.frames_source({
        "collectionobject": make([(1, 1), (2, 0), (3, 0), (4, None)], "CollectionObjectID long, YesNo2 int"),
        "determination": make([(2, 7, 1), (3, 7, 0), (2, 8, 1)], "CollectionObjectID long, TaxonID long, IsCurrent int"),
        "vtaxon2": make([(7, 1), (8, 0)], "TaxonID long, RedactLocality int"),
    })
    assert {tuple(r) for r in redact.redaction_flags(source).collect()} == {(1, 1), (2, 1), (3, 0), (4, 0)}
    assert redact.redaction_flags(source, make([("2",), (None,)], "id string")).count() == 1
    path = str(tmp_path / "c.csv")
    sources.write_csv(make([(1, "here", 1.0), (3, "there", 2.0)], "collectionobjectid long, localityname string, latitude1 double"), path)
    assert not redact.verify_csv(spark, source, path).ok
    assert redact.redact_csv(spark, source, path) == (path, 1)
    assert redact.verify_csv(spark, source, path).ok and not redact.verify_csv(spark, source, path, expect_dropped=True).ok


def test_summaries(spark):
    df = spark.createDataFrame([(1, 0, 0.0, 0.0, dt.datetime(2020, 1, 1)), (2, 0, 1.0, 1.0, dt.datetime(2020, 1, 3)), (3, 1, 0.0, 0.0, dt.datetime(2020, 1, 1)), (4, None, 0.0, 0.0, None)], "collectingeventid long, spatiotemporal_cluster_id long, latitude1 double, longitude1 double, startdate timestamp_ntz")
    assert tuple(summary.cluster_summary(df).first()) == (3, 2, 1.5, 1.5, 2, 1)
    assert tuple(summary.cluster_summary(df.limit(0)).first())[:2] == (0, 0)
    seg = summary.trajectory_segments(df).collect()
    assert [(r["from_id"], r["to_id"], r["t_mid"]) for r in seg] == [(1, 2, 1577923200.0)]
    assert [r["size"] for r in summary.nearest_sizes(df, [5, 5, 5]).collect()] == [2, 1]
    picked = [r["collectingeventid"] for r in summary.sample_rows(df, 2).collect()]
    assert picked == [r["collectingeventid"] for r in summary.sample_rows(df.repartition(3), 2).collect()] == sorted(range(1, 5), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[:2]


def test_one_cluster_over_many_ranges(spark):
    start = dt.datetime(2020, 1, 1)
    rows = [(i, None if i % 7 == 0 else 1 if i % 5 else 2, float(i), -float(i), start + dt.timedelta(days=i * 37 % 50)) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "collectingeventid long, spatiotemporal_cluster_id long, latitude1 double, longitude1 double, startdate timestamp_ntz")
    want = set()
    for c in (None, 1, 2):
        mine = sorted((r for r in rows if r[1] == c), key=lambda r: (r[4], r[0]))
        want |= {(c, a[0], b[0], a[2], b[3]) for a, b in zip(mine, mine[1:])}
    got = summary.trajectory_segments(df).collect()
    assert {(r[0], r["from_id"], r["to_id"], r["lat1"], r["lon2"]) for r in got} == want and len(got) == len(want)
    assert summary.trajectory_segments(df.limit(0)).count() == 0


def test_density(spark):
    df = spark.createDataFrame([(0.0, 0.0, dt.datetime(2020, 1, 1)), (1.0, 1.0, dt.datetime(2020, 1, 2)), (0.1, 0.1, dt.datetime(2020, 1, 1)), (None, 1.0, dt.datetime(2020, 1, 5))], "latitude1 double, longitude1 double, startdate timestamp_ntz")
    cells = {(r["x_bin"], r["y_bin"]): r["n"] for r in density.density_grid(df, grid_size=5).collect()}
    assert cells == {(0, 0): 2, (3, 3): 1}
    assert {(r["n"], r["n_max"]) for r in density.density_by_day(df, grid_size=5).collect()} == {(2, 2), (1, 2)}
    assert {r["bin"]: r["n"] for r in density.time_histogram(df, bins=4).collect()} == {0: 2, 1: 1, 3: 1}
    assert density.density_grid(df.limit(0)).count() == 0
    assert density.extent(df, "us") == (-130.0, -60.0, 24.0, 50.0)
    assert density.extent(df, 2.0) == (-0.5, 1.5, -0.5, 1.5)
    wide = density.extent(df.withColumn("longitude1", F.col("longitude1") * 10), 2.0, aspect=True)
    assert wide == pytest.approx((-5.0, 15.0, -5 / 1.5, 1 + 5 / 1.5))  # margins of 5 and 0.5, the smaller one raised
    assert [r["label"] for r in density.time_ticks(df, n=3).collect()] == ["2020-01-01", "2020-01-03", "2020-01-05"]
    assert density.time_ticks(df.limit(0)).count() == 0 and density.time_histogram(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        density.extent(df, "moon")


def test_quantiles(spark):
    values = [0.0, 1.0, 1.0, 1.0, 2.5, 7.0, 7.0, 30.0, 31.0, 31.5, 99.0]
    counted = spark.createDataFrame([(v,) for v in values], "x double").groupBy("x").agg(F.count("*").alias("n"))
    assert density.weighted_quantiles(counted, [0.0, 0.25, 0.75, 0.9, 1.0]) == pytest.approx(np.quantile(values, [0.0, 0.25, 0.75, 0.9, 1.0]))


def slow_ari(t, p):
    pairs = lambda keys: sum(math.comb(list(keys).count(k), 2) for k in set(keys))
    both, a, b, n = pairs(list(zip(t, p))), pairs(t), pairs(p), math.comb(len(t), 2)
    return (both - a * b / n) / ((a + b) / 2 - a * b / n)


def test_evaluation(spark):
    t, p = [0, 0, 1, 1, 2, 2, 2, 0], [5, 5, 6, 6, 7, 7, 5, 5]
    df = spark.createDataFrame([(i, a, b, a) for i, (a, b) in enumerate(zip(t, p))], "collectingeventid long, label long, spatiotemporal_cluster_id long, cluster long")
    assert evaluate.adjusted_rand(df, "label", "spatiotemporal_cluster_id").first()["ari"] == pytest.approx(slow_ari(t, p))
    more = df.unionByName(spark.createDataFrame([(99, None, 9, None)], df.schema))
    assert evaluate.penalised_ari(more, "label", "spatiotemporal_cluster_id").first()["score"] == pytest.approx(slow_ari(t, p))
    clash = df.unionByName(spark.createDataFrame([(99, None, 5, None)], df.schema))
    assert tuple(evaluate.penalised_ari(clash, "label", "spatiotemporal_cluster_id").first())[1:] == (1, 0.0)
    assert evaluate.size_difference(df).first()["score"] == pytest.approx((1 / 3 + 0 + 1 / 3) / 10)
    best, least, scores = evaluate.grid_search(df, lambda e_dist: lambda x: x, {"e_dist": [1, 2]})
    assert best == {"e_dist": 1} and scores == [least, least]


def test_folds_and_their_scores(spark):
    rows = [(i, i % 4 if i % 3 else None, i % 4 if i % 11 else 9) for i in range(60)]
    df = spark.createDataFrame([(i, c) for i, _, c in rows], "collectingeventid long, spatiotemporal_cluster_id long")
    labels = spark.createDataFrame([(i, t) for i, t, _ in rows if t is not None], "collectingeventid long, label long")
    got = evaluate.kfold_scores(df, labels, lambda a, b: lambda x: x, [1.0], [2.0], 3)
    want = []
    for fold in range(3):
        mine = [r for r in rows if int(hashlib.md5(f"42:{r[0]}".encode()).hexdigest()[:8], 16) % 3 == fold]
        both = [r for r in mine if r[1] is not None]
        want.append(max(0.0, slow_ari([r[1] for r in both], [r[2] for r in both])))
    assert min(want) > 0
    assert got == {(1.0, 2.0): pytest.approx(sum(want) / 3)}
    assert sum(part.count() for part in evaluate.folds(df, 3)) == 60
