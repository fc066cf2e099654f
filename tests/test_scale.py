"""Work that must not grow faster than the input: tables read once, tasks of bounded size, few links between cells."""

import random

import pytest
from pyspark.sql import functions as F

from trailmark.operators import cluster, redact
from trailmark.operators.components import connected_components, contracted
from trailmark.plans import adapter, catalogue, shared
from trailmark.sources import tables as sources

SF = "/root/testdata/sf0.001"


def counted(df):
    """``df``, and how many of its rows have been computed so far."""
    n = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), n


@pytest.mark.parametrize("name", ["map_extent_zoomed", "verify_mask", "verify_drop", "drop_offenders", "redacted_share", "temporal_islands", "cluster_sizes"])
def test_queries_read_events_once(spark, monkeypatch, name):
    tables, counts = adapter.core_tables(spark, SF), []

    def core(spark, sf_dir):
        events, n = counted(tables["collectingevent"].where("StartDate IS NOT NULL AND LocalityID IS NOT NULL"))
        counts.append(n)
        return tables | {"collectingevent": events}

    monkeypatch.setattr(catalogue, "core_tables", core)
    catalogue.QUERIES[name](spark, SF).collect()
    want = tables["collectingevent"].where("StartDate IS NOT NULL AND LocalityID IS NOT NULL").count()
    assert sum(n.value for n in counts) == want


def test_the_pipeline_reads_its_frame_once(spark):
    rng = random.Random(5)
    rows = [(i, rng.uniform(0, 1), rng.uniform(0, 1), f"2020-01-{rng.randint(1, 28):02d}") for i in range(60)]
    df, n = counted(spark.createDataFrame(rows, "collectingeventid long, latitude1 double, longitude1 double, startdate string"))
    assert cluster.create_pipeline(5, 3).transform(df).count() == 60
    assert n.value == 60


def test_the_pipeline_finds_the_places_of_all_events_once(spark, monkeypatch):
    rows = [(i, 0.1 * i, 0.0, "2020-01-01") for i in range(6)]
    df = spark.createDataFrame(rows, "collectingeventid long, latitude1 double, longitude1 double, startdate string")
    plain, calls = cluster.spatial_components, []
    monkeypatch.setattr(cluster, "spatial_components", lambda points, e: calls.append(e) or plain(points, e))
    got = cluster.create_pipeline(5, 3).transform(df)
    assert got.select("cluster_key").distinct().count() == 6
    assert len(calls) == 2  # once to cluster, once to validate


def test_tasks_are_dealt_by_size(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "x")
    spark.range(20_000).repartition(1).write.parquet(path)
    df, n = spark.read.parquet(path), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shared.parts_of(df) == n and shared.dealt(df, "id") is df
    monkeypatch.setattr(shared, "PART_BYTES", 2000)
    small, large = shared.parts_of(df), shared.parts_of(df.union(df))
    assert small > n and large == pytest.approx(2 * small, abs=1) and shared.dealt(df, "id").rdd.getNumPartitions() == small
    assert shared.parts_of(spark.createDataFrame([(1,)], "a int")) == n


def test_flags_are_dealt_by_size_and_stay_the_same(spark, monkeypatch):
    flags = lambda: redact.redaction_flags(sources.frames_source(adapter.core_tables(spark, SF)))
    want = sorted(map(tuple, flags().collect()))
    monkeypatch.setattr(shared, "PART_BYTES", 20_000)
    got = flags()
    assert got.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, got.collect())) == want


def test_flags_of_determinations_without_object_or_key(spark):
    make = spark.createDataFrame
    tables = {
        "collectionobject": make([(1, 0), (2, 1), (3, None), (None, 0)], "CollectionObjectID long, YesNo2 int"),
        "determination": make([(1, 7, 1), (1, 8, 1), (3, 7, 0), (None, 7, 1), (9, 7, 1)], "CollectionObjectID long, TaxonID long, IsCurrent int"),
        "vtaxon2": make([(7, 1), (7, 1), (8, 0)], "TaxonID long, RedactLocality int"),
    }
    got = redact.redaction_flags(sources.frames_source(tables)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 1), (2, 1), (3, 0), (None, 0)], key=repr)


def test_conflicting_flags_fail_closed(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "collectionobjectid long, localityname string")
    flags = spark.createDataFrame([(1, -1), (1, 0), (2, 0), (2, None)], "collectionobjectid long, is_redacted int")
    assert {r[0]: r[1] for r in redact.masked(df, flags).collect()} == {1: "*", 2: "b"}


def test_links_are_contracted_in_their_partitions(spark):
    rng = random.Random(2)
    links = [(t * 1000 + rng.randrange(50), t * 1000 + rng.randrange(50)) for t in range(4) for _ in range(400)] + [(5, 1005), (2007, 3007)]
    df = spark.createDataFrame(links, "src long, dst long")
    few = contracted(df.repartition(3, (F.col("src") / 1000).cast("int")))
    assert few.count() < 4 * 52
    label = lambda x: sorted(map(tuple, connected_components(x).collect()))
    assert label(few) == label(df)
