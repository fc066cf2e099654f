"""All queries over the driver's tables; :mod:`trailmark.plans.oracles` has the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.operators import cluster, density, evaluate, prepare, redact, summary
from trailmark.plans.adapter import core_tables
from trailmark.plans.oracles import AS_OF, COARSE, FOLDS, GRID, HISTOGRAM_BINS, LIMIT, ORACLES, SAMPLE, TABLE_LIMITS, TARGETS, USUAL
from trailmark.plans.shared import forget, stored
from trailmark.sources import tables as sources

__all__ = ["ORACLES", "QUERIES"]

STC = summary.STC
PLACED = ("collectingeventid", "collectionobjectid", "localityid", "latitude1", "longitude1", "startdate")


def _dated(df: DataFrame) -> DataFrame:
    """Dates as text, which all engines compare alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("startdate", "enddate", "day") if c in df.columns})


def _source(spark: SparkSession, sf_dir: str) -> sources.Source:
    return sources.frames_source(core_tables(spark, sf_dir))


def _precise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.extract(core_tables(spark, sf_dir))


def _fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.preprocess(_precise(spark, sf_dir), AS_OF)


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of :func:`_fit` that tell event, object, place and time, stored, for queries that read them more than once."""
    return stored(_fit(spark, sf_dir).select(*PLACED), "fit")


def _clustered(spark: SparkSession, sf_dir: str, settings: tuple[float, float]) -> DataFrame:
    return cluster.create_pipeline(*settings, as_of=AS_OF).transform(_precise(spark, sf_dir).select(*PLACED))


def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.lower_names(sources.fetch(_source(spark, sf_dir), "locality", ["LocalityID", "LocalityName"], "Latitude1 > 0"))


def fetch_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(spark, sf_dir)
    ids = source("collectingevent").where("EndDate IS NOT NULL").select("LocalityID")
    return prepare.lower_names(sources.fetch_by_ids(source, "locality", "LocalityID", ids, ["LocalityID", "NamedPlace"]))


def core_join_precise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(_precise(spark, sf_dir))


def core_join_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(prepare.extract(core_tables(spark, sf_dir), include_centroids=True))


def core_join_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(prepare.merge_core_tables(core_tables(spark, sf_dir), filter_related=False))


CORE = ("collectingevent", "collectionobject", "locality", "geography")


def _keys(found: dict[str, DataFrame], **more: str) -> DataFrame:
    """(source, id) of the rows of each table, with constant columns before them."""
    kept = {k: F.lit(v) for k, v in more.items()}
    parts = [df.select(*[c.alias(k) for k, c in kept.items()], F.lit(t).alias("source"), F.col({"collectionobject": "CollectionObjectID"}.get(t, df.columns[0])).alias("id")) for t, df in found.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _related(primary: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _keys(sources.load_core_tables(_source(spark, sf_dir), CORE, related_only=True, primary_table=primary))

    return query


def load_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One limit for all tables; then limits by table, which leave the others whole."""
    source = _source(spark, sf_dir)
    return _keys(sources.load_core_tables(source, CORE, limit=LIMIT), limits="one").unionAll(
        _keys(sources.load_core_tables(source, CORE, limit=LIMIT, table_limits=TABLE_LIMITS), limits="by table"),
    )


def related_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geographies that no locality names are loaded without that condition."""
    tables = core_tables(spark, sf_dir)
    tables["geography"] = tables["geography"].withColumn("GeographyID", F.col("GeographyID") + 1000)
    return _keys(sources.load_core_tables(sources.frames_source(tables), CORE, related_only=True))


def clean_coalesce_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = prepare.build_clean_dataframe(core_tables(spark, sf_dir), drop_missing_spatial=False, drop_missing_date=False)
    return _dated(df.select("collectingeventid", "collectionobjectid", "startdate", "latitude1", "longitude1", "spatial_flag"))


def spatial_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.flag_counts(prepare.build_clean_dataframe(core_tables(spark, sf_dir), drop_missing_spatial=False, drop_missing_date=False))


def centroid_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.centroid_fills(prepare.merge_core_tables(core_tables(spark, sf_dir)))


def prep_dedupe_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(_fit(spark, sf_dir).select("collectingeventid", "collectionobjectid", "latitude1", "longitude1", "startdate"))


def spatial_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.spatial_dbscan(_placed(spark, sf_dir), COARSE[0]).select("collectingeventid", "spatial_cluster_id")


def temporal_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = stored(cluster.spatial_dbscan(_placed(spark, sf_dir), COARSE[0]), "placed")
    return cluster.temporal_dbscan(placed, COARSE[1]).select("collectingeventid", "spatial_cluster_id", "temporal_cluster_id")


def cluster_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single steps one after the other, each shown as the least event of the group that it puts an event in."""
    e_dist, e_days = COARSE
    df = _placed(spark, sf_dir).drop("collectionobjectid", "localityid")
    st, stc = ["spatial_cluster_id", "temporal_cluster_id"], [STC]
    for step, by, name in (
        (lambda x: cluster.spatial_dbscan(x, e_dist), st[:1], "spatial_key"),
        (lambda x: cluster.temporal_dbscan(x, e_days), st, "temporal_key"),
        (lambda x: cluster.spatial_reconnect_within_temporal(x, e_dist), st, "reconnected_key"),
        (lambda x: cluster.combine_clusters(cluster.temporal_recompute(x, e_days)), stc, "combined_key"),
        (lambda x: cluster.spatial_reconnect_within_spatiotemporal(x, e_dist), stc, "placed_key"),
        (lambda x: cluster.temporal_reconnect_within_spatiotemporal(x, e_days), stc, "timed_key"),
    ):
        stepped = stored(step(df), "step")
        df = stored(stepped.join(stepped.groupBy(*by).agg(F.min("collectingeventid").alias(name)), by), "step")
        forget(stepped)
    return df.select("collectingeventid", "spatial_key", "temporal_key", "reconnected_key", "combined_key", "placed_key", "timed_key")


def _fixpoint(settings: tuple[float, float]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _clustered(spark, sf_dir, settings).select("collectingeventid", "cluster_key", STC)

    return query


def connectivity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of clusters by place alone, so that time has something to disconnect."""
    placed = stored(cluster.spatial_dbscan(_placed(spark, sf_dir), COARSE[0]), "placed")
    return cluster.disconnects(placed.withColumnRenamed("spatial_cluster_id", STC), *COARSE)


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.cluster_sizes(_clustered(spark, sf_dir, COARSE))


def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.cluster_summary(_clustered(spark, sf_dir, COARSE)).withColumn("mean_size", F.round("mean_size", 9))


def trajectory_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.trajectory_segments(_clustered(spark, sf_dir, COARSE))


def nearest_cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.nearest_sizes(_clustered(spark, sf_dir, COARSE), list(TARGETS))


def redaction_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact.redaction_flags(_source(spark, sf_dir))


def _redactable(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return prepare.first_of_event(_precise(spark, sf_dir)), redact.redaction_flags(_source(spark, sf_dir))


def _redactable_twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`_redactable`, stored, for queries that read them more than once: frames and the flags of their objects."""
    df = stored(prepare.first_of_event(_precise(spark, sf_dir)), "redactable")
    return df, stored(redact.redaction_flags(_source(spark, sf_dir), df.select(redact.ID)), "flags")


def redact_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = redact.masked(*_redactable(spark, sf_dir), add_redaction_column=True)
    return out.select("collectingeventid", "collectionobjectid", "localityname", "namedplace", "text1", "latitude1", "longitude1", "centroidlat", "centroidlon", "is_redacted")


def redact_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = redact.masked(*_redactable(spark, sf_dir), drop_redacted=True)
    return out.select("collectingeventid", "collectionobjectid", "localityname")


def redact_events_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, flags = _redactable(spark, sf_dir)
    out = redact.masked(df, redact.event_flags(flags, _source(spark, sf_dir)("collectionobject")), "collectingeventid")
    return out.select("collectingeventid", "localityname", "latitude1")


def verify_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, flags = _redactable_twice(spark, sf_dir)
    frames = {"unmasked": df, "texts only": redact.masked(df, flags, coordinate_columns=()), "masked": redact.masked(df, flags)}
    told = {k: redact.verify_redaction(x, flags) for k, x in frames.items()}
    rows = [(k, t.flagged_rows, t.bad_locality_rows, t.bad_coordinate_rows, t.ok) for k, t in told.items()]
    return spark.createDataFrame(rows, "frame string, flagged_rows long, bad_locality_rows long, bad_coordinate_rows long, ok boolean")


def verify_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, flags = _redactable_twice(spark, sf_dir)
    told = {"kept": redact.verify_redaction_drop(df, flags), "dropped": redact.verify_redaction_drop(redact.masked(df, flags, drop_redacted=True), flags)}
    return spark.createDataFrame([(k, t.flagged_rows, t.ok) for k, t in told.items()], "frame string, flagged_rows long, ok boolean")


def verify_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, flags = _redactable_twice(spark, sf_dir)
    masked = redact.verify_redaction(redact.masked(df, flags, coordinate_columns=()), flags).offenders
    return masked.select("collectionobjectid", "collectingeventid", "localityname", "bad_locality", "bad_coordinates")


def drop_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact.verify_redaction_drop(*_redactable_twice(spark, sf_dir)).offenders.select("collectionobjectid", "collectingeventid")


def redacted_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = redact.masked(*_redactable(spark, sf_dir), add_redaction_column=True).agg(F.sum("is_redacted").alias("flagged"), F.count("*").alias("total")).first()
    told = spark.createDataFrame([tuple(row)], "flagged long, total long")
    return told.withColumn("share", F.round(F.lit(redact.redacted_share(row["flagged"], row["total"])), 9))


def density_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.density_grid(_placed(spark, sf_dir), grid_size=GRID).withColumns({c: F.round(c, 9) for c in ("x_centre", "y_centre")})


def density_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(density.density_by_day(_placed(spark, sf_dir), grid_size=GRID).withColumns({c: F.round(c, 9) for c in ("x_centre", "y_centre")}))


def _histogram(bins: int | str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return density.time_histogram(_fit(spark, sf_dir), bins=bins).withColumns({c: F.round(c, 9) for c in ("lower", "upper")})

    return query


def map_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _placed(spark, sf_dir)
    box = density.extent(df)
    inside = density.within_extent(df, box).agg(F.count("*").alias("n_inside"))
    told = dict(zip(("west", "east", "south", "north", "bar_km"), (*box, density.scale_bar_km(box))))
    return inside.withColumns({k: F.round(F.lit(v), 9) for k, v in told.items()})


def map_extent_zoomed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extents that a number as zoom, and the three to two aspect, give."""
    df = density.bounds(_fit(spark, sf_dir))
    views = {f"{z}{' 3:2' if a else ''}": density.extent(df, z, aspect=a) for z in ("auto", 2, 20) for a in (False, True)}
    rows = [(k, *map(float, v), density.scale_bar_km(v)) for k, v in views.items()]
    return spark.createDataFrame(rows, "view string, west double, east double, south double, north double, bar_km double").select("view", *(F.round(c, 6).alias(c) for c in ("west", "east", "south", "north", "bar_km")))


def time_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.time_ticks(_fit(spark, sf_dir)).withColumn("seconds", F.round("seconds", 6))


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling operator, with the sample's size as it is used."""
    return summary.sample_rows(_fit(spark, sf_dir), SAMPLE).select("collectingeventid")


def kfold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean scores over folds of clusters that are cells of place and time: what is compared is the dealing and the scoring."""
    df = _placed(spark, sf_dir)
    labels = df.where(F.col("collectingeventid") % 3 != 0).select("collectingeventid", F.floor("latitude1").alias("label"))

    def make(side: float, days: float):
        cells = F.floor(F.col("latitude1") / side) * 100_000 + F.floor(F.unix_date(F.to_date("startdate")) / days)
        return lambda part: part.withColumn(STC, cells)

    told = evaluate.kfold_scores(df, labels, make, [1.0, 2.0], [4000.0, 40_000.0], FOLDS)
    return spark.createDataFrame([(*k, v) for k, v in told.items()], "side double, days double, score double").withColumn("score", F.round("score", 9))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters with labels as if made by hand, a third of the events left without."""
    df = _clustered(spark, sf_dir, COARSE)
    return df.withColumns({"label": F.when(F.col("collectingeventid") % 3 != 0, F.col("localityid") % 10), "cluster": F.col("localityid") % 10})


def adjusted_rand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.adjusted_rand(_labelled(spark, sf_dir), "label", "cluster_key").withColumn("ari", F.round("ari", 9))


def penalised_ari(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.penalised_ari(_labelled(spark, sf_dir), "label", "cluster_key").withColumns({c: F.round(c, 9) for c in ("ari", "score")})


def size_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.size_difference(_labelled(spark, sf_dir), predicted="cluster_key").withColumn("score", F.round("score", 9))


QUERIES = {
    f.__name__: f
    for f in (
        scan_filter_project, fetch_by_ids, core_join_precise, core_join_centroid, core_join_nullsafe, clean_coalesce_flag, spatial_flag_counts, centroid_fills, prep_dedupe_validity, spatial_components, temporal_islands,
        cluster_steps, connectivity_check, cluster_sizes, cluster_summary, trajectory_segments, nearest_cluster_sizes, redaction_flags, redact_mask, redact_drop, redact_events_strict, verify_mask, verify_drop, verify_offenders, drop_offenders, redacted_share,
        density_grid, density_by_day, map_extent, map_extent_zoomed, time_ticks, seeded_sample, load_limits, related_fallback, kfold_scores, adjusted_rand, penalised_ari, size_difference,
    )
} | {
    "semi_related_objects": _related("collectionobject"),
    "semi_related_events": _related("collectingevent"),
    "cluster_fixpoint": _fixpoint(USUAL),
    "cluster_fixpoint_coarse": _fixpoint(COARSE),
    "time_histogram": _histogram(HISTOGRAM_BINS),
    "time_histogram_auto": _histogram("auto"),
}
