"""Joining, cleaning and validating collection records."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trailmark.functions.convert import as_key, as_number, as_time
from trailmark.plans.shared import dealt
from trailmark.schema import KEPT, REQUIRED

_KEYS = {"collectingeventid", "localityid", "collectionobjectid", "geographyid"}
_NUMBERS = {"latitude1", "longitude1", "centroidlat", "centroidlon", "minelevation", "maxelevation", "elevationaccuracy"}
_TIMES = {"startdate", "enddate"}


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of ``columns`` that exist, lower-cased, keys and numbers converted leniently."""
    there, kinds = {c.lower(): c for c in df.columns}, dict(df.dtypes)
    out = []
    for name in (c.lower() for c in columns if c.lower() in there):
        c = F.col(f"`{there[name]}`")
        out.append((as_key(c, kinds[there[name]]) if name in _KEYS else as_number(c) if name in _NUMBERS else c).alias(name))
    return df.select(*out)


def require_tables(tables: Mapping[str, DataFrame]) -> None:
    missing = sorted(set(REQUIRED) - set(tables))
    if missing:
        raise KeyError(f"missing tables: {', '.join(missing)}")


def merge_core_tables(tables: Mapping[str, DataFrame], filter_related: bool = True) -> DataFrame:
    """Events with their objects (inner), localities and geographies (left), names lower-cased.

    With ``filter_related`` null keys match nothing, which is plain equality;
    without it null keys match one another.  Places are looked up before objects
    are joined, so once an event, and rows come out dealt by event.
    """
    require_tables(tables)
    event, obj, place, region = (project(tables[t], KEPT[t]) for t in ("collectingevent", "collectionobject", "locality", "geography"))

    def joined(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
        if filter_related:
            return left.join(right, key, how)
        return left.join(right, left[key].eqNullSafe(right[key]), how).drop(right[key])

    lookups = [(right, key) for right, key, left in ((place, "localityid", event), (region, "geographyid", place)) if key in left.columns]
    if "localityid" not in event.columns:
        lookups = []
    placed, names = event, [*event.columns, *(c for c in obj.columns if c != "collectingeventid")]
    for right, key in lookups:
        placed = joined(placed, right, key, "left")
        names += [c for c in right.columns if c != key]
        if filter_related:  # the column that a plain join is by comes first
            names = [key, *(c for c in names if c != key)]
    if filter_related:
        obj = dealt(obj, "collectingeventid")
    return joined(placed, obj, "collectingeventid", "inner").select(*names)


def clean_for_clustering(df: DataFrame, drop_missing_spatial: bool = True, drop_missing_date: bool = True, include_centroids: bool = True) -> DataFrame:
    """Dates parsed, coordinates filled from centroids axis by axis, rows without place or date dropped, spatial_flag added."""
    df = lower_names(df)
    kinds = dict(df.dtypes)
    df = df.withColumns({c: as_time(F.col(c), kinds[c]) for c in kinds if c in _TIMES} | {c: as_number(F.col(c)) for c in kinds if c in _NUMBERS})
    if include_centroids:
        fill = {"latitude1": "centroidlat", "longitude1": "centroidlon"}
        df = df.withColumns({a: F.coalesce(a, b) for a, b in fill.items() if a in kinds and b in kinds})
    if drop_missing_spatial:
        df = df.where("latitude1 IS NOT NULL AND longitude1 IS NOT NULL")
    if drop_missing_date:
        df = df.where("startdate IS NOT NULL")
    return df.withColumn("spatial_flag", F.when(F.col("latitude1").isNotNull(), 1).otherwise(0))


def build_clean_dataframe(tables: Mapping[str, DataFrame], filter_related: bool = True, **clean) -> DataFrame:
    return clean_for_clustering(merge_core_tables(tables, filter_related), **clean)


def centroid_fills(df: DataFrame) -> DataFrame:
    """How many rows took a coordinate from the centroid, by axis: n_lat, n_lon."""
    return df.agg(
        F.count_if(F.col("latitude1").isNull() & F.col("centroidlat").isNotNull()).alias("n_lat"),
        F.count_if(F.col("longitude1").isNull() & F.col("centroidlon").isNotNull()).alias("n_lon"),
    )


def extract(tables: Mapping[str, DataFrame], include_centroids: bool = False, limit: int | None = None) -> DataFrame:
    """The four-way join that clustering starts from: dated rows with precise coordinates, or with centroids in their stead."""
    df = merge_core_tables(tables)
    fallback = lambda a, b: F.coalesce(a, b) if include_centroids else F.col(a)
    df = df.where(F.col("startdate").isNotNull() & fallback("latitude1", "centroidlat").isNotNull() & fallback("longitude1", "centroidlon").isNotNull())
    df = clean_for_clustering(df, include_centroids=include_centroids).drop("spatial_flag")
    return df.orderBy("collectingeventid", "collectionobjectid").limit(limit) if limit else df


def first_of_event(df: DataFrame) -> DataFrame:
    """One row per event, the least object id first; null event ids count as one event.

    The rows of an event are few.  Those without an event id may be many, but as
    only the first is asked for, Spark cuts a group to one row a task before it
    gathers it.  ``df`` is read once.
    """
    by = "collectionobjectid" if "collectionobjectid" in df.columns else "startdate"
    order = Window.partitionBy("collectingeventid").orderBy(F.col(by).asc_nulls_first())
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def preprocess(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Rows fit for clustering: one per event, then complete, in range and dated from 1800 to ``as_of`` (default: now, UTC)."""
    need = ["collectingeventid", "latitude1", "longitude1", "startdate"]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    end = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of if as_of is not None else F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    df = first_of_event(df)
    kinds = dict(df.dtypes)
    return (
        df.withColumns({"latitude1": as_number(F.col("latitude1")), "longitude1": as_number(F.col("longitude1")), "startdate": as_time(F.col("startdate"), kinds["startdate"])})
        .dropna(subset=["latitude1", "longitude1", "startdate"])
        .where(F.col("latitude1").between(-90, 90) & F.col("longitude1").between(-180, 180))
        .where((F.year("startdate") >= 1800) & (F.col("startdate") <= end))
    )


def keep_related(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    return df.join(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def chain(df: DataFrame, *steps) -> DataFrame:
    return functools.reduce(lambda x, f: f(x), steps, df)
