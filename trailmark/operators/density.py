"""Histograms over time and space, and the extents that maps are drawn in."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trailmark.plans.shared import forget, stored

VIEWS = {"california": (-125.0, -113.0, 32.0, 42.0), "us": (-130.0, -60.0, 24.0, 50.0), "world": (-180.0, 180.0, -90.0, 90.0)}


def _bin(x: Column, low: Column, high: Column, n: int) -> Column:
    """Bin 0..n-1 of n equal bins whose last is closed on the right; with no extent, the last bin."""
    place = F.floor((x - low) / (high - low) * n)
    return F.when(high > low, F.least(F.greatest(place, F.lit(0)), F.lit(n - 1))).otherwise(n - 1).cast("int")


def _with_extent(df: DataFrame, *columns: str) -> DataFrame:
    """Each row with the extent of the columns; the extent is one row, so the join is with a constant."""
    extent = df.agg(*(f(c).alias(f"{c}_{n}") for c in columns for n, f in (("low", F.min), ("high", F.max)))).first()
    return df.withColumns({k: F.lit(v) for k, v in extent.asDict().items()})


def weighted_quantiles(counted: DataFrame, shares: list[float]) -> list[float]:
    """Exact quantiles, between two values by straight line, of values ``x`` that occur ``n`` times each; there must be one at least.

    The values are range-partitioned and only counts a partition reach the
    driver; a quantile is then looked up in the partitions that hold its ranks.
    """
    spark = counted.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(counted.repartitionByRange(parts, "x").withColumn("_part", F.spark_partition_id()), "ranks")
    starts, total = {}, 0
    for r in ranged.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").collect():
        starts[r["_part"]] = total
        total += r["n"]
    places = [(total - 1) * s for s in shares]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    holds = {r: max(k for k, v in starts.items() if v <= r) for r in ranks}
    upto = F.sum("n").over(Window.partitionBy("_part").orderBy("x"))
    rows = ranged.where(F.col("_part").isin(sorted(set(holds.values())))).withColumn("upto", upto)
    found = {}
    for rank, part in holds.items():
        inside = (F.col("_part") == part) & (F.col("upto") > rank - starts[part])
        found[rank] = rows.where(inside).agg(F.min("x")).first()[0]
    forget(ranged)
    return [found[math.floor(p)] + (found[math.ceil(p)] - found[math.floor(p)]) * (p - math.floor(p)) for p in places]


def time_histogram(df: DataFrame, time: str = "startdate", bins: int | str = "auto") -> DataFrame:
    """bin, lower and upper edge in days since 1970, n; only bins that have rows.

    ``auto`` takes the larger number of bins of Sturges' and of Freedman and
    Diaconis' rule.  The rows are read once, into counts of their distinct times.
    """
    x = (F.unix_micros(F.col(time).cast("timestamp")) / F.lit(86_400_000_000.0)).alias("x")
    counted = stored(df.where(F.col(time).isNotNull()).select(x).groupBy("x").agg(F.count("*").alias("n")), "times")
    told = counted.agg(F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    n = bins
    if bins == "auto":
        n = 1
        if told["n"] and told["high"] > told["low"]:
            low_quartile, high_quartile = weighted_quantiles(counted, [0.25, 0.75])
            span, iqr = told["high"] - told["low"], high_quartile - low_quartile
            sturges = span / (math.log2(told["n"]) + 1)
            fd = 2 * iqr / told["n"] ** (1 / 3)
            n = max(1, math.ceil(span / (min(sturges, fd) if fd else sturges)))
    rows = counted.withColumns({"low": F.lit(told["low"]), "high": F.lit(told["high"])})
    width = (F.col("high") - F.col("low")) / n
    dealt = rows.groupBy(_bin(F.col("x"), F.col("low"), F.col("high"), n).alias("bin"), "low", "high").agg(F.sum("n").alias("n"))
    return dealt.select("bin", (F.col("low") + F.col("bin") * width).alias("lower"), (F.col("low") + (F.col("bin") + 1) * width).alias("upper"), "n")


def time_ticks(df: DataFrame, time: str = "startdate", n: int = 6) -> DataFrame:
    """tick, seconds, label: ``n`` evenly spaced dates of a colour scale from the first to the last time; none without times."""
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    ends = df.agg(F.min(seconds).alias("low"), F.max(seconds).alias("high")).where("low IS NOT NULL")
    ticks = ends.select("low", "high", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("tick"))
    at = F.col("low") + F.col("tick") * (F.col("high") - F.col("low")) / F.lit(float(max(n - 1, 1)))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(at / 86_400).cast("int"))
    return ticks.select("tick", at.alias("seconds"), F.date_format(day, "yyyy-MM-dd").alias("label"))


def density_grid(df: DataFrame, lat: str = "latitude1", lon: str = "longitude1", grid_size: int = 100, by: list[Column] | None = None) -> DataFrame:
    """x_bin, y_bin, centre of the cell, n: a grid of ``grid_size`` edges, so one bin fewer on each axis; empty cells are left out.

    The extent is that of all rows, whatever ``by`` groups them into.
    """
    n, by = grid_size - 1, by or []
    rows = _with_extent(df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()), lat, lon)
    edge = lambda c, k: F.col(f"{c}_low") + (F.col(k) + 0.5) * (F.col(f"{c}_high") - F.col(f"{c}_low")) / n
    bounds = [f"{c}_{s}" for c in (lat, lon) for s in ("low", "high")]
    cells = rows.groupBy(*by, *(_bin(F.col(c), F.col(f"{c}_low"), F.col(f"{c}_high"), n).alias(k) for c, k in ((lon, "x_bin"), (lat, "y_bin"))), *bounds).agg(F.count("*").alias("n"))
    return cells.withColumns({"x_centre": edge(lon, "x_bin"), "y_centre": edge(lat, "y_bin")}).drop(*bounds)


def density_by_day(df: DataFrame, time: str = "startdate", grid_size: int = 100, **where) -> DataFrame:
    """As :func:`density_grid` for each day, all on the extent of all days; n_min and n_max: the emptiest and fullest cell of the all-days grid that has rows."""
    rows = df.where(F.col(time).isNotNull())
    least, most = density_grid(rows, grid_size=grid_size, **where).agg(F.min("n"), F.max("n")).first()
    return density_grid(rows, grid_size=grid_size, by=[F.to_date(time).alias("day")], **where).withColumns({"n_min": F.lit(least), "n_max": F.lit(most)})


def bounds(df: DataFrame, lat: str = "latitude1", lon: str = "longitude1") -> DataFrame:
    """Two rows, the south-western and the north-eastern corner of all rows: any :func:`extent` of them is that of ``df``."""
    ends = df.agg(*(f(c).alias(f"{c}_{n}") for c in (lon, lat) for n, f in (("low", F.min), ("high", F.max)))).first()
    return df.sparkSession.createDataFrame([(ends[0], ends[2]), (ends[1], ends[3])], f"`{lon}` double, `{lat}` double")


def extent(df: DataFrame, zoom: float | str = "auto", lat: str = "latitude1", lon: str = "longitude1", aspect: bool = False) -> tuple[float, float, float, float]:
    """(west, east, south, north) of a map: a number z adds 1/z of the range on each side, ``auto`` a tenth; or a named view.

    For several maps of the same rows, the rows may be read once, by :func:`bounds`.
    """
    if isinstance(zoom, str) and zoom in VIEWS:
        return VIEWS[zoom]
    if isinstance(zoom, str) and zoom != "auto" or not isinstance(zoom, str) and not zoom > 0:
        raise ValueError(f"zoom must be a positive number, auto or one of {', '.join(VIEWS)}")
    x0, x1, y0, y1 = df.agg(F.min(lon), F.max(lon), F.min(lat), F.max(lat)).first()
    share = 0.1 if zoom == "auto" else 1 / zoom
    least = 0.1 if zoom == "auto" else 0.1 / zoom
    bx, by = (x1 - x0) * share or least, (y1 - y0) * share or least
    if aspect:  # the margins, not the whole map, are three wide to two high
        bx, by = max(bx, 1.5 * by), max(by, bx / 1.5)
    return x0 - bx, x1 + bx, y0 - by, y1 + by


def within_extent(df: DataFrame, box: tuple[float, float, float, float], lat: str = "latitude1", lon: str = "longitude1") -> DataFrame:
    return df.where(F.col(lon).between(box[0], box[1]) & F.col(lat).between(box[2], box[3]))


def scale_bar_km(box: tuple[float, float, float, float]) -> float:
    return (box[1] - box[0]) * 111 / 10
