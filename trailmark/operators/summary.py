"""Sizes, summaries, trajectories and samples of clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trailmark.plans.shared import forget, parts_of, stored

STC = "spatiotemporal_cluster_id"


def cluster_sizes(df: DataFrame, cluster: str = STC) -> DataFrame:
    return df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count("*").alias("size"))


def cluster_summary(df: DataFrame, cluster: str = STC) -> DataFrame:
    """One row: rows, clusters, mean, exact median, largest and smallest size; sizes are null without clusters."""
    sizes = cluster_sizes(df, cluster)
    return sizes.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("n_records"), F.count("*").alias("n_clusters"), F.avg("size").alias("mean_size"),
        F.median("size").alias("median_size"), F.max("size").alias("max_size"), F.min("size").alias("min_size"),
    )


def flag_counts(df: DataFrame, column: str = "spatial_flag") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def trajectory_segments(df: DataFrame, cluster: str = STC, lat: str = "latitude1", lon: str = "longitude1", time: str = "startdate", tie: str = "collectingeventid") -> DataFrame:
    """From each record to the next of its cluster in order of time: both ends and the time halfway, in epoch seconds.

    Rows are dealt by ranges of (cluster, time, tie), so a cluster of any size
    spreads over tasks; the last row of a range goes on to the first row of the
    next range that has rows.
    """
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    dated = df.where(F.col(time).isNotNull()).select(F.col(cluster).alias("_c"), F.col(time).alias("_time"), F.col(tie).alias("id"), F.col(lat).alias("lat"), F.col(lon).alias("lon"), seconds.alias("t"))
    order = ["_c", "_time", "id"]
    ranged = stored(dated.repartitionByRange(parts_of(dated), *order).withColumn("_part", F.spark_partition_id()), "segments")
    row = F.struct("id", "lat", "lon", "t")
    ranges = ranged.groupBy("_part").agg(F.min_by(F.struct("_c", row.alias("next")), F.struct(*order)).alias("first")).orderBy("_part")  # a row for each partition
    starts = ranges.collect()
    nexts = [(a["_part"], b["first"]) for a, b in zip(starts, starts[1:])]
    after = df.sparkSession.createDataFrame(nexts, ranges.schema).select("_part", F.col("first._c").alias("_nc"), F.col("first.next").alias("_beyond"))
    inner = F.lead(row).over(Window.partitionBy("_part", "_c").orderBy("_time", "id"))
    steps = ranged.withColumn("next", inner).join(F.broadcast(after), "_part", "left")
    to = F.coalesce("next", F.when(F.col("_c").eqNullSafe(F.col("_nc")), F.col("_beyond")))
    out = steps.withColumn("to", to).where("to IS NOT NULL").select(
        F.col("_c").alias(cluster), F.col("id").alias("from_id"), F.col("to.id").alias("to_id"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"),
        F.col("to.lat").alias("lat2"), F.col("to.lon").alias("lon2"), F.col("t").alias("t1"), F.col("to.t").alias("t2"),
    )
    return out.withColumn("t_mid", (F.col("t1") + F.col("t2")) / 2)


def seeded(key: str, seed: int) -> Column:
    """32 hexadecimal digits that depend on the key and the seed alone."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def sample_rows(df: DataFrame, n: int = 5000, seed: int = 42, key: str = "collectingeventid") -> DataFrame:
    """``n`` rows in order of a seeded hash of the key: the same rows however the data are dealt."""
    return df.orderBy(seeded(key, seed), key).limit(n)


def nearest_sizes(df: DataFrame, targets: list[int], cluster: str = STC) -> DataFrame:
    """For each target in turn, the cluster not yet taken whose size is nearest; ties to the smaller id.

    Each pick is one distributed top-1; targets are few.
    """
    sizes = stored(cluster_sizes(df, cluster), "sizes")
    spark, taken, rows = df.sparkSession, [], []
    for target in targets:
        left = sizes.where(~F.col(cluster).isin(taken)) if taken else sizes
        pick = left.orderBy(F.abs(F.col("size") - target), cluster).limit(1).collect()
        if pick:
            taken.append(pick[0][cluster])
            rows.append((target, pick[0][cluster], pick[0]["size"]))
    forget(sizes)
    return spark.createDataFrame(rows, f"target int, {cluster} long, size long")
