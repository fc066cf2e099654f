"""Connected components with DataFrame operations only.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014).  Every round is two aggregations
and two equi-joins whose exchanges adaptive execution may split when a hub
gathers many links; nothing but one count and one checksum reaches the driver.
Graphs of a counted, bounded number of links may be solved by one task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.plans.shared import forget, ship, stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionAll(least.select("hi", F.col("m").alias("lo"))).where("hi <> lo").distinct()


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the graph with links a[i] - b[i]."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.split(ends, 2)
    label = np.arange(len(nodes))
    while True:
        was = label.copy()
        low = np.minimum(label[x], label[y])
        for at in (x, y, was[x], was[y]):  # also the nodes that the ends are hung on
            np.minimum.at(label, at, low)
        while (label[label] != label).any():
            label = label[label]
        if (label == was).all():
            return nodes, nodes[label]


def _least_nodes(links: DataFrame, names: str) -> DataFrame:
    """Node and least node of its component within each partition of the two columns of ``links``."""
    columns = names.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if table:
            made = least_labels(*(np.concatenate(c) for c in zip(*table)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=columns)

    ship(links.sparkSession)
    return links.mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def contracted(links: DataFrame) -> DataFrame:
    """Links ``(src, dst)`` with the components of ``links``, two columns of longs: within each partition, every node is linked to the least it is connected with.

    A partition is held by its task, so the caller deals the links to enough of
    them; dealt by neighbourhood, few are left.
    """
    return _least_nodes(links, "src dst").where("src <> dst")


def _in_one_task(links: DataFrame) -> DataFrame:
    return _least_nodes(links.select("hi", "lo").coalesce(1), "node component")


def connected_components(links: DataFrame, max_rounds: int = 60, few: int = 0) -> DataFrame:
    """Components of an undirected graph given as links ``(src, dst)`` of one orderable type.

    Returns ``(node, component)`` with the least node of each component, for all
    nodes that have a link to another node.  Null ends and loops are ignored;
    repeated links count once; an empty input gives an empty result.  Up to
    ``few`` links, of longs, are solved in one task, which costs less than the
    rounds; more are not, so a task never holds more than that.
    """
    a, b = F.col("src"), F.col("dst")
    now = stored(links.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    if few and dict(now.dtypes)["hi"] == "bigint" and now.count() <= few:
        return _in_one_task(now)
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
        seen = tuple(mark)
        nxt = stored(_small_star(_large_star(now)), "links")
        forget(now)
        now = nxt
    raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
