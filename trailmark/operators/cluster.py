"""Spatiotemporal clusters: alternating refinement by place and by time.

With one point enough to make a cluster, density clustering is connected
components.  In time that is gaps and islands over the distinct days of a
block; on the sphere it is the components of an epsilon join.  Starting from
spatial components, blocks are split by time, then by place, and so on until a
round splits nothing.  A block's key is its least event id, so results do not
depend on row order or on how the data are dealt.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trailmark.functions.geo import chord, haversine_km, unit_vector
from trailmark.operators.components import connected_components, contracted
from trailmark.operators.prepare import preprocess
from trailmark.plans.shared import forget, parts_of, stored

#: Candidate pairs of undecided cells above which the components found so far are used to drop most of them.
MANY_PAIRS = 20_000_000
#: Links between cells up to which one task, of some 20 MB, finds the components.
FEW_LINKS = 500_000

#: Tiles are cubes of two to the power of this many cells on each side; the sphere passes through some 2,000 cells of one, so their links fit a task.
TILE_BITS = 5

#: Half of the neighbouring cells within two steps on each axis; the other half is met from the other side.
_OFFSETS = [d for d in itertools.product(range(-2, 3), repeat=3) if d > (0, 0, 0)]


def _positive(**values: float) -> None:
    for name, v in values.items():
        if not v > 0:
            raise ValueError(f"{name} must be positive")


def _cells(nodes: DataFrame, e_dist: float) -> DataFrame:
    """Add the cell of each node; all points of a cell are within ``e_dist`` of one another."""
    side = chord(e_dist) * (1 - 1e-9) / math.sqrt(3)
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    return nodes.withColumns({n: F.floor(v / F.lit(side)).cast("long") for n, v in zip(("cx", "cy", "cz"), (x, y, z))})


def _cell_components(links: DataFrame) -> DataFrame:
    """Components of links a - b.  The links of a tile, of neighbouring cells, lie in one task, which first puts in their stead one for each cell."""
    tiled = links.repartition(parts_of(links), "tile").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return connected_components(contracted(tiled), few=FEW_LINKS)


def spatial_components(points: DataFrame, e_dist: float) -> DataFrame:
    """(block, lat, lon, label): components of ``points`` (block, lat, lon, id) within each block; label is the least id.

    Distinct places of a block are the nodes.  The cells are so small that
    their nodes are linked without a test, each to the cell's least node.  Two
    cells are linked once any pair of their nodes is near: first each cell's
    least node is tried against the other cell, which costs a row for each node
    and neighbour, and only cell pairs still undecided, and not joined through
    others already, have their nodes compared.
    """
    _positive(e_dist=e_dist)
    nodes = stored(_cells(points.groupBy("block", "lat", "lon").agg(F.min("id").alias("node")), e_dist), "places")
    cell = ["block", "cx", "cy", "cz"]
    heads = nodes.groupBy(*cell).agg(F.min_by(F.struct("node", "lat", "lon"), "node").alias("h"), F.count("*").alias("n"))
    heads = heads.select(*cell, F.col("h.node").alias("head"), F.col("h.lat").alias("hlat"), F.col("h.lon").alias("hlon"), "n")
    busy = heads.join(heads.groupBy("block").agg(F.count("*").alias("_c")).where("_c > 1"), "block", "left_semi")  # other blocks have one cell only
    offsets = F.expr("array(" + ", ".join("named_struct('dx', {}L, 'dy', {}L, 'dz', {}L)".format(*d) for d in _OFFSETS) + ")")
    left = busy.select(*cell, "head", "hlat", "hlon", "n", F.explode(offsets).alias("d"))
    left = left.select("block", (F.col("cx") + F.col("d.dx")).alias("cx"), (F.col("cy") + F.col("d.dy")).alias("cy"), (F.col("cz") + F.col("d.dz")).alias("cz"), F.col("head").alias("a"), F.col("hlat").alias("alat"), F.col("hlon").alias("alon"), F.col("n").alias("an"))
    tile = F.xxhash64("block", *(F.shiftright(c, TILE_BITS) for c in ("cx", "cy", "cz"))).alias("tile")
    pairs = stored(left.join(busy.select(*cell, F.col("head").alias("b"), F.col("hlat").alias("blat"), F.col("hlon").alias("blon"), F.col("n").alias("bn")), cell).withColumn("tile", tile), "cellpairs")
    near = lambda a, b: haversine_km(F.col(f"{a}lat"), F.col(f"{a}lon"), F.col(f"{b}lat"), F.col(f"{b}lon")) <= F.lit(float(e_dist))
    head_of = nodes.join(heads.select(*cell, "head", "n"), cell).where("n > 1").select("head", F.col("lat").alias("mlat"), F.col("lon").alias("mlon"))
    link = ["a", "b", "tile"]
    direct = pairs.where(near("a", "b")).select(*link)
    apart = pairs.where(~near("a", "b") & ((F.col("an") > 1) | (F.col("bn") > 1)))
    first = apart.where("bn > 1").join(head_of.withColumnRenamed("head", "b"), "b").where(near("a", "m")).select(*link)
    second = apart.where("an > 1").join(head_of.withColumnRenamed("head", "a"), "a").where(near("b", "m")).select(*link)
    links = stored(direct.unionAll(first).unionAll(second).distinct(), "celllinks")
    open_ = apart.where("an > 1 AND bn > 1").join(links, ["a", "b"], "left_anti").select(*link, "an", "bn")
    volume = open_.agg(F.sum(F.col("an") * F.col("bn"))).first()[0] or 0
    if volume:
        if volume > MANY_PAIRS:
            so_far = _cell_components(links)
            label = lambda side: open_label.join(so_far.select(F.col("node").alias(side), F.col("component").alias(f"{side}_of")), side, "left").withColumn(f"{side}_of", F.coalesce(f"{side}_of", side))
            open_label = open_
            for side in ("a", "b"):
                open_label = label(side)
            open_ = open_label.where("a_of <> b_of").select(*link)
        full = (
            open_.select(*link)
            .join(head_of.select(F.col("head").alias("a"), F.col("mlat").alias("alat"), F.col("mlon").alias("alon")), "a")
            .join(head_of.select(F.col("head").alias("b"), F.col("mlat").alias("blat"), F.col("mlon").alias("blon")), "b")
            .where(near("a", "b")).select(*link).distinct()
        )
        more = stored(links.unionAll(full), "celllinks")
        forget(links)
        links = more
    groups = _cell_components(links)
    labelled = nodes.join(heads.select(*cell, "head"), cell).join(groups, F.col("head") == groups["node"], "left")
    out = stored(labelled.select("block", "lat", "lon", F.coalesce("component", "head").alias("label")), "spatial")
    for used in (pairs, links):
        forget(used)
    return out


def temporal_components(points: DataFrame, e_days: float) -> DataFrame:
    """(block, day, label): islands of days no more than ``e_days`` apart within each block; label is the least id.

    A block has a row for each of its days, which the calendar bounds, so even
    a block with a third of all points is a small window.
    """
    _positive(e_days=e_days)
    days = points.groupBy("block", "day").agg(F.min("id").alias("first"))
    order = Window.partitionBy("block").orderBy("day")
    island = F.sum(F.when(F.col("day") - F.lag("day").over(order) > F.lit(float(e_days)), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.withColumn("island", island).withColumn("label", F.min("first").over(Window.partitionBy("block", "island"))).select("block", "day", "label")


def by_place(points: DataFrame, e_dist: float) -> DataFrame:
    return points.join(spatial_components(points, e_dist), ["block", "lat", "lon"]).withColumn("block", F.col("label")).drop("label")


def by_time(points: DataFrame, e_days: float) -> DataFrame:
    return points.join(temporal_components(points, e_days), ["block", "day"]).withColumn("block", F.col("label")).drop("label")


def _points(df: DataFrame, *block: str) -> DataFrame:
    """(id, lat, lon, day, block): the columns that clustering needs; ``block`` columns become one key, their least id, and follow."""
    need = ["collectingeventid", "latitude1", "longitude1", "startdate", *block]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    rows = df.select(
        F.col("collectingeventid").cast("long").alias("id"),
        # -180 and 180 are one meridian; zero has one sign
        (F.col("latitude1").cast("double") + F.lit(0.0)).alias("lat"), (F.col("longitude1").cast("double") + F.lit(0.0)).alias("lon"),
        F.unix_date(F.to_date("startdate")).alias("day"), *block,
    )
    if not block:
        return rows.withColumn("block", F.lit(0).cast("long"))
    names = {c: f"_of_{c}" for c in block}
    keys = rows.groupBy(*(F.col(c).alias(n) for c, n in names.items())).agg(F.min("id").alias("block"))
    return rows.join(keys, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]).select("id", "lat", "lon", "day", "block", *block)


def dense_ids(keys: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number distinct ``keys`` 0, 1, ... in ``order``, without sorting them in one task."""
    ranged = stored(keys.distinct().repartitionByRange(parts_of(keys), *order).withColumn("_part", F.spark_partition_id()), "keys")
    sizes = {r["_part"]: r["count"] for r in ranged.groupBy("_part").count().collect()}  # a row for each partition
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    start = F.element_at(F.array(*(F.lit(s).cast("long") for s in starts or [0])), F.col("_part") + 1)
    numbered = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn(name, start + numbered).drop("_part")


def _numbered(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Replace column ``name`` of ``df`` by dense ids of the ``block`` that ``keys`` (id, block) gives each event."""
    dense = dense_ids(keys.select("block"), ["block"], name)
    label = keys.join(dense, "block").select(F.col("id").alias("_id"), name)
    return df.drop(name).join(label, df["collectingeventid"] == label["_id"], "left").drop("_id")


def spatial_dbscan(df: DataFrame, e_dist: float) -> DataFrame:
    """Add spatial_cluster_id: components of places within ``e_dist`` km, numbered by their least event.

    What it returns also carries the components themselves, so that
    :func:`iterative_clustering`, given just that, need not find them again.
    """
    placed = stored(by_place(_points(df), e_dist), "placed")
    out = _numbered(df, placed, "spatial_cluster_id")
    out._placed = (e_dist, df, placed)
    return out


def temporal_dbscan(df: DataFrame, e_days: float) -> DataFrame:
    """Add temporal_cluster_id: day islands within each spatial cluster, numbered from 0 there by their least event."""
    found = stored(by_time(_points(df, "spatial_cluster_id"), e_days).select("id", "block", "spatial_cluster_id"), "islands")
    islands = found.select("spatial_cluster_id", "block").distinct()
    rank = islands.withColumn("temporal_cluster_id", (F.row_number().over(Window.partitionBy("spatial_cluster_id").orderBy("block")) - 1).cast("long")).select("block", "temporal_cluster_id")
    label = found.join(rank, "block").select(F.col("id").alias("_id"), "temporal_cluster_id")
    return df.drop("temporal_cluster_id").join(label, df["collectingeventid"] == label["_id"], "left").drop("_id")


def _split(df: DataFrame, column: str, within: list[str], labels: DataFrame) -> DataFrame:
    """Give all but the first piece of each ``within`` group a new ``column`` id, from its maximum on, in order of group and piece."""
    top = df.agg(F.max(column)).first()[0]
    labels = stored(labels.select("id", "block", *within), "pieces")
    pieces = labels.groupBy(*within, "block").agg(F.min("id").alias("first"))
    base = pieces.groupBy(*within).agg(F.min("first").alias("least"))
    extra = pieces.join(base, within).where("first <> least").select("block", *within)
    fresh = dense_ids(extra, [*within, "block"], "_n").select("block", (F.col("_n") + F.lit((top if top is not None else -1) + 1)).alias("_new"))
    moved = labels.join(fresh, "block").select(F.col("id").alias("_id"), "_new")
    return df.join(moved, df["collectingeventid"] == moved["_id"], "left").withColumn(column, F.coalesce("_new", F.col(column).cast("long"))).drop("_id", "_new")


def spatial_reconnect_within_temporal(df: DataFrame, e_dist: float) -> DataFrame:
    """Split each (spatial, temporal) group into its spatial components; the first keeps the spatial id."""
    within = ["spatial_cluster_id", "temporal_cluster_id"]
    return _split(df, "spatial_cluster_id", within, by_place(_points(df, *within), e_dist))


def temporal_recompute(df: DataFrame, e_days: float) -> DataFrame:
    return temporal_dbscan(df, e_days)


def combine_clusters(df: DataFrame) -> DataFrame:
    """Add spatiotemporal_cluster_id: pairs of spatial and temporal id, numbered by their least event."""
    df = df.drop("spatiotemporal_cluster_id", "spatiotemporal_cluster_id_x", "spatiotemporal_cluster_id_y")
    return _numbered(df, stored(_points(df, "spatial_cluster_id", "temporal_cluster_id").select("id", "block"), "combined"), "spatiotemporal_cluster_id")


def spatial_reconnect_within_spatiotemporal(df: DataFrame, e_dist: float) -> DataFrame:
    """Split each cluster into its spatial components; without that column nothing changes."""
    stc = "spatiotemporal_cluster_id"
    return _split(df, stc, [stc], by_place(_points(df, stc), e_dist)) if stc in df.columns else df


def temporal_reconnect_within_spatiotemporal(df: DataFrame, e_days: float) -> DataFrame:
    """Split each cluster into its day islands; without that column nothing changes."""
    stc = "spatiotemporal_cluster_id"
    return _split(df, stc, [stc], by_time(_points(df, stc), e_days)) if stc in df.columns else df


def disconnects(df: DataFrame, e_dist: float, e_days: float) -> DataFrame:
    """spatiotemporal_cluster_id, size, n_spatial, n_temporal of every cluster."""
    stc = "spatiotemporal_cluster_id"
    points = stored(_points(df, stc), "blocks")
    place = by_place(points, e_dist).groupBy(stc).agg(F.count("*").alias("size"), F.count_distinct("block").alias("n_spatial"))
    time = by_time(points, e_days).groupBy(stc).agg(F.count_distinct("block").alias("n_temporal"))
    return place.join(time, stc)


def validate_connectivity(df: DataFrame, e_dist: float, e_days: float) -> DataFrame:
    """``df`` itself, or ValueError with up to ten samples if a cluster is disconnected in space or time."""
    if "spatiotemporal_cluster_id" not in df.columns:
        raise ValueError("missing column: spatiotemporal_cluster_id")
    told = stored(disconnects(df, e_dist, e_days), "told")
    counts = told.agg(*(F.count_if(F.col(f"n_{kind}") > 1).alias(kind) for kind in ("spatial", "temporal"))).first()
    problems = []
    for kind, n in counts.asDict().items():
        if n:
            bad = told.where(F.col(f"n_{kind}") > 1)
            sample = bad.orderBy("spatiotemporal_cluster_id").limit(10).collect()
            shown = ", ".join(f"id={r[0]} comps={r[f'n_{kind}']} size={r['size']}" for r in sample)
            problems.append(f"{n} clusters are {'spatially' if kind == 'spatial' else 'temporally'} disconnected: {shown}")
    forget(told)
    if problems:
        raise ValueError("; ".join(problems))
    return df


def refine(placed: DataFrame, e_dist: float, e_days: float, max_iter: int = 5) -> DataFrame:
    """Fixpoint of splitting by place and by time: (id, lat, lon, day, block, spatial_key), from ``placed``, the stored points in their spatial components.

    ``spatial_key`` is the spatial component that an event's piece was last cut
    from, or the piece's own key where it is not that component's first piece.
    The partition after round k is P(2k+3); ValueError if P(2*max_iter+3) is not
    the fixpoint.  Splitting never merges, so equal block counts mean equal
    partitions.
    """
    now = placed.withColumn("spatial_key", F.col("block"))
    first = now
    count = lambda df: df.agg(F.count_distinct("block")).first()[0]
    blocks, depth = count(now), 0
    while True:
        timed = stored(by_time(now, e_days), "refined")
        after_time = count(timed)
        if after_time == blocks:  # connected in place before, and still in one piece each
            forget(timed)
            break
        # a group's first piece keeps its spatial key
        before = timed.withColumn("was", F.col("block"))
        placed = stored(by_place(before, e_dist).withColumn("spatial_key", F.when(F.col("block") == F.col("was"), F.col("spatial_key")).otherwise(F.col("block"))).drop("was"), "refined")
        forget(timed)
        if now is not first:
            forget(now)
        now, depth, after_place = placed, depth + 2, count(placed)
        blocks = after_place
        if after_place == after_time:
            break
        if depth > 2 * max_iter + 3:
            raise ValueError(f"clusters are still disconnected after {max_iter} iterations")
    return now


def iterative_clustering(df: DataFrame, e_dist: float, e_days: float, max_iter: int = 5) -> DataFrame:
    """Add cluster_key (the least event id) and dense spatiotemporal_cluster_id, spatial_cluster_id and temporal_cluster_id.

    ``max_iter`` of 0 returns ``df`` unlabelled.  An empty frame gets the columns and no rows.
    """
    _positive(e_dist=e_dist, e_days=e_days)
    if max_iter == 0:
        return df
    found_at, without, placed = getattr(df, "_placed", (None, df, None))
    own = None
    if found_at != e_dist:
        without, placed = df, (own := stored(by_place(_points(df), e_dist), "placed"))
    final = refine(placed, e_dist, e_days, max_iter)
    by_key = by_time(final.select("id", "day", "spatial_key", F.col("block").alias("_own"), F.col("spatial_key").alias("block")), e_days)
    keyed = stored(by_key.select(F.col("id").alias("_id"), F.col("_own").alias("block"), "spatial_key", F.col("block").alias("time_key")), "keyed")
    for used in (final, own):
        forget(used)
    labels = keyed
    for key, name in (("block", "spatiotemporal_cluster_id"), ("spatial_key", "spatial_cluster_id"), ("time_key", "temporal_cluster_id")):
        labels = labels.join(dense_ids(keyed.select(key), [key], name), key)
    labels = labels.select("_id", "spatial_cluster_id", "temporal_cluster_id", "spatiotemporal_cluster_id", F.col("block").alias("cluster_key"))
    clean = without.drop("spatial_cluster_id", "temporal_cluster_id", "spatiotemporal_cluster_id", "cluster_key")
    return clean.join(labels, clean["collectingeventid"] == labels["_id"]).drop("_id")


@dataclass(frozen=True)
class Pipeline:
    """Named steps, frames to frames, applied in order; a step may be replaced, added or left out by name."""

    named: tuple[tuple[str, Callable[[DataFrame], DataFrame]], ...]

    def steps(self) -> list[tuple[str, Callable[[DataFrame], DataFrame]]]:
        return list(self.named)

    def _at(self, name: str) -> int:
        names = [n for n, _ in self.named]
        if name not in names:
            raise KeyError(f"no step {name}; there are {', '.join(names)}")
        return names.index(name)

    def replaced(self, name: str, step: Callable[[DataFrame], DataFrame]) -> Pipeline:
        at = self._at(name)
        return Pipeline((*self.named[:at], (name, step), *self.named[at + 1 :]))

    def added(self, name: str, step: Callable[[DataFrame], DataFrame], before: str | None = None) -> Pipeline:
        if name in [n for n, _ in self.named]:
            raise KeyError(f"there is a step {name} already")
        at = len(self.named) if before is None else self._at(before)
        return Pipeline((*self.named[:at], (name, step), *self.named[at:]))

    def without(self, name: str) -> Pipeline:
        at = self._at(name)
        return Pipeline((*self.named[:at], *self.named[at + 1 :]))

    def transform(self, df: DataFrame) -> DataFrame:
        for _, step in self.named:
            df = step(df)
        return df


def create_pipeline(e_dist: float = 10.0, e_days: float = 7.0, max_iter: int = 5, as_of: str | None = None) -> Pipeline:
    """Clean, cluster by place, refine by place and time until nothing splits, validate."""
    _positive(e_dist=e_dist, e_days=e_days)
    return Pipeline(
        (
            ("preprocessor", lambda df: stored(preprocess(df, as_of), "fit")),  # the steps read it many times
            ("spatial_dbscan", lambda df: spatial_dbscan(df, e_dist)),
            ("iterative_spatiotemporal", lambda df: stored(iterative_clustering(df, e_dist, e_days, max_iter), "clustered")),
            ("validate_connectivity", lambda df: validate_connectivity(df, e_dist, e_days)),
        )
    )
