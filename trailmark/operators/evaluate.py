"""How well cluster labels agree with labels made by hand."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators.summary import seeded
from trailmark.plans.shared import forget, stored

PARAM_GRID = {"e_dist": [0.1, 1, 5, 10, 15, 20], "e_days": [3, 5, 7, 9, 10]}
PENALTY = 100.0


def _pairs(n):
    return n * (n - 1) / 2


def adjusted_rand(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """One row, ``ari``: the adjusted Rand index over rows where both labels are known; null without such rows.

    Everything comes from the contingency table; its margins are sums over it.
    """
    cells = df.where(F.col(true).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(true).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").cast("double").alias("n"))
    both = cells.agg(F.sum(_pairs(F.col("n"))).alias("both"), F.sum("n").alias("total"))
    margin = lambda by, name: cells.groupBy(by).agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias(name))
    one = both.crossJoin(margin("t", "rows")).crossJoin(margin("p", "cols"))  # three single rows
    expected, most = F.col("rows") * F.col("cols") / F.nullif(_pairs(F.col("total")), F.lit(0.0)), (F.col("rows") + F.col("cols")) / 2
    ari = F.when(F.col("total").isNull(), None).when(F.coalesce(most - expected, F.lit(0.0)) == 0, 1.0).otherwise((F.col("both") - expected) / F.nullif(most - expected, F.lit(0.0)))
    return one.select(ari.cast("double").alias("ari"))


def penalised_ari(df: DataFrame, true: str, predicted: str, penalty: float = PENALTY) -> DataFrame:
    """One row: ari, n_collisions, score = max(0, ari - penalty * collisions / rows).

    A collision is a row without a true label in a cluster that has a row with
    one.  Without rows that have both labels the score is 0.
    """
    per = df.groupBy(predicted).agg(F.count_if(F.col(true).isNull()).alias("free"), F.count_if(F.col(true).isNotNull()).alias("held"), F.count("*").alias("n"))
    per = per.agg(F.coalesce(F.sum(F.when((F.col("held") > 0) & F.col(predicted).isNotNull(), F.col("free")).otherwise(0)), F.lit(0)).alias("n_collisions"), F.sum("n").alias("rows"))
    score = F.greatest(F.lit(0.0), F.coalesce(F.col("ari") - F.lit(penalty) * F.col("n_collisions") / F.col("rows"), F.lit(0.0)))
    return adjusted_rand(df, true, predicted).crossJoin(per).select("ari", "n_collisions", score.alias("score"))


def size_difference(df: DataFrame, manual: str = "cluster", predicted: str = "spatiotemporal_cluster_id", order: str = "collectingeventid", n_clusters: int = 10) -> DataFrame:
    """One row, ``score``: mean over manual clusters 0..n-1 of |manual size - predicted size| / manual size.

    The predicted cluster is that of the manual cluster's first row; an empty
    manual cluster adds nothing, but still counts in the mean.
    """
    hand = df.where(F.col(manual).between(0, n_clusters - 1)).groupBy(manual).agg(F.count("*").alias("m"), F.min_by(predicted, order).alias("_p"))
    sizes = df.groupBy(F.col(predicted).alias("_p")).agg(F.count("*").alias("a"))
    told = hand.join(sizes, "_p", "left").select((F.abs(F.col("m") - F.coalesce("a", F.lit(0))) / F.col("m")).alias("d"))
    return told.agg((F.coalesce(F.sum("d"), F.lit(0.0)) / n_clusters).alias("score"))


def score_clustering(cluster: Callable[[DataFrame], DataFrame], df: DataFrame, labels: DataFrame, key: str = "collectingeventid") -> float:
    """Penalised agreement of ``cluster(df)`` with ``labels`` (key, label), matched by key."""
    found = stored(cluster(df).join(labels.toDF(key, "_label"), key, "left").select("_label", "spatiotemporal_cluster_id"), "scored")
    score = penalised_ari(found, "_label", "spatiotemporal_cluster_id").first()["score"]
    forget(found)  # the clustering runs once, whatever the score reads
    return score


def folds(df: DataFrame, k: int = 5, seed: int = 42, key: str = "collectingeventid") -> list[DataFrame]:
    """Parts of about equal size, dealt by a seeded hash of the key."""
    fold = F.conv(F.substring(seeded(key, seed), 1, 8), 16, 10).cast("long") % k
    return [df.where(fold == i) for i in range(k)]


def kfold_scores(df: DataFrame, labels: DataFrame, make: Callable[[float, float], Callable[[DataFrame], DataFrame]], e_dists: Iterable[float], e_days: Iterable[float], k: int = 5) -> dict[tuple[float, float], float]:
    """Mean score over ``k`` seeded folds of the labelled rows for each pair of settings; ``make(e_dist, e_days)`` builds the clustering.

    Rows without a label take no part, so here the score is the adjusted Rand index.
    """
    key, label = labels.columns
    named = stored(labels.where(F.col(label).isNotNull()), "labels")
    rows = stored(df.join(named.select(key), key, "left_semi"), "folds")
    scores = {(a, b): sum(score_clustering(make(a, b), part, named) for part in folds(rows, k)) / k for a, b in product(e_dists, e_days)}
    forget(rows)
    forget(named)
    return scores


def grid_search(df: DataFrame, make: Callable[..., Callable[[DataFrame], DataFrame]], grid: Mapping[str, list] | None = None, n_clusters: int = 10) -> tuple[dict, float, list[float]]:
    """The settings with the least size difference (the first of equals), that difference, and all differences in grid order."""
    names, best, least, scores = sorted(grid or PARAM_GRID), None, float("inf"), []
    for values in product(*((grid or PARAM_GRID)[n] for n in names)):
        settings = dict(zip(names, values))
        scores.append(size_difference(make(**settings)(df), n_clusters=n_clusters).first()["score"])
        if scores[-1] < least:
            best, least = settings, scores[-1]
    return best, least, scores
