"""Exact top-k search by inner product with MaxScore over sharded postings.

A vector is a bag of (term, integer weight); a term's posting list in a block
of candidates holds the rows with a weight other than zero.  For a query, the
bound of a term is the most it can add to any score of the block.  Terms are
ordered by how much they can move a score; the longest tail of that order whose
bounds sum to less than the k-th best score so far is non-essential.  Only
rows met in essential postings are scored; the other terms are probed one after
the other for the rows that can still reach the threshold.  A row is dropped
only if it is certain to score less than k rows already found, so ties survive
and the result is exact.

Candidates are dealt by row number into shards of bounded size, each row once.
Only queries are copied, one copy a shard: a task holds one shard, builds its
postings, and the queries stream past it in batches.  The shards' best k are
merged with a window whose group limit runs before its exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trailmark.llm.common import arrow_batches

#: Numbers of one shard; its rows are as many as that allows.
SHARD_CELLS = 4 << 20
#: The first rows of a shard are scored in full and give the first threshold.
SEED_ROWS = 256

_HITS = "query_id long, asked long, vec_id long, score long"


class Block:
    """Postings of some candidate rows, in the order of ``ids``."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.columns = np.ascontiguousarray(weights.T)
        self.postings = [np.flatnonzero(c) for c in self.columns]
        whole = [len(p) == self.n for p in self.postings]
        self.high = np.array([c.max() if w else max(c.max(), 0) for c, w in zip(self.columns, whole)])
        self.low = np.array([c.min() if w else min(c.min(), 0) for c, w in zip(self.columns, whole)])

    def search(self, query: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may reach ``floor``, and their exact scores."""
        upper, lower = np.maximum(query * self.high, query * self.low), np.minimum(query * self.high, query * self.low)
        terms = np.argsort(lower - upper, kind="stable")
        terms = terms[query[terms] != 0]
        rest = np.concatenate([np.cumsum(upper[terms][::-1])[::-1], [0]])  # the most that terms from i on can add
        below = np.flatnonzero(rest < floor)
        essential = len(terms) if floor == -np.inf or not len(below) else int(below[0])
        score, met = np.zeros(self.n, self.columns.dtype), np.zeros(self.n, bool)
        if essential == len(terms) and rest[-1] >= floor:
            met[:] = True  # even a row in no posting may count
        for t in terms[:essential]:
            posting = self.postings[t]
            if len(posting) == self.n:
                met[:] = True
                score += query[t] * self.columns[t]
            else:
                met[posting] = True
                score[posting] += query[t] * self.columns[t][posting]
        rows = np.flatnonzero(met & (score + rest[essential] >= floor))
        score = score[rows]
        for i in range(essential, len(terms)):
            if not len(rows):
                break
            score = score + query[terms[i]] * self.columns[terms[i]][rows]
            keep = score + rest[i + 1] >= floor
            if not keep.all():
                rows, score = rows[keep], score[keep]
        return rows, score


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _exact(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers as Python's own, which have no bounds."""
    return np.array([[int(x) for x in v] for v in vectors], dtype=object).reshape(vectors.shape)


class Shard:
    """Some candidates, ready for queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.reach, self.blocks = ids, vectors, float(np.abs(vectors).max(initial=0)), {}

    def _blocks(self, kind: type) -> list[Block]:
        if kind not in self.blocks:
            v = self.vectors.astype(np.float64) if kind is np.float64 else _exact(self.vectors)
            self.blocks[kind] = [Block(self.ids[a:b], v[a:b]) for a, b in ((0, SEED_ROWS), (SEED_ROWS, len(v))) if a < min(b, len(v))]
        return self.blocks[kind]

    def best(self, query_id: int, query: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
        """(vec_id, score) of the best k candidates but those of the query's own id."""
        reach = self.reach * float(np.abs(query).max(initial=0)) * len(query)
        kind = np.float64 if reach < 2**53 else object  # sums are exact in doubles up to there
        query = query.astype(np.float64) if kind is np.float64 else _exact(query[None])[0]
        best_ids, best = np.empty(0, np.int64), np.empty(0, kind)
        for block in self._blocks(kind):
            rows, score = block.search(query, float(best[-1]) if len(best) == k and kind is np.float64 else -np.inf)
            found = block.ids[rows]
            others = found != query_id
            best_ids, best = _best(np.concatenate([best_ids, found[others]]), np.concatenate([best, score[others]]), k)
        return ((int(v), min(max(int(s), -(2**63)), 2**63 - 1)) for v, s in zip(best_ids, best))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_cells: int = SHARD_CELLS) -> DataFrame:
    """The k best candidates of each query: query_id, rank, vec_id, score.

    Both inputs have (vec_id long, weights); weights are an array of longs, or of
    doubles that are whole numbers, of any size.  Rows with a null id, a null or
    empty vector, or a weight that is null or not finite take no part.  Vectors of
    different lengths share the leading terms; what one lacks is zero.  A row
    never matches a query of its own id; repeated rows are candidates each.  Equal
    queries are answered once; if one id has several vectors, each is a query of
    its own with ranks of its own.  Ties go to the smaller vec_id.  Scores
    beyond 64 bits are clamped after ranking within a shard.  Extra columns are
    ignored, whatever they are called.  No query or no candidate gives an empty
    result.
    """
    kind = "double" if "double" in dict(vectors.dtypes)["weights"] or "double" in dict(queries.dtypes)["weights"] else "bigint"
    usable = "vec_id IS NOT NULL AND size(weights) > 0 AND NOT exists(weights, x -> x IS NULL OR isnan(x) OR abs(double(x)) = double('Infinity'))"
    plain = lambda df: df.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("weights").cast(f"array<{kind}>").alias("weights"))
    rows, asked = plain(vectors), plain(queries).distinct()
    n, width = rows.agg(F.count("*"), F.max(F.size("weights"))).first()
    width = max(width or 1, asked.agg(F.max(F.size("weights"))).first()[0] or 1)
    shards = max(1, -(-n // max(1, shard_cells // width)))
    pad = lambda c: F.concat(c, F.array_repeat(F.lit(0).cast(kind), F.lit(width) - F.size(c)))
    left = rows.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).alias("shard"), F.lit(0).alias("asks"), "vec_id", F.lit(0).cast("long").alias("asked"), pad(F.col("weights")).alias("weights"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    right = asked.select(every.alias("shard"), F.lit(1).alias("asks"), "vec_id", F.xxhash64("weights").alias("asked"), pad(F.col("weights")).alias("weights"))
    parts = min(shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = left.unionAll(right).repartition(parts, "shard").sortWithinPartitions("shard", "asks")
    cast = np.float64 if kind == "double" else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, shard = None, [], None
        for batch in batches:
            numbers, asks, ids, hashes = (c.to_numpy() for c in batch.columns[:4])
            values = batch.column(4).flatten().to_numpy().astype(cast).reshape(-1, width)
            cuts = np.flatnonzero(np.concatenate([[True], (numbers[1:] != numbers[:-1]) | (asks[1:] != asks[:-1]), [True]])) if len(ids) else []
            hits = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if numbers[a] != at:
                    at, held, shard = numbers[a], [], None
                if not asks[a]:
                    held.append((ids[a:b].copy(), values[a:b].copy()))
                elif held or shard:
                    if shard is None:
                        shard, held = Shard(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])), []
                    hits += [(q, h, *found) for q, h, query in zip(ids[a:b].tolist(), hashes[a:b].tolist(), values[a:b]) for found in shard.best(q, query, k)]
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*hits)], names=["query_id", "asked", "vec_id", "score"])

    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    return arrow_batches(dealt, run, _HITS).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
