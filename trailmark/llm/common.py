"""Small pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.plans.shared import ship

#: Arrow batches are cut by bytes as well as by rows, so that very long texts stay within a worker's memory.
ARROW_ROWS, ARROW_BYTES = 2000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``ARROW_ROWS`` rows and, but for single rows, about ``ARROW_BYTES``."""
    if batch.num_rows < 2 or batch.num_rows <= ARROW_ROWS and batch.nbytes <= ARROW_BYTES:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from cut(batch.slice(0, half))
        yield from cut(batch.slice(half))


def arrow_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``run`` over the Arrow batches of each partition, cut small; the session's own settings stay as they are."""
    ship(df.sparkSession)
    return df.mapInArrow(lambda batches: run(x for batch in batches for x in cut(batch)), schema)


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % n


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, nulls as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` over every small Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return arrow_batches(df, run, schema)


def beside(keep: list[str] | tuple[str, ...], new: tuple[str, ...]) -> dict[str, str]:
    """Names under which the columns of ``keep`` stay apart from ``new`` ones: itself, or one with underscores added."""
    taken, out = {*map(str.lower, keep), *map(str.lower, new)}, {}
    for c in keep:
        name = c
        while c.lower() in map(str.lower, new) and name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out[c] = name
    return out
