"""Intermediate tables that outlive an executor.

Iterative algorithms have to cut their lineage.  Everything here is written to
the folder the cluster names in ``spark.checkpoint.dir``, which the driver and
all executors share, so a lost executor never takes intermediate rows with it.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of Parquet files for one task, some 200,000 narrow rows; sizes from the other one on are Spark's way to say that it knows none.
PART_BYTES, UNKNOWN_BYTES = 4 << 20, 1 << 60


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; where none is configured, a temporary one (local masters only)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="trailmark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def stored(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the reread table."""
    path = f"{shared_dir(df.sparkSession)}/trailmark/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def parts_of(df: DataFrame) -> int:
    """How many tasks to deal the rows of ``df`` to: one for each ``PART_BYTES`` of the files it reads, ``spark.sql.shuffle.partitions`` at least.

    Tables whose size Spark does not know count as empty.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(s for s in sizes if s < UNKNOWN_BYTES) // PART_BYTES)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to so many tasks that none gets more as the input grows; small inputs are left as they are."""
    n = parts_of(df)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def forget(df: DataFrame | None) -> None:
    """Delete a table made by :func:`stored` once nothing reads it any more."""
    path = getattr(df, "_stored_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session, wherever the driver has loaded it from."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_trailmark_shipped", False) or not root.is_dir():
        return
    made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='trailmark-')}/{root.name}", "zip", root.parent, root.name)
    sc.addPyFile(made)
    sc._trailmark_shipped = True
