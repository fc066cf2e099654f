"""Table sources and CSV files.

A *source* is any function from a table name to a DataFrame: JDBC, a folder of
Parquet files, or a dict of frames.  Filters, projections and limits are
expressed on the frame and pushed down by Spark.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.schema import DEFAULT_TABLES, TABLES, struct

Source = Callable[[str], DataFrame]
log = logging.getLogger("trailmark")


@dataclass(frozen=True)
class Connection:
    """Settings of a MySQL server, handed to Spark's JDBC reader as options; ``url`` and ``driver`` name another database."""

    host: str = "localhost"
    user: str = "myuser"
    password: str = field(default="", repr=False)
    database: str = "exped_cluster_db"
    port: int = 3306
    charset: str = "utf8mb4"
    url: str = ""
    driver: str = "com.mysql.cj.jdbc.Driver"

    def options(self) -> dict[str, str]:
        encoding = "UTF-8" if self.charset.lower().startswith("utf8") else self.charset
        return {
            "url": self.url or f"jdbc:mysql://{self.host}:{self.port}/{self.database}?characterEncoding={encoding}&zeroDateTimeBehavior=CONVERT_TO_NULL",
            "user": self.user, "password": self.password, "driver": self.driver,
        }

    def source(self, spark: SparkSession, partition_on: Mapping[str, tuple[str, int, int, int]] | None = None) -> Source:
        """Tables by JDBC; ``partition_on``: table -> (numeric column, lower, upper, partitions) for parallel reads."""

        def read(table: str) -> DataFrame:
            reader = spark.read.format("jdbc").options(**self.options()).option("dbtable", table)
            if partition_on and table in partition_on:
                column, low, high, n = partition_on[table]
                reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(n))
            return reader.load()

        return read


@contextmanager
def connected(spark: SparkSession, connection: Connection) -> Iterator[Source]:
    """A source for the time of a ``with`` block, after which it refuses to read; Spark opens and closes the connections of each job."""
    read, over = connection.source(spark), False

    def scoped(table: str) -> DataFrame:
        if over:
            raise RuntimeError("the connection is closed")
        return read(table)

    try:
        yield scoped
    finally:
        over = True


def parquet_source(spark: SparkSession, folder: str) -> Source:
    return lambda table: spark.read.parquet(f"{folder}/{table}.parquet")


def frames_source(frames: Mapping[str, DataFrame]) -> Source:
    return frames.__getitem__


def fetch(source: Source, table: str, columns: Sequence[str] | str = "*", where: Column | str | None = None, limit: int | None = None, order: str | None = None) -> DataFrame:
    """Filtered, projected and limited scan; a limit of None or 0 is no limit."""
    df = source(table)
    if where is not None:
        df = df.where(where)
    if columns != "*":
        df = df.select(*([columns] if isinstance(columns, str) else columns))
    if limit:
        df = (df.orderBy(order) if order else df).limit(limit)
    return df


def fetch_by_ids(source: Source, table: str, id_column: str, ids: DataFrame, columns: Sequence[str] | str = "*") -> DataFrame:
    """Rows whose ``id_column`` is among the non-null values of the one column of ``ids``; no ids, no rows, same schema."""
    keys = ids.select(F.col(ids.columns[0]).alias("_key")).where("_key IS NOT NULL").distinct()
    df = source(table)
    df = df.join(keys, df[id_column] == keys["_key"], "left_semi")
    return df if columns == "*" else df.select(*([columns] if isinstance(columns, str) else columns))


def _limit_of(table: str, limit: int | None, table_limits: Mapping[str, int] | None) -> int | None:
    return table_limits.get(table) if table_limits else limit


def load_core_tables(
    source: Source, tables: Sequence[str] = DEFAULT_TABLES, limit: int | None = None, table_limits: Mapping[str, int] | None = None, related_only: bool = False, primary_table: str = "collectionobject"
) -> dict[str, DataFrame]:
    """All ``tables`` by name; with ``related_only`` the core four hold only rows that belong together.

    Once ``table_limits`` has an entry, tables it does not list are unlimited.
    Starting from objects: objects with an event, their events, localities and
    geographies; from events: events, their objects, localities, geographies.
    An empty related table falls back to a limited plain load, with a warning.
    """
    of = lambda t: _limit_of(t, limit, table_limits)
    key = lambda t: next(iter(TABLES[t])) if t in TABLES else None
    plain = lambda t: fetch(source, t, limit=of(t), order=key(t))
    if not related_only:
        return {t: plain(t) for t in tables}
    primary = primary_table.lower()
    if primary not in ("collectionobject", "collectingevent"):
        raise ValueError("primary_table must be collectionobject or collectingevent")
    if "collectingevent" not in tables:
        raise ValueError("related_only needs the collectingevent table")

    def related(t: str, id_column: str, ids: DataFrame) -> DataFrame:
        df = fetch_by_ids(source, t, id_column, ids)
        if df.isEmpty():  # one small job, so that the plan can change
            log.warning("no %s rows are related; loading it without that condition", t)
            return plain(t)
        return df

    out: dict[str, DataFrame] = {}
    if primary == "collectionobject":
        objects = fetch(source, "collectionobject", where="CollectingEventID IS NOT NULL", limit=of("collectionobject"), order="CollectionObjectID")
        if objects.isEmpty():
            raise ValueError("no collectionobject row has an event")
        events = related("collectingevent", "CollectingEventID", objects.select("CollectingEventID"))
    else:
        events = plain("collectingevent")
        objects = related("collectionobject", "CollectingEventID", events.select("CollectingEventID"))
    out |= {"collectionobject": objects, "collectingevent": events}
    if "locality" in tables:
        out["locality"] = related("locality", "LocalityID", events.select("LocalityID"))
        if "geography" in tables:
            out["geography"] = related("geography", "GeographyID", out["locality"].select("GeographyID"))
    return {t: out[t] if t in out else plain(t) for t in tables}


def declared(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A core table from CSV with its declared schema, not an inferred one."""
    return spark.read.csv(f"{folder}/{table}.csv", header=True, schema=struct(table), multiLine=True, escape='"')


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with quoted line breaks; without a schema types are inferred by a pass over the file."""
    return spark.read.csv(path, header=True, schema=schema, inferSchema=schema is None, multiLine=True, escape='"')


def write_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """CSV with a header at ``path``.

    With ``single_file`` the rows go into one file of that name (one task
    writes it), else into a folder of parts, which is what large outputs want.
    Writing goes to a folder beside the target first, so a path may be replaced
    while it is being read; what was there is put aside until the new rows are in
    place, so a crash at any point leaves one of the two.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs, staging = target.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(path + ".writing")
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(staging.toString(), header=True, escape='"', emptyValue='""')
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    made = staging
    if single_file:
        parts = [s.getPath() for s in fs.listStatus(staging) if s.getPath().getName().startswith("part-")]
        made = parts[0]
    aside = jvm.org.apache.hadoop.fs.Path(path + ".before")
    if fs.exists(target):
        fs.delete(aside, True)
        if not fs.rename(target, aside):
            raise OSError(f"cannot put {path} aside")
    if not fs.rename(made, target):
        if fs.exists(aside):
            fs.rename(aside, target)
        raise OSError(f"cannot write {path}; the rows are in {made}")
    fs.delete(aside, True)
    fs.delete(staging, True)
