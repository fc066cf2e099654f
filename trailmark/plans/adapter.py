"""Core tables derived from the driver's order tables, by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmark.plans.shared import dealt

#: Core table -> SQL that both Spark and DuckDB run; ``read`` names the base tables.
OBJECTS = """SELECT l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS oid, * FROM lineitem"""

SQL = {
    "collectingevent": """SELECT o_orderkey AS CollectingEventID, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS StartDate,
  CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS EndDate, o_orderpriority AS Remarks,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS LocalityID FROM orders""",
    "collectionobject": f"""SELECT oid AS CollectionObjectID, CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0
  THEN l_orderkey + 10000000 ELSE l_orderkey END AS CollectingEventID, l_linestatus AS Text1,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 1 ELSE 0 END AS YesNo2 FROM ({OBJECTS}) o""",
    "locality": """SELECT c_custkey AS LocalityID, CAST(c_custkey % 900 AS DOUBLE) AS MinElevation, CAST(c_custkey % 900 + 10 AS DOUBLE) AS MaxElevation,
  CAST(c_custkey % 5 AS DOUBLE) AS ElevationAccuracy,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey * 7919 % 1201 AS DOUBLE) / 100e0 - 6e0 END AS Latitude1,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey * 104729 % 2003 AS DOUBLE) / 100e0 - 10e0 END AS Longitude1,
  c_name AS LocalityName, c_mktsegment AS NamedPlace, CAST(c_nationkey AS BIGINT) AS GeographyID FROM customer""",
    "geography": """SELECT CAST(n_nationkey AS BIGINT) AS GeographyID, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey - 12e0 END AS CentroidLat,
  n_nationkey * 3e0 - 30e0 AS CentroidLon, lower(n_name) AS CommonName, concat(r_name, '/', n_name) AS FullName, n_name AS Name
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "determination": f"SELECT oid AS CollectionObjectID, l_partkey AS TaxonID, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS IsCurrent FROM ({OBJECTS}) o",
    "vtaxon2": "SELECT p_partkey AS TaxonID, CASE WHEN p_size % 10 = 0 THEN 1 ELSE 0 END AS RedactLocality FROM part",
}
_BASE = ("region", "nation", "customer", "part", "orders", "lineitem")


def core_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    base = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _BASE}
    base["lineitem"] = dealt(base["lineitem"], "l_orderkey")  # as the numbering of objects needs it
    out = {}
    for name, text in SQL.items():
        body = text
        for t in _BASE:
            body = body.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
        out[name] = spark.sql(body, **{t: df for t, df in base.items() if f"{{{t}}}" in body})
    return out


def core_ctes() -> str:
    """The same tables as common table expressions."""
    return ",\n".join(f"{name} AS ({text})" for name, text in SQL.items())
