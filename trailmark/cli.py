"""Command line: ``python -m trailmark.cli [cluster|verify-redaction] ...``.

Exit codes: 0 done, 1 no data or an error, 2 a verification that failed.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from trailmark.operators import cluster, prepare, redact, summary
from trailmark.sources.tables import Connection, Source, parquet_source, write_csv

log = logging.getLogger("trailmark")


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trailmark")
    commands = top.add_subparsers(dest="command", required=True)
    base = argparse.ArgumentParser(add_help=False)
    for name, kind, default in (("host", str, "localhost"), ("port", int, 3306), ("user", str, "myuser"), ("password", str, ""), ("database", str, "exped_cluster_db")):
        base.add_argument(f"--{name}", type=kind, default=default)
    base.add_argument("--parquet", help="a folder of Parquet tables to read instead of the database")
    base.add_argument("--log-level", choices=("DEBUG", "INFO", "WARNING", "ERROR"), default="INFO")
    run = commands.add_parser("cluster", parents=[base], help="group records into trips and write them as CSV")
    run.add_argument("--e-dist", type=float, default=10.0, help="km")
    run.add_argument("--e-days", type=float, default=7.0)
    run.add_argument("--limit", type=int, help="rows read; 0 for all")
    run.add_argument("--include-centroids", action="store_true")
    run.add_argument("--output", default="data/clustered_expeditions.csv")
    hide = run.add_mutually_exclusive_group()
    hide.add_argument("--redact", action="store_true")
    hide.add_argument("--drop-redacted", action="store_true")
    check = commands.add_parser("verify-redaction", parents=[base], help="check that a CSV file holds nothing sensitive")
    check.add_argument("--input", required=True)
    check.add_argument("--expect-dropped", action="store_true")
    check.add_argument("--id-column", default=redact.ID)
    check.add_argument("--redacted-placeholder", default="*")
    check.add_argument("--max-offenders", type=int, default=10)
    return top


def _source(spark: SparkSession, args: argparse.Namespace) -> Source:
    if args.parquet:
        return parquet_source(spark, args.parquet)
    return Connection(args.host, args.user, args.password, args.database, args.port).source(spark)


def run_cluster(spark: SparkSession, args: argparse.Namespace) -> int:
    source = _source(spark, args)
    rows = prepare.extract({t: source(t) for t in ("collectingevent", "collectionobject", "locality", "geography")}, args.include_centroids, args.limit or None)
    if rows.isEmpty():
        log.error("no rows to cluster")
        return 1
    found = cluster.create_pipeline(args.e_dist, args.e_days).transform(rows)
    told = summary.cluster_summary(found).first()
    log.info("%d records in %d clusters, mean %.2f, median %.1f, largest %d", *(told[k] or 0 for k in ("n_records", "n_clusters", "mean_size", "median_size", "max_size")))
    if args.redact or args.drop_redacted:
        found, n = redact.redact(found, redact.redaction_flags(source, found.select(redact.ID)), drop_redacted=args.drop_redacted)
        log.info("%d rows redacted (%.2f %%)", n, redact.redacted_share(n, told["n_records"]))
    write_csv(found.drop("cluster_key"), args.output)
    found.limit(10).show(truncate=False)
    return 0


def run_verify(spark: SparkSession, args: argparse.Namespace) -> int:
    how = {} if args.expect_dropped else {"placeholder": args.redacted_placeholder}
    told = redact.verify_csv(spark, _source(spark, args), args.input, args.expect_dropped, args.id_column, **how)
    log.info("%d flagged rows, %s", told.flagged_rows, "as they should be" if told.ok else "some not redacted")
    if not told.ok:
        told.offenders.limit(args.max_offenders).show(truncate=False)
    return 0 if told.ok else 2


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    given = list(sys.argv[1:] if argv is None else argv)
    if not given or given[0].startswith("-") and given[0] not in ("-h", "--help"):
        given.insert(0, "cluster")
    args = _parser().parse_args(given)
    logging.basicConfig(level=args.log_level)
    spark = spark or SparkSession.builder.appName("trailmark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return run_cluster(spark, args) if args.command == "cluster" else run_verify(spark, args)
    except Exception:
        log.exception("failed")
        return 1


if __name__ == "__main__":
    sys.exit(main())
