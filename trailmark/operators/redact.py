"""Masking or dropping sensitive records, and checking that it was done."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.convert import as_key
from trailmark.operators.prepare import lower_names
from trailmark.plans.shared import dealt
from trailmark.schema import COORDINATES_SENSITIVE, TEXT_SENSITIVE
from trailmark.sources.tables import Source, read_csv, write_csv

ID = "collectionobjectid"


@dataclass(frozen=True)
class MaskCheck:
    flagged_rows: int
    bad_locality_rows: int
    bad_coordinate_rows: int
    offenders: DataFrame

    @property
    def ok(self) -> bool:
        return not (self.bad_locality_rows or self.bad_coordinate_rows)


@dataclass(frozen=True)
class DropCheck:
    flagged_rows: int
    offenders: DataFrame

    @property
    def ok(self) -> bool:
        return not self.flagged_rows


def redaction_flags(source: Source, ids: DataFrame | None = None) -> DataFrame:
    """(collectionobjectid, is_redacted): 1 if the object is withheld or a current determination's taxon is.

    ``ids`` (one column) restricts the objects; without it all are flagged.
    """
    objects = lower_names(source("collectionobject")).select(ID, F.when(F.col("yesno2").cast("int") == 1, 1).otherwise(0).alias("_flag"), F.lit(1).alias("_known"))
    if ids is not None:
        keys = ids.select(as_key(F.col(ids.columns[0]), ids.dtypes[0][1]).alias(ID)).where(F.col(ID).isNotNull()).distinct()
        objects = dealt(objects, ID).join(keys, ID, "left_semi")
    # only determinations that flag are dealt; those of no object make no row
    taxa = lower_names(source("vtaxon2")).where(F.col("redactlocality").cast("int") == 1).select("taxonid")
    hits = lower_names(source("determination")).where("iscurrent = 1").join(taxa, "taxonid", "left_semi").where(F.col(ID).isNotNull()).select(ID, F.lit(1), F.lit(0))
    return dealt(objects.unionAll(hits), ID).groupBy(ID).agg(F.max("_flag").alias("is_redacted"), F.max("_known").alias("_known")).where("_known = 1").drop("_known")


def _flagged(df: DataFrame, flags: DataFrame, id_column: str) -> DataFrame:
    if id_column not in df.columns:
        raise KeyError(id_column)
    keys = flags.select(as_key(F.col(flags.columns[0]), flags.dtypes[0][1]).alias("_key"), F.col("is_redacted").cast("int").alias("_flag")).where("_key IS NOT NULL AND _flag <> 0")
    keys = dealt(keys, "_key").groupBy("_key").agg(F.max("_flag").alias("_flag"))  # a flag of 0 is as none, so conflicting flags fail closed
    df = df.drop("is_redacted")
    return df.join(keys, as_key(F.col(id_column), dict(df.dtypes)[id_column]) == F.col("_key"), "left").drop("_key")


def _hit() -> Column:
    return F.coalesce(F.col("_flag"), F.lit(0)) != 0


def masked(
    df: DataFrame, flags: DataFrame, id_column: str = ID, locality_columns=TEXT_SENSITIVE, coordinate_columns=COORDINATES_SENSITIVE, placeholder: str = "*", add_redaction_column: bool = False, drop_redacted: bool = False
) -> DataFrame:
    """Mask, or drop, the flagged rows, in one plan that runs nothing by itself.  Any flag but 0 counts."""
    marked, hit = _flagged(df, flags, id_column), _hit()
    if drop_redacted:
        return marked.where(~hit).drop("_flag")
    kinds = dict(df.dtypes)
    masks = {c: F.when(hit, F.lit(placeholder)).otherwise(F.col(c).cast("string")) for c in locality_columns if c in kinds}
    masks |= {c: F.when(~hit, F.col(c)) for c in coordinate_columns if c in kinds}
    if add_redaction_column:
        masks["is_redacted"] = F.when(hit, 1).otherwise(0)
    return marked.withColumns(masks).drop("_flag")


def redact(df: DataFrame, flags: DataFrame, id_column: str = ID, **how) -> tuple[DataFrame, int]:
    """As :func:`masked`, and how many rows were flagged, which takes a job.  Without flags nothing changes."""
    n = _flagged(df, flags, id_column).where(_hit()).count()
    if not n and flags.isEmpty():
        return df, 0
    return masked(df, flags, id_column, **how), n


def _one_each(df: DataFrame, id_column: str) -> DataFrame:
    """The least row of each id, so that it is the same one in every run."""
    return df.groupBy(F.col(id_column).alias("_id")).agg(F.min(F.struct(*df.columns)).alias("_row")).select("_row.*")


def event_flags(flags: DataFrame, objects: DataFrame) -> DataFrame:
    """(collectingeventid, is_redacted): an event is flagged if any of its objects is, not only the one that was kept."""
    of = lower_names(objects).select(ID, "collectingeventid").join(flags.select(ID, "is_redacted"), ID)
    return of.groupBy("collectingeventid").agg(F.max("is_redacted").alias("is_redacted"))


def redact_events(df: DataFrame, flags: DataFrame, objects: DataFrame, **how) -> tuple[DataFrame, int]:
    """As :func:`redact`, strictly: by the flags of whole events."""
    return redact(df, event_flags(flags, objects), id_column="collectingeventid", **how)


def verify_redaction(df: DataFrame, flags: DataFrame, id_column: str = ID, locality_columns=TEXT_SENSITIVE, coordinate_columns=COORDINATES_SENSITIVE, placeholder: str = "*") -> MaskCheck:
    """Flagged rows whose text is not the placeholder (null included) or that still have a coordinate."""
    marked = _flagged(df, flags, id_column).where("_flag = 1")
    any_of = lambda tests: F.greatest(*tests, F.lit(False)) if tests else F.lit(False)
    text = any_of([~F.col(c).cast("string").eqNullSafe(placeholder) for c in locality_columns if c in df.columns])
    place = any_of([F.col(c).isNotNull() for c in coordinate_columns if c in df.columns])
    told = marked.withColumns({"bad_locality": text, "bad_coordinates": place})
    n = told.agg(F.count("*"), F.count_if("bad_locality"), F.count_if("bad_coordinates")).first()
    return MaskCheck(*n, _one_each(told.where("bad_locality OR bad_coordinates").drop("_flag"), id_column))


def verify_redaction_drop(df: DataFrame, flags: DataFrame, id_column: str = ID) -> DropCheck:
    """Rows that should have been dropped."""
    left = _flagged(df, flags, id_column).where("_flag = 1").drop("_flag")
    return DropCheck(left.count(), _one_each(left, id_column))


def redacted_share(flagged: int, total: int) -> float:
    return 100.0 * flagged / total if total else 0.0


def redact_csv(spark: SparkSession, source: Source, input_path: str, output_path: str | None = None, id_column: str = ID, **how) -> tuple[str, int]:
    """Redact a CSV file, in place unless an output is named; the path and how many rows were flagged."""
    df = read_csv(spark, input_path)
    if id_column not in df.columns:
        raise KeyError(id_column)
    out, n = redact(df, redaction_flags(source, df.select(id_column)), id_column, **how)
    path = output_path or input_path
    write_csv(out, path)
    return path, n


def verify_csv(spark: SparkSession, source: Source, input_path: str, expect_dropped: bool = False, id_column: str = ID, **how) -> MaskCheck | DropCheck:
    df = read_csv(spark, input_path)
    if id_column not in df.columns:
        raise KeyError(id_column)
    flags = redaction_flags(source, df.select(id_column))
    return verify_redaction_drop(df, flags, id_column) if expect_dropped else verify_redaction(df, flags, id_column, **how)
