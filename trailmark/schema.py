"""Column lists and declared types of the core tables: fixed values of the interface, in their natural order."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, TEXT, INT, STAMP = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType(), T.TimestampNTZType()

TABLES: dict[str, dict[str, T.DataType]] = {
    "collectingevent": {"CollectingEventID": LONG, "StartDate": STAMP, "EndDate": STAMP, "Remarks": TEXT, "LocalityID": LONG},
    "collectionobject": {"CollectionObjectID": LONG, "CollectingEventID": LONG, "Text1": TEXT, "YesNo2": INT},
    "locality": {
        "LocalityID": LONG, "MinElevation": DOUBLE, "MaxElevation": DOUBLE, "ElevationAccuracy": DOUBLE, "Latitude1": DOUBLE,
        "Longitude1": DOUBLE, "LocalityName": TEXT, "NamedPlace": TEXT, "GeographyID": LONG,
    },
    "geography": {"GeographyID": LONG, "CentroidLat": DOUBLE, "CentroidLon": DOUBLE, "CommonName": TEXT, "FullName": TEXT, "Name": TEXT},
    "determination": {"CollectionObjectID": LONG, "TaxonID": LONG, "IsCurrent": INT},
    "vtaxon2": {"TaxonID": LONG, "RedactLocality": INT},
}

#: What a full load reads; those without a declared schema are passed through.
DEFAULT_TABLES = (
    "collectingevent", "collectingeventattribute", "collectionobject", "collectionobjectattachment", "attachment",
    "locality", "localitydetail", "geography", "geocoorddetail",
)
REQUIRED = ("collectingevent", "collectionobject", "geography", "locality")

#: Columns that the joins keep, by table; YesNo2 serves redaction only.
KEPT = {t: [c for c in TABLES[t] if c != "YesNo2"] for t in REQUIRED}

TEXT_SENSITIVE = ("localityname", "namedplace", "locality", "municipality", "localityremarks", "verbatimlatitude", "verbatimlongitude")
COORDINATES_SENSITIVE = ("latitude1", "longitude1", "centroidlat", "centroidlon")


def struct(table: str) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in TABLES[table].items()])
