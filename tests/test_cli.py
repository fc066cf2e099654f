"""The command line over Parquet tables."""

import pytest

from trailmark import cli
from trailmark.sources.tables import read_csv


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("tables")
    tables = {
        "collectingevent": ([(1, "2020-01-01", None, "a", 10), (2, "2020-01-02", None, "b", 10), (3, "2020-05-02", None, "c", 20)], "CollectingEventID long, StartDate string, EndDate string, Remarks string, LocalityID long"),
        "collectionobject": ([(100, 1, "x", 0), (200, 2, "y", 1), (300, 3, "z", 0)], "CollectionObjectID long, CollectingEventID long, Text1 string, YesNo2 int"),
        "locality": ([(10, 1.0, 4.0, "here", 1000), (20, 2.0, 5.0, "there", 1000)], "LocalityID long, Latitude1 double, Longitude1 double, LocalityName string, GeographyID long"),
        "geography": ([(1000, 10.0, 15.0)], "GeographyID long, CentroidLat double, CentroidLon double"),
        "determination": ([(300, 7, 1)], "CollectionObjectID long, TaxonID long, IsCurrent int"),
        "vtaxon2": ([(7, 1)], "TaxonID long, RedactLocality int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{top}/{name}.parquet")
    return str(top)


@pytest.mark.parametrize("how, rows, code", [([], 3, 2), (["--redact"], 3, 0), (["--drop-redacted"], 1, 2)])
def test_cluster_and_verify(spark, folder, tmp_path, how, rows, code):
    out = str(tmp_path / "new" / "out.csv")
    assert cli.main(["--parquet", folder, "--output", out, *how], spark) == 0
    got = read_csv(spark, out)
    assert got.count() == rows and "spatiotemporal_cluster_id" in got.columns
    # what was dropped leaves nothing to be found; what was masked is found masked
    dropped = ["--expect-dropped"] if "--drop-redacted" in how else []
    assert cli.main(["verify-redaction", "--parquet", folder, "--input", out, *dropped], spark) == (0 if dropped else code)


def test_errors(spark, folder, tmp_path):
    assert cli.main(["cluster", "--parquet", str(tmp_path), "--log-level", "ERROR"], spark) == 1
    with pytest.raises(SystemExit):
        cli.main(["cluster", "--redact", "--drop-redacted"], spark)
