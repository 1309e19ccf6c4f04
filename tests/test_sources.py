"""Yearly CSV exports with the raw gauge headers, unioned by name."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stormlens.sources.readings import RAW_COLUMNS, load_fixture_readings, read_readings


def test_read_readings_unions_heterogeneous_exports(spark):
    root = tempfile.mkdtemp(prefix="stormlens-csv-")
    r = load_fixture_readings(spark, SF_SMALL)
    back = {v: k for k, v in RAW_COLUMNS.items()}
    raw = r.select(*[F.col(c).alias(back[c]) for c in RAW_COLUMNS.values()])
    y1 = raw.filter(F.col("DATA TIMESTAMP") < "1998")
    y2 = raw.filter(F.col("DATA TIMESTAMP") >= "1998").drop("RAINFALL TRACE")  # an export without the trace column
    y1.write.option("header", True).csv(os.path.join(root, "a1"))
    y2.write.option("header", True).csv(os.path.join(root, "a2"))
    got = read_readings(spark, [os.path.join(root, "a1"), os.path.join(root, "a2")])
    assert got.columns[:5] == ["station_id", "name", "data_timestamp", "rain_mm", "trace"]
    assert got.count() == r.count()
    assert got.filter(F.col("trace").isNull()).count() == y2.count()
    # values survive the text round trip (empty fields become NULL, not errors)
    s_got = got.agg(F.sum("rain_mm"), F.count("rain_mm")).first()
    s_exp = r.agg(F.sum("rain_mm"), F.count("rain_mm")).first()
    assert s_got[1] == s_exp[1] and abs(s_got[0] - s_exp[0]) < 1e-6


def test_one_glob_over_files_that_differ_in_order_and_columns(spark, tmp_path):
    """Every value lands in its own column, whatever the order of a file's header."""
    (tmp_path / "a1.csv").write_text("POS HUJAN ID,NAME,DATA TIMESTAMP,RAINFALL DAY MM,RAINFALL TRACE\nA,north,2001-01-01 00:00,1.5,N\n")
    (tmp_path / "a2.csv").write_text('RAINFALL DAY MM,DATA TIMESTAMP,POS HUJAN ID,NAME\n7.5,2002-01-01 00:00,B,"x, y"\n')
    (tmp_path / "a3.csv").write_text("")
    (tmp_path / "a4.csv").write_text("NAME,POS HUJAN ID,extra\nsouth,C,e\n")
    got = {r.station_id: r for r in read_readings(spark, f"{tmp_path}/a*.csv").collect()}
    assert {k: (r.name, r.data_timestamp, r.rain_mm, r.trace, r.extra) for k, r in got.items()} == {
        "A": ("north", "2001-01-01 00:00", 1.5, "N", None), "B": ("x, y", "2002-01-01 00:00", 7.5, None, None), "C": ("south", None, None, None, "e")}
