"""A1: instants, offsets and files whose types don't merge, in sessions with
daylight saving."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from billmodel import CostModel, read_cur
from billmodel.sources.cur import conform, merging_groups
from conftest import line, make_bill

START, END = "line_item_usage_start_date", "line_item_usage_end_date"


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


def test_every_hour_of_both_changes(spark, zone):
    """Instants around the clock changes keep their hours apart in any zone."""
    hours = [dt.datetime(2024, 3, 10) + dt.timedelta(hours=h) for h in range(24)] + [dt.datetime(2024, 11, 3) + dt.timedelta(minutes=30 * h) for h in range(24)]
    hours += [dt.datetime(1969, 12, 31, 23, 59, 59, 500_000), dt.datetime(1883, 11, 18, 17, 0)]
    for name in ("America/New_York", "UTC", "Asia/Kolkata", "Africa/Casablanca"):
        zone("UTC")
        rows = spark.createDataFrame([(h.isoformat(sep=" "),) for h in hours], "s string")
        zone(name)
        bill = rows.select(F.concat("s", F.lit("Z")).cast("timestamp").alias(START), F.concat("s", F.lit("Z")).alias(END))
        got = conform(bill).select(START, END).collect()
        assert [r[0] for r in got] == hours and [r[1] for r in got] == hours


def test_offsets_in_texts(spark, zone):
    zone("America/New_York")
    texts = ["2024-11-03T05:30:00Z", "2024-11-03 05:30:00", "2024-11-03T11:00:00+05:30", "2024-11-03T11:00:00.000+0530", "2024-11-02 21:30:00 -08:00",
             "2024-11-02T21:30-08", "2024-11-03", " 2024-11-03 05:30:00 ", "", None]
    got = [r[0] for r in conform(spark.createDataFrame([(t,) for t in texts], f"{START} string")).select(START).collect()]
    half_past = dt.datetime(2024, 11, 3, 5, 30)
    assert got == [half_past] * 6 + [dt.datetime(2024, 11, 3), half_past, None, None]


def test_files_that_do_not_merge(spark, zone, tmp_path):
    """Prices as DOUBLE, two DECIMALs and text, times as instants, zone-less and
    text, a passed-through column of two types, one that comes later."""
    zone("America/New_York")
    bill = make_bill(spark, [line(line_item_unblended_cost="0.1", line_item_usage_start_date=dt.datetime(2024, 11, 3, h)) for h in (5, 6)])
    cost = "line_item_unblended_cost"
    forms = [bill, bill.withColumn(cost, F.col(cost).cast("double")).withColumn("extra", F.lit(1)),
             bill.withColumn(cost, F.col(cost).cast("decimal(20,10)")).withColumn("extra", F.lit("one")),
             bill.withColumn(cost, F.col(cost).cast("string")).withColumn(START, F.concat(F.col(START).cast("string"), F.lit("Z"))),
             bill.withColumn(START, F.concat(F.col(START).cast("string"), F.lit("Z")).cast("timestamp"))]
    for form in forms * 2:
        form.coalesce(1).write.mode("append").parquet(f"{tmp_path}/cur")
    assert len(merging_groups(spark, f"{tmp_path}/cur", [f"{tmp_path}/cur"])) <= len(forms)
    got = read_cur(spark, f"{tmp_path}/cur")
    assert dict(got.dtypes)[cost].startswith("decimal") and dict(got.dtypes)[START] == "timestamp_ntz" and dict(got.dtypes)["extra"] == "string"
    wide = CostModel(got).wide
    assert wide.count() == 20 and float(wide.agg({"bb_cost": "sum"}).first()[0]) == 2.0
    assert {r[0] for r in wide.select(START).distinct().collect()} == {dt.datetime(2024, 11, 3, 5), dt.datetime(2024, 11, 3, 6)}
    assert sorted(r[0] for r in wide.select("extra").where("extra is not null").collect()) == ["1"] * 4 + ["one"] * 4


def test_files_that_merge_are_read_as_they_were(spark, tmp_path):
    bill = make_bill(spark, [line()])
    bill.write.parquet(f"{tmp_path}/cur/month=1")
    bill.withColumn("extra", F.lit(1)).write.parquet(f"{tmp_path}/cur/month=2")
    assert merging_groups(spark, f"{tmp_path}/cur", [f"{tmp_path}/cur"]) == [[f"{tmp_path}/cur"]]
    got = read_cur(spark, f"{tmp_path}/cur")
    assert sorted((r.month, r.extra) for r in got.collect()) == [(1, None), (2, 1)]
    files = [f for f in got.inputFiles() if "month=2" in f]
    assert [(r.month, r.extra) for r in read_cur(spark, f"{tmp_path}/cur", files=files).collect()] == [(2, 1)]
