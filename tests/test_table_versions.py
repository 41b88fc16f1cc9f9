"""The written wide table: one switch for all months, files by bytes, catalog."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from billmodel import CostModel
from billmodel.plans import registry
from billmodel.sources import sink
from billmodel.sources.fixture import lineitem_bill
from billmodel.sources.sink import MANIFESTS, VERSION, read_manifest, read_wide_table, vacuum, write_wide_table
from conftest import SF_SMALL, line, make_bill

MONTHS = {m: dt.datetime(2024, m, 1) for m in (1, 2, 3)}


def _wide(spark, *months, cost="1", **more):
    return CostModel(make_bill(spark, [line(line_item_usage_start_date=MONTHS[m], line_item_unblended_cost=cost, **more) for m in months])).wide


def _costs(df):
    return sorted((r.bb_usage_year_month, float(r.bb_cost)) for r in df.select("bb_usage_year_month", "bb_cost").collect())


def test_readers_see_the_old_or_the_new_table(spark, tmp_path):
    path = f"{tmp_path}/wide"
    write_wide_table(_wide(spark, 1, 2), path)
    reader = read_wide_table(spark, path)  # planned before, read after
    write_wide_table(_wide(spark, 2, 3, cost="5"), path, mode="months", months=["2024-01", "2024-02", "2024-03"])
    assert _costs(reader) == [("2024-01", 1.0), ("2024-02", 1.0)]
    # 2024-01 was asked for and came back empty: dropped in the same step
    assert _costs(read_wide_table(spark, path)) == [("2024-02", 5.0), ("2024-03", 5.0)]


def test_a_write_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/wide"
    write_wide_table(_wide(spark, 1, 2), path)
    boom = F.udf(lambda x: 1 / 0, "double")
    with pytest.raises(Exception):
        write_wide_table(_wide(spark, 2, cost="9").withColumn("bb_region", boom("bb_region")), path, mode="months")
    with monkeypatch.context() as m:  # after its data, before its manifest
        m.setattr(sink.files, "write_once", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            write_wide_table(_wide(spark, 2, cost="9"), path, mode="months")
    assert _costs(read_wide_table(spark, path)) == [("2024-01", 1.0), ("2024-02", 1.0)]
    for n in range(5):  # later writes clear what it left
        write_wide_table(_wide(spark, 2, cost=str(n)), path, mode="months")
    named = {(v, m) for n in sink.manifest_numbers(spark, path) for m, v in read_manifest(spark, path, n).months.items()}
    there = {(os.path.basename(os.path.dirname(p)).split("=")[1], os.path.basename(p).split("=")[1]) for p in glob.glob(f"{path}/{VERSION}=*/bb_usage_year_month=*")}
    assert there == named and len(sink.manifest_numbers(spark, path)) == sink.KEPT_VERSIONS


def test_two_writers_do_not_mix(spark, tmp_path, monkeypatch):
    """The manifest that a writer started from must still be the newest."""
    path = f"{tmp_path}/wide"
    write_wide_table(_wide(spark, 1), path)
    stale = read_manifest(spark, path)
    write_wide_table(_wide(spark, 2), path, mode="months")
    monkeypatch.setattr(sink, "read_manifest", lambda *a: stale)
    with pytest.raises(FileExistsError):
        write_wide_table(_wide(spark, 3), path, mode="months")
    monkeypatch.undo()
    assert [m for m, _ in _costs(read_wide_table(spark, path))] == ["2024-01", "2024-02"]


def test_months_of_other_columns_and_types(spark, tmp_path):
    """A tag that came later, a price stored otherwise: one table, by path and by name."""
    path = f"{tmp_path}/wide"
    spark.sql("CREATE DATABASE IF NOT EXISTS kinds")
    write_wide_table(_wide(spark, 1, 3), path, table="kinds.wide")
    later = _wide(spark, 2).withColumn("bb_cost", F.col("bb_cost").cast("decimal(38,12)")).withColumn("bb_new_tag", F.lit("x"))
    write_wide_table(later.select(*[c for c in later.columns if c != "bb_usage_year_month"], "bb_usage_year_month"), path, mode="months", table="kinds.wide")
    for df in (read_wide_table(spark, path), spark.newSession().table("kinds.wide")):
        assert sorted((r.bb_usage_year_month, r.bb_new_tag) for r in df.collect()) == [("2024-01", None), ("2024-02", "x"), ("2024-03", None)]
        assert dict(df.dtypes)["bb_cost"] == "decimal(38,12)" and df.columns[-1] == "bb_usage_year_month"


def test_the_name_is_switched_in_one_change(spark, tmp_path):
    path = f"{tmp_path}/wide"
    spark.sql("CREATE DATABASE IF NOT EXISTS switched")
    undated = _wide(spark, 1).withColumn("bb_usage_year_month", F.lit(None).cast("string"))
    write_wide_table(_wide(spark, 1, 2).unionByName(undated), path, table="switched.wide")
    other = spark.newSession()
    planned = other.table("switched.wide")
    write_wide_table(_wide(spark, 3, cost="7"), path, mode="months", months=["2024-02", None], table="switched.wide")
    assert len(planned.collect()) == 3
    assert _costs(other.table("switched.wide")) == [("2024-01", 1.0), ("2024-03", 7.0)]
    plan = other.table("switched.wide").where("bb_usage_year_month = '2024-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bb_usage_year_month" in plan
    for _ in range(4):
        write_wide_table(_wide(spark, 3, cost="8"), path, mode="months", table="switched.wide")
    assert len(other.catalog.listTables("switched_versions")) <= sink.KEPT_VERSIONS
    vacuum(spark, path)
    assert _costs(other.table("switched.wide")) == [("2024-01", 1.0), ("2024-03", 8.0)]


def test_files_follow_bytes(spark, tmp_path):
    """Tasks that each hold all months: a file a small month, several a heavy one."""
    rows = spark.range(60_000, numPartitions=12).selectExpr(
        "id", "sha2(cast(id AS string), 512) AS body", "CASE WHEN id % 10 = 0 THEN concat('2024-0', 1 + id DIV 10 % 3) ELSE '2024-09' END AS bb_usage_year_month")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.shuffle.partitions": "200"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        write_wide_table(rows, f"{tmp_path}/balanced")
        write_wide_table(rows, f"{tmp_path}/plain", balance=False)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    count = lambda p, m: len(glob.glob(f"{tmp_path}/{p}/{VERSION}=*/bb_usage_year_month={m}/*.parquet"))
    assert [count("balanced", f"2024-0{m}") for m in (1, 2, 3)] == [1, 1, 1] and 3 <= count("balanced", "2024-09") <= 12
    assert [count("plain", f"2024-0{m}") for m in (1, 2, 3)] == [12, 12, 12]
    assert read_wide_table(spark, f"{tmp_path}/balanced").count() == 60_000
    assert os.path.isdir(f"{tmp_path}/balanced/{MANIFESTS}")


def _shuffled(spark) -> dict[str, int]:
    """Bytes of the shuffle files that are there."""
    found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}


def test_months_that_tasks_hold_enough_of_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Rows of a month in a task, on average, and months in a task decide; the rows are
    the same, and what a shuffle wrote is gone after the write."""
    rows = spark.range(4_000, numPartitions=4).selectExpr(
        "id", "sha2(cast(id AS string), 512) AS body", "CASE id % 4 WHEN 0 THEN NULL ELSE concat('2024-0', id % 4) END AS bb_usage_year_month")
    ids = lambda p: sorted((r.id, r.bb_usage_year_month) for r in read_wide_table(spark, p).select("id", "bb_usage_year_month").collect())
    for name, lines, most, files, month in (("lie", 250, 4, 4, "2024-01"), ("lie", 250, 4, 4, sink.NULL_PARTITION), ("few", 251, 4, 1, "2024-01"), ("many", 250, 3, 1, "2024-01")):
        monkeypatch.setattr(sink, "FILE_LINES", lines, raising=False)
        monkeypatch.setattr(sink, "MOST_OPEN", most, raising=False)
        path, before = f"{tmp_path}/{name}-{month}", set(_shuffled(spark))
        write_wide_table(rows, path)
        assert len(glob.glob(f"{path}/{VERSION}=*/bb_usage_year_month={month}/*.parquet")) == files
        left = lambda: sum(n for f, n in _shuffled(spark).items() if f not in before)
        until = time.time() + 20
        while left() > 50_000 and time.time() < until:  # executors remove them in the background
            time.sleep(0.2)
        assert left() <= 50_000  # the texts alone have 512,000
        assert ids(path) == sorted(((i, f"2024-0{i % 4}" if i % 4 else None) for i in range(4_000)), key=lambda x: x[0])
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_an_empty_table_has_no_months_open(spark, tmp_path):
    rows = spark.range(0).selectExpr("id", "cast(NULL AS string) AS bb_usage_year_month")
    assert sink.months_open(rows) is None
    write_wide_table(rows, f"{tmp_path}/none")
    assert read_wide_table(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("query", ["_refreshed", "_mixed_files", "_published_counts", "_observed"])
def test_queries_that_write_the_table_do_not_shuffle_large_pieces(spark, monkeypatch, query):
    m = CostModel(lineitem_bill(spark, SF_SMALL).where("pmod(xxhash64(identity_line_item_id), 4) = 0").localCheckpoint())
    hints, hint = [], type(m.bill).hint
    monkeypatch.setattr(type(m.bill), "hint", lambda df, name, *more: (hints.append(name), hint(df, name, *more))[1])
    monkeypatch.setattr(sink, "FILE_LINES", 1, raising=False)
    got = getattr(registry, query)(m)
    assert "rebalance" not in hints
    if query in ("_refreshed", "_mixed_files"):
        cols = ["bb_id", "bb_cost", "bb_emr_cluster_name", "bb_usage_year_month"]
        rows = lambda df: Counter((r[0], None if r[1] is None else float(r[1]), *r[2:]) for r in df.select(cols).collect())
        assert rows(got) == rows(m.wide)
    elif query == "_observed":
        seen = got.first()
        assert (float(seen.bb_bwt_cost_total), float(seen.cur_unblended_total)) == tuple(map(float, m.qc_total().first()[:2]))
        assert (float(seen.sp_fees), float(seen.sp_cost)) == tuple(map(float, m.qc_savings_plans().first()[:2]))
    else:
        counts = {r.view.rsplit(".", 1)[-1]: r.line_count for r in got.collect()}
        assert (counts["bb_bwt_costs"], counts["bb_dwd_costs"]) == (m.wide.count(), m.base.count())
