"""Sinks and sources: the month-partitioned wide table and value dictionaries."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from billmodel import CostModel
from billmodel.sources import cur, fixture
from billmodel.sources.dictionaries import read_dictionary, write_dictionary
from billmodel.sources.fixture import lineitem_bill
from billmodel.sources.sink import read_wide_table, write_wide_table
from conftest import SF_SMALL, line, make_bill


def _rows(df, cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_wide_table_round_trip_and_month_refresh(spark):
    m = CostModel(lineitem_bill(spark, SF_SMALL))
    path = tempfile.mkdtemp(prefix="wide-") + "/t"
    write_wide_table(m.wide, path)
    back = read_wide_table(spark, path)
    cols = ["bb_id", "bb_cost", "bb_service", "bb_usage_year_month"]
    assert _rows(back, cols) == _rows(m.wide, cols)
    # month partitions are pruned by a filter on the partition column
    plan = back.where(F.col("bb_usage_year_month") == "2024-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bb_usage_year_month" in plan
    # rewriting one month leaves the others in place
    before = back.groupBy("bb_usage_year_month").count().collect()
    feb = m.wide.where(F.col("bb_usage_year_month") == "2024-02").limit(3)
    write_wide_table(feb, path, mode="months")
    after = {r[0]: r[1] for r in read_wide_table(spark, path).groupBy("bb_usage_year_month").count().collect()}
    for month, n in before:
        assert after[month] == (3 if month == "2024-02" else n)


def test_dictionary_round_trip(spark):
    bill = make_bill(spark, [line(line_item_product_code="AmazonEC2", line_item_usage_type="CNW1-BoxUsage:m5.large"),
                             line(line_item_product_code="AWSBackup", line_item_usage_type="")])
    pairs = CostModel(bill).dict_usage_type()
    path = tempfile.mkdtemp(prefix="dict-") + "/d"
    write_dictionary(pairs, path)
    back = read_dictionary(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in pairs.collect())
    raw = "".join(open(p).read() for p in __import__("glob").glob(path + "/*.csv"))
    assert '"line_item_product_code","line_item_usage_type"' in raw and '"AWSBackup",""' in raw


def test_published_views_answer_sql(spark):
    from billmodel.plans.views import publish_views

    m = CostModel(lineitem_bill(spark, SF_SMALL))
    names = publish_views(m)
    assert {"bb_cur_table", "bb_dwd_costs", "bb_bwt_costs", "bb_rpt_ec2_hourly_usage",
            "bb_dwd_ri_unused_costs", "bb_dwd_sp_unused_costs"} <= set(names)
    by_sql = spark.sql("SELECT bb_usage_year_month, SUM(bb_cost) AS c FROM bb_bwt_costs GROUP BY 1").collect()
    by_df = m.analysis("monthly_cost").collect()
    assert sorted(map(tuple, by_sql)) == sorted(map(tuple, by_df))
    assert spark.sql("SELECT COUNT(*) FROM bb_dwd_amazonec2_costs").first()[0] == m.facet("ec2").count()


def test_cli_build_and_check(spark, capsys):
    from billmodel.__main__ import main

    root = tempfile.mkdtemp(prefix="cli-")
    lineitem_bill(spark, SF_SMALL).write.parquet(root + "/cur")
    main(["build", "--cur", root + "/cur", "--out", root + "/wide"])
    main(["check", "--cur", root + "/cur", "--wide", root + "/wide"])
    out = capsys.readouterr().out
    assert "== total" in out and "== reserved" in out
    assert read_wide_table(spark, root + "/wide").count() == CostModel(lineitem_bill(spark, SF_SMALL)).wide.count()


def test_partition_refresh_of_catalog_table(spark):
    """A2: a month written under a catalog table's location becomes visible
    once partitions are recovered."""
    from billmodel.sources.cur import refresh_partitions

    root = tempfile.mkdtemp(prefix="catalog-") + "/cur"
    bill = lineitem_bill(spark, SF_SMALL).withColumn("month", F.date_format("line_item_usage_start_date", "yyyy-MM"))
    bill.where(F.col("month") == "2024-01").write.partitionBy("month").parquet(root)
    spark.sql("DROP TABLE IF EXISTS cur_catalog_test")
    spark.catalog.createTable("cur_catalog_test", path=root, source="parquet")
    refresh_partitions(spark, "cur_catalog_test")
    assert [r[0] for r in spark.sql("SELECT DISTINCT month FROM cur_catalog_test").collect()] == ["2024-01"]
    bill.where(F.col("month") == "2024-02").write.mode("append").partitionBy("month").parquet(root)
    refresh_partitions(spark, "cur_catalog_test")
    months = sorted(r[0] for r in spark.sql("SELECT DISTINCT month FROM cur_catalog_test").collect())
    assert months == ["2024-01", "2024-02"]
    spark.sql("DROP TABLE cur_catalog_test")


def test_cli_month_build_and_dictionaries(spark):
    import glob as g

    from billmodel.__main__ import main

    root = tempfile.mkdtemp(prefix="cli2-")
    lineitem_bill(spark, SF_SMALL).write.parquet(root + "/cur")
    main(["build", "--cur", root + "/cur", "--out", root + "/wide", "--months", "2024-04"])
    months = {r[0] for r in read_wide_table(spark, root + "/wide").select("bb_usage_year_month").distinct().collect()}
    assert months == {"2024-04"}
    main(["dictionaries", "--cur", root + "/cur", "--out", root + "/dims"])
    for name in ("line_item_line_item_type", "line_item_usage_type"):
        assert g.glob(f"{root}/dims/{name}/*.csv")


def test_read_cur_options(spark):
    from billmodel import read_cur

    root = tempfile.mkdtemp(prefix="readcur-") + "/cur"
    bill = make_bill(spark, [line(), line(line_item_product_code="AmazonS3")])
    bill.write.parquet(root)
    merged = read_cur(spark, root)
    plain = read_cur(spark, root, merge_schema=False)
    fixed = read_cur(spark, root, schema=bill.schema)
    assert merged.count() == plain.count() == fixed.count() == 2
    assert set(bill.columns) <= set(fixed.columns)


def test_reports_prune_the_written_table(spark):
    """Over the written wide table the hourly report reads 5 of its columns
    and pushes its filter into the scan."""
    m = CostModel(lineitem_bill(spark, SF_SMALL))
    path = tempfile.mkdtemp(prefix="prune-") + "/wide"
    write_wide_table(m.wide, path)
    report = CostModel(m.bill, wide=read_wide_table(spark, path)).ec2_hourly_usage()
    leaves = report._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())
             if leaves.apply(i).getClass().getSimpleName() == "FileSourceScanExec"]
    assert len(scans) == 1
    meta = scans[0].metadata()
    read = meta.get("ReadSchema").get()
    names = sorted(re.findall(r"(?:<|,)(\w+):", read))
    assert names == sorted(["bb_service", "bb_ec2_purchase_option", "line_item_usage_start_date",
                            "line_item_usage_end_date", "line_item_usage_amount"])
    assert "EqualTo(bb_service,AmazonEC2)" in meta.get("PushedFilters").get()


def test_every_published_view_answers_sql(spark):
    from billmodel.plans.views import FACET_VIEWS, publish_views

    names = publish_views(CostModel(lineitem_bill(spark, SF_SMALL)))
    assert len(names) == 2 + len(FACET_VIEWS) + 9
    for name in names:
        assert spark.sql(f"SELECT COUNT(*) FROM {name}").first()[0] >= 0


def test_check_prints_every_row(spark, tmp_path, capsys):
    """A check with more than 20 differing groups is printed whole."""
    from billmodel.__main__ import main

    rows = [line(line_item_line_item_type="Tax", line_item_line_item_description=f"d{i}") for i in range(45)]
    make_bill(spark, rows).write.parquet(f"{tmp_path}/cur")
    wide = CostModel(make_bill(spark, rows)).wide
    write_wide_table(wide.withColumn("bb_cost", wide.bb_cost + 1), f"{tmp_path}/wide")
    main(["check", "--cur", f"{tmp_path}/cur", "--wide", f"{tmp_path}/wide", "--out", f"{tmp_path}/checks"])
    assert "-- 45 rows" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/checks/by_service").count() == 45


def test_catalog_tables(spark, tmp_path):
    """The wide table and the views by name, from another session, and a month
    refreshed and withdrawn through the catalog."""
    from billmodel.plans.views import publish_tables
    from billmodel.sources.sink import drop_months, sync_partitions

    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    rows = [line(), line(line_item_usage_start_date=dt.datetime(2024, 2, 1))]
    model = CostModel(make_bill(spark, rows))
    names = publish_tables(model, f"{tmp_path}/tables", "published")
    other = spark.newSession()
    assert other.table("published.bb_bwt_costs").count() == 2
    assert set(names) == {f"published.{t.name}" for t in other.catalog.listTables("published") if not t.isTemporary}
    write_wide_table(model.wide.where("bb_usage_year_month = '2024-02'"), f"{tmp_path}/tables/bb_bwt_costs", "months", "published.bb_bwt_costs")
    drop_months(spark, f"{tmp_path}/tables/bb_bwt_costs", ["2024-01"])
    sync_partitions(spark, "published.bb_bwt_costs")
    other = spark.newSession()
    assert [r[0] for r in other.table("published.bb_bwt_costs").select("bb_usage_year_month").collect()] == ["2024-02"]


def test_rebuild_ignores_the_sessions_overwrite_mode(spark, tmp_path):
    rows = [line(), line(line_item_usage_start_date=dt.datetime(2024, 2, 1))]
    write_wide_table(CostModel(make_bill(spark, rows)).wide, f"{tmp_path}/w")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_wide_table(CostModel(make_bill(spark, rows[:1])).wide, f"{tmp_path}/w")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert read_wide_table(spark, f"{tmp_path}/w").count() == 1


def test_types_are_enforced_in_any_session_zone(spark):
    """Doubles and zoned times become DECIMAL and zone-less UTC."""
    from billmodel.plans.registry import untyped

    bill = make_bill(spark, [line(line_item_unblended_cost="0.1"), line(line_item_unblended_cost="0.2")])
    want = sorted(map(tuple, CostModel(bill).wide.select("bb_id", "bb_usage_date", "bb_usage_year_month").collect()))
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            wide = CostModel(untyped(bill)).wide
            assert dict(wide.dtypes)["bb_cost"].startswith("decimal")
            assert sorted(map(tuple, wide.select("bb_id", "bb_usage_date", "bb_usage_year_month").collect())) == want
            assert float(wide.agg({"bb_cost": "sum"}).first()[0]) == 0.3
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    from billmodel.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_fee_rows_are_made_by_many_tasks(spark):
    """A supplier table of one task: no task makes most of its fee rows."""
    suppliers = spark.range(1, 8_001, 1, 1).selectExpr("id % 7000 AS s_suppkey", "CAST(id % 900 AS DOUBLE) - 400 AS s_acctbal")
    fees = fixture.fee_lines(suppliers)
    tasks = fees.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert sum(r["count"] for r in tasks) == 8_000 * (fixture.PERIOD_DAYS + fixture.PERIOD_MONTHS)
    assert max(r["count"] for r in tasks) <= 1.2 * fixture.FEE_ROWS
    keys = {r[0] for r in fees.where("line_item_line_item_type = 'RIFee'").select("reservation_reservation_a_r_n").distinct().collect()}
    assert keys == {f"arn:ri/{k}" for k in range(7_000)}
    few = fixture.fee_lines(suppliers.limit(3)).where("line_item_line_item_type = 'SavingsPlanRecurringFee'")
    assert few.count() == 3 * fixture.PERIOD_DAYS


def _largest_method(spark, df):
    """Bytes of the largest method that Spark generates for a plan."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


@pytest.fixture
def derived_bill(spark, tmp_path):
    k = "(id * 7919) % 3000"
    spark.range(0, 600).selectExpr("id AS l_orderkey", f"{k} AS l_partkey", f"{k} % 40 AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber",
                                   "CAST(id % 50 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) / 3 AS l_extendedprice",
                                   "TIMESTAMP_NTZ'1995-01-01 00:00:00' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(0, 40).selectExpr("id AS s_suppkey", "CAST(id AS DOUBLE) AS s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lineitem_bill(spark, str(tmp_path))
    spark.conf.unset("spark.sql.adaptive.enabled")


# The JVM never compiles a method of more than 8,000 bytes: every row would be interpreted.
COMPILED = 8_000


@pytest.mark.parametrize("options", [{}, {"rds_only": True}, {"all_names": True}])
def test_lines_are_compiled(spark, derived_bill, options):
    from billmodel.plans.registry import edge

    m = CostModel(derived_bill, **options)
    assert _largest_method(spark, edge(m.base)) < COMPILED
    assert _largest_method(spark, edge(m.wide)) < COMPILED
    assert derived_bill.where("line_item_line_item_type NOT IN ('RIFee', 'SavingsPlanRecurringFee')").count() == 600


def test_lines_of_all_names_are_repeated_in_compiled_code(spark, derived_bill):
    """A lambda over every line's names would keep the step out of the generated code."""
    plan = CostModel(derived_bill, all_names=True).wide._jdf.queryExecution().executedPlan().toString()
    (step,) = [row for row in plan.splitlines() if "Generate explode(CASE" in row]
    assert re.search(r"\*\(\d+\) Generate", step) and "lambda" not in step


def test_lines_of_shuffled_names_are_compiled(spark, derived_bill):
    from billmodel.plans.registry import edge

    assert _largest_method(spark, edge(CostModel(derived_bill, emr_broadcast_bytes=0).wide)) < COMPILED


def test_files_of_two_types_are_grouped_in_few_steps(spark, tmp_path, monkeypatch):
    """Two writes of many files each, whose names alternate when sorted."""
    path, asked = f"{tmp_path}/cur", []
    for kind in ("double", "string"):
        spark.range(0, 40, 1, 20).select(F.col("id").cast("string").alias("identity_line_item_id"), F.col("id").cast(kind).alias("line_item_usage_amount")).write.mode("append").parquet(path)
    plain = cur.merges
    monkeypatch.setattr(cur, "merges", lambda spark, path, some: asked.append(len(some)) or plain(spark, path, some))
    groups = cur.merging_groups(spark, path, [path])
    assert sorted(map(len, groups)) == [20, 20] and len(asked) <= 12 and sum(asked) <= 200
    amounts = cur.read_cur(spark, path).select(F.sum("line_item_usage_amount"), F.count("*")).first()
    assert (int(amounts[0]), amounts[1]) == (2 * sum(range(40)), 80)
