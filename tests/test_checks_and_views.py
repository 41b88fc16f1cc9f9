"""Checks in one pass, the key check by hashes, all EMR names, lasting views."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from billmodel import CostModel
from billmodel.operators import emr
from billmodel.operators.base import base_costs
from billmodel.plans.quality import Observed, key_check
from billmodel.plans.views import FACET_VIEWS, model_views, publish_tables
from billmodel.sources.fixture import lineitem_bill
from billmodel.sources.sink import read_wide_table, write_wide_table
from conftest import SF_SMALL, line, make_bill


def _rows(df):
    return Counter(tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in df.collect())


def test_checks_from_totals_equal_the_queries(spark):
    m = CostModel(lineitem_bill(spark, SF_SMALL))
    tampered = CostModel(m.bill, wide=m.unnamed_wide.withColumn("bb_cost", F.col("bb_cost") * 2))
    for model in (m, tampered):
        totals = model.totals()
        checks = totals.checks()
        for title, want in (("total", model.qc_total()), ("by service", model.qc_by_service()),
                            ("savings plans", model.qc_savings_plans()), ("reserved", model.qc_reserved())):
            assert checks[title].columns == want.columns and _rows(checks[title]) == _rows(want)
        totals.unpersist()
    assert tampered.qc_by_service().count() > 10


def test_build_observes_the_totals(spark, tmp_path):
    m = CostModel(lineitem_bill(spark, SF_SMALL))
    seen = Observed()
    write_wide_table(m.observed_wide(seen), f"{tmp_path}/wide")
    assert tuple(map(float, seen.totals())) == tuple(map(float, m.qc_total().first()))
    assert tuple(map(float, seen.savings_plans())) == tuple(map(float, m.qc_savings_plans().first()))
    assert read_wide_table(spark, f"{tmp_path}/wide").count() == m.wide.count()
    empty = Observed()
    write_wide_table(CostModel(make_bill(spark, [])).observed_wide(empty), f"{tmp_path}/none")
    assert empty.totals() == empty.savings_plans() == (None, None, None)


def test_key_check_counts_texts_behind_equal_hashes(spark, monkeypatch):
    rows = [line(identity_line_item_id=f"k{i % 40}") for i in range(70)] + [line(identity_line_item_id=None) for _ in range(3)]
    bill = make_bill(spark, rows)
    want = (73, 40, 3, 30)
    assert tuple(key_check(base_costs(bill)).first()) == want
    assert tuple(key_check(base_costs(make_bill(spark, []))).first()) in {(None, 0, 0, 0), (0, 0, 0, 0)}
    monkeypatch.setattr(F, "xxhash64", lambda c: F.length(c).cast("long"))  # nearly all keys share their hash
    assert tuple(key_check(base_costs(bill)).first()) == want


EMR = dict(line_item_product_code="ElasticMapReduce")


def _cluster_bill(spark, hot=0):
    flow = "resource_tags_aws_elasticmapreduce_job_flow_id"
    at = lambda i: f"arn:cluster/{i}"
    rows = [line(**EMR, line_item_resource_id=at("j-1"), resource_tags_user_name=n) for n in ("b", "a", "b")]
    rows += [line(**EMR, line_item_resource_id=at("j-2"), resource_tags_user_name="z"), line(**EMR, line_item_resource_id=at("j-3")),
             line(**EMR, line_item_resource_id=at("j-1"), **{flow: "j-2"}), line(**EMR, line_item_resource_id=at("j-2"), **{flow: "j-2"}),
             line(**EMR, line_item_resource_id=at("j-3"), **{flow: "j-1"}), line(**{flow: "j-1"}), line(**{flow: "j-9"}), line(), line(**EMR)]
    rows += [line(**{flow: "j-1"}) for _ in range(hot)]
    return make_bill(spark, rows)


@pytest.mark.parametrize("bytes_", [None, 0])
def test_all_names_equal_the_theta_join(spark, bytes_):
    m = CostModel(_cluster_bill(spark), all_names=True, emr_broadcast_bytes=bytes_)
    ids = CostModel(m.bill).emr_name_lookup().select("bb_id", "bb_emr_tag_cluster_id", "bb_emr_fee_cluster_id")
    n = m.emr_cluster_names()
    theta = ids.join(n, (F.col("bb_emr_cluster_id") == F.col("bb_emr_tag_cluster_id")) | (F.col("bb_emr_cluster_id") == F.col("bb_emr_fee_cluster_id")), "left")
    got = m.emr_name_lookup()
    assert _rows(got) == _rows(theta.select("bb_id", "bb_emr_tag_cluster_id", "bb_emr_fee_cluster_id", "bb_emr_cluster_id", "bb_emr_cluster_name"))
    assert got.count() > m.base.where("bb_id is not null and line_item_product_code = 'ElasticMapReduce'").count()
    wide = m.wide.groupBy("bb_id").count().where("count > 1").count()
    assert wide == got.groupBy("bb_id").count().where("count > 1").count() > 0
    one = CostModel(m.bill, emr_broadcast_bytes=bytes_)
    assert one.wide.count() == one.base.count()


def test_a_hot_cluster_is_spread_beyond_the_bound(spark):
    """Without adaptive joins no task holds a cluster id of most lines alone."""
    base = base_costs(_cluster_bill(spark, hot=4000))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = base.select("bb_id", F.col("resource_tags_aws_elasticmapreduce_job_flow_id").alias("_tag"), F.lit(None).cast("string").alias("_fee"))
        out = emr.attach_cluster_names(rows, emr.cluster_name_by_id(base), "_tag", "_fee", max_bytes=0)
        held = out.where("_emr_dim_id = 'j-1'").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(r["count"] for r in held) >= 4000 and max(r["count"] for r in held) < 2000


def test_utilisation_in_one_pass(spark, tmp_path):
    m = CostModel(lineitem_bill(spark, SF_SMALL))
    bill = f"{tmp_path}/cur"
    m.bill.write.parquet(bill)
    m = CostModel(spark.read.parquet(bill))
    got = m.analysis("commitment_utilisation")
    assert str(got._jdf.queryExecution().optimizedPlan()).count("Relation [") <= 3
    write_wide_table(m.wide, f"{tmp_path}/wide")
    written = CostModel(m.bill, wide=read_wide_table(spark, f"{tmp_path}/wide"))
    assert _rows(got) == _rows(written.analysis("commitment_utilisation"))
    assert "_bb_commitment_arn" not in m.wide.columns


@pytest.mark.parametrize("options", [{}, {"fill_unused": True, "fee_grain": "group", "rds_only": True}])
def test_lasting_views_equal_the_dataframes(spark, tmp_path, options):
    """Every view, asked by another session; nothing written but the wide table."""
    database = f"lasting_{len(options)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    rows = [line(line_item_usage_start_date=dt.datetime(2024, 1 + i % 2, 2), line_item_unblended_cost=str(i)) for i in range(3)]
    rows += [line(**EMR, line_item_resource_id="arn:cluster/j-1", resource_tags_user_name="n", bill_invoice_id=i) for i in ("", None, "I")]
    make_bill(spark, rows).write.parquet(f"{tmp_path}/cur")
    lineitem_bill(spark, SF_SMALL).write.mode("append").parquet(f"{tmp_path}/cur")
    m = CostModel(spark.read.parquet(f"{tmp_path}/cur"), **options)
    names = publish_tables(m, f"{tmp_path}/out", database, cur=f"{tmp_path}/cur")
    assert {p.name for p in tmp_path.joinpath("out").iterdir()} == {"bb_bwt_costs"}
    other = spark.newSession()
    views = model_views(m)
    assert {n.split(".")[1] for n in names} == {*views, "bb_cur_source"} and len(FACET_VIEWS) == 18
    for view, df in views.items():
        got = other.table(f"{database}.{view}")
        assert got.columns == df.columns, view
        hashed = lambda d: d.select(F.xxhash64(*[F.col(f"`{c}`").cast("double") if t.startswith("decimal") else F.col(f"`{c}`") for c, t in d.dtypes]).alias("h"))
        assert Counter(r.h for r in hashed(got).collect()) == Counter(r.h for r in hashed(df).collect()), view
    # a refresh of the table reaches the views over it
    write_wide_table(m.wide.where("bb_usage_year_month = '2024-01'"), f"{tmp_path}/out/bb_bwt_costs", table=f"{database}.bb_bwt_costs")
    total = other.sql(f"SELECT bb_bwt_cost_total FROM {database}.bb_bwt_costs_total_q").first()[0]
    assert total == m.wide.where("bb_usage_year_month = '2024-01'").agg(F.sum("bb_cost")).first()[0]
