"""Model behaviour on small hand-made bills and on the derived test bill."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billmodel import CostModel
from billmodel.operators.facets import FACETS
from billmodel.sources.cur import REQUIRED_COLUMNS, conform
from billmodel.sources.fixture import lineitem_bill

from conftest import SF_SMALL, line, make_bill


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def small_model(spark):
    return CostModel(lineitem_bill(spark, SF_SMALL))


@pytest.mark.parametrize("name", list(FACETS))
def test_guarded_columns_equal_left_join(small_model, name):
    """A facet joined back on bb_id equals its guarded columns (bb_id is unique)."""
    base = small_model.base
    f = FACETS[name]()
    joined = base.select("bb_id").join(f.view(base), "bb_id", "left")
    guarded = base.select("bb_id", *[f.guarded(c).alias(c) for c in f.columns])
    assert rows(joined.select(guarded.columns)) == rows(guarded)


def test_key_is_unique(small_model):
    r = small_model.key_check().first()
    assert r.line_count == r.distinct_ids and r.null_ids == 0 and r.duplicated_ids == 0


def test_key_check_reports_duplicates(spark):
    a = line(identity_line_item_id="same")
    b = line(identity_line_item_id="same")
    r = CostModel(make_bill(spark, [a, b, line()])).key_check().first()
    assert (r.line_count, r.distinct_ids, r.duplicated_ids) == (3, 2, 1)


def test_finalisation_drops_blank_and_null_invoices(spark):
    bill = make_bill(spark, [line(), line(bill_invoice_id=""), line(bill_invoice_id=None)])
    assert CostModel(bill).base.count() == 1


def test_reserved_fees_reconcile(small_model):
    """Monthly RI fees = used + unused, up to the 2-decimal rounding of each
    unused row (13 fee rows a month: at most 13 * 0.005)."""
    rows = small_model.qc_reserved().collect()
    assert len(rows) == 6
    assert all(abs(r.a_total - r.b_total) <= Decimal("0.065") for r in rows)


def test_savings_plan_gap_is_the_unused_days(spark, small_model):
    """A (day, arn) without covered usage gives a NULL leftover, so its
    fee leaves the wide table; the SP check's gap is the sum of those fees
    (up to the 4-decimal rounding of the other leftovers)."""
    left = small_model.sp_unused()
    empty = left.where(F.col("bb_sp_cost_unused").isNull()).select(
        F.regexp_replace("bb_id", "UNUSEDSP$", "").alias("bb_id"))
    lost = small_model.facet("sp_recurring").join(empty, "bb_id").agg(F.sum("bb_sp_cost_recur")).first()[0]
    assert lost > 0
    bound = Decimal("0.00005") * left.count() + Decimal("0.005")
    gap = small_model.qc_savings_plans().first().diff
    assert abs(gap - lost) <= bound
    filled = CostModel(small_model.bill, fill_unused=True).qc_savings_plans().first()
    assert abs(filled.diff) <= bound


def _cost_model_bill(spark):
    t0 = dt.datetime(2024, 3, 5, 10)
    return [
        line(line_item_unblended_cost=3, line_item_product_code="AmazonS3"),
        line(line_item_line_item_type="SavingsPlanCoveredUsage", line_item_product_code="AmazonEC2",
             line_item_unblended_cost=4, savings_plan_savings_plan_effective_cost=Decimal("2.8"),
             savings_plan_savings_plan_a_r_n="sp1", line_item_usage_start_date=t0),
        line(line_item_line_item_type="SavingsPlanNegation", line_item_unblended_cost=-4,
             savings_plan_savings_plan_a_r_n="sp1", line_item_usage_start_date=t0),
        line(line_item_line_item_type="SavingsPlanRecurringFee", line_item_product_code="ComputeSavingsPlans",
             line_item_unblended_cost=3, savings_plan_savings_plan_a_r_n="sp1",
             line_item_usage_start_date=dt.datetime(2024, 3, 5, 0)),
        line(line_item_line_item_type="DiscountedUsage", line_item_product_code="AmazonEC2",
             line_item_unblended_cost=0, reservation_effective_cost=Decimal("1.5"),
             reservation_reservation_a_r_n="ri1", line_item_usage_start_date=t0),
        line(line_item_line_item_type="RIFee", line_item_product_code="AmazonEC2", line_item_unblended_cost=2,
             reservation_reservation_a_r_n="ri1", line_item_usage_type="CNW1-HeavyUsage:m5.large",
             line_item_usage_start_date=dt.datetime(2024, 3, 1, 0)),
    ]


def test_cost_model_totals(spark):
    """Fees are replaced by used + unused rows; with one fee row per period
    the wide total equals the raw total."""
    m = CostModel(make_bill(spark, _cost_model_bill(spark)))
    q = m.qc_total().first()
    assert q.bb_bwt_cost_total == q.cur_unblended_total == Decimal("8")
    w = {r.bb_id: r for r in m.wide.collect()}
    assert len(w) == 5  # 6 lines - 3 replaced fee/negation lines + 2 leftovers
    unused = [r for r in w.values() if r.bb_ri_cost_type == "Unused" or r.bb_sp_cost_type == "Unused"]
    assert sorted(r.bb_cost for r in unused) == [Decimal("0.2"), Decimal("0.5")]
    ri_left = [r for r in unused if r.bb_ri_cost_type == "Unused"][0]
    assert ri_left.bb_ri_arn is None and ri_left.bb_service == "AmazonEC2"  # T6
    sp_left = [r for r in unused if r.bb_sp_cost_type == "Unused"][0]
    assert sp_left.bb_service == "ComputeSavingsPlans" and sp_left.bb_sp_arn == "sp1"
    assert m.qc_savings_plans().first().diff == 0
    assert all(r.diff == 0 for r in m.qc_reserved().collect())


def test_fee_grain_group_fixes_split_fees(spark):
    """T4: two fee rows for one (month, arn) subtract the month's use twice
    by default; fee_grain='group' sums the fees first."""
    use = line(line_item_line_item_type="DiscountedUsage", line_item_unblended_cost=0,
               reservation_effective_cost=15, reservation_reservation_a_r_n="ri1")
    fees = [line(line_item_line_item_type="RIFee", line_item_unblended_cost=10,
                 reservation_reservation_a_r_n="ri1") for _ in range(2)]
    bill = make_bill(spark, [use, *fees])
    by_row = CostModel(bill).qc_reserved().first()
    assert (by_row.a_total, by_row.b_total, by_row.diff) == (Decimal(20), Decimal(5), Decimal(15))
    grouped = CostModel(bill, fee_grain="group").qc_reserved().first()
    assert grouped.diff == 0 and grouped.b_total == Decimal(20)


def _emr_lines():
    emr = "ElasticMapReduce"
    arn = "arn:aws-cn:elasticmapreduce:cn-northwest-1:1:cluster/"
    return [
        # cluster j-A has two names
        line(line_item_product_code=emr, line_item_resource_id=arn + "j-A", resource_tags_user_name="alpha"),
        line(line_item_product_code=emr, line_item_resource_id=arn + "j-A", resource_tags_user_name="beta"),
        line(line_item_product_code=emr, line_item_resource_id=arn + "j-B", resource_tags_user_name="bravo"),
        # a fee line of j-B tagged with cluster j-A (theta join on either id)
        line(line_item_product_code=emr, line_item_resource_id=arn + "j-B",
             resource_tags_aws_elasticmapreduce_job_flow_id="j-A",
             resource_tags_aws_elasticmapreduce_instance_group_role="MASTER"),
        # an EC2 line of j-B, role tag only: the blank tag id wins over nothing
        line(line_item_product_code="AmazonEC2", resource_tags_aws_elasticmapreduce_job_flow_id="j-B",
             resource_tags_aws_elasticmapreduce_instance_group_role="CORE"),
        line(line_item_product_code="AmazonEC2", resource_tags_aws_elasticmapreduce_instance_group_role="TASK"),
        line(line_item_product_code="AmazonS3"),
    ]


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_emr_names(spark, broadcast_rows):
    m = CostModel(make_bill(spark, _emr_lines()), emr_broadcast_bytes=broadcast_rows)
    got = sorted((r.bb_emr_cluster_id or "", r.bb_emr_cluster_name or "", r.bb_emr_instance_role or "",
                  r.bb_parent_service) for r in m.wide.collect())
    assert got == sorted([
        ("j-A", "alpha", "", "AmazonEMR"),     # one name per id: no duplicated line
        ("j-A", "alpha", "", "AmazonEMR"),
        ("j-B", "bravo", "", "AmazonEMR"),
        ("j-A", "alpha", "MASTER", "AmazonEMR"),  # tag id first; the model would emit two lines
        ("j-B", "bravo", "CORE", "AmazonEMR"),
        ("", "", "TASK", "AmazonEMR"),
        ("", "", "", "AmazonS3"),
    ])
    assert m.wide.count() == 7


def test_hourly_report_spreads_usage(spark):
    start = dt.datetime(2024, 1, 1, 5)
    ec2 = dict(line_item_product_code="AmazonEC2", line_item_usage_type="CNW1-BoxUsage:m5.large",
               product_product_family="Compute Instance", product_vcpu="2", product_servicecode="AmazonEC2")
    bill = make_bill(spark, [
        line(**ec2, line_item_usage_amount=Decimal("2.5"), line_item_usage_start_date=start,
             line_item_usage_end_date=start + dt.timedelta(hours=3)),
        # zero-length line: sequence(0, -1) is [0, -1]
        line(**ec2, line_item_usage_amount=Decimal("0.25"), line_item_usage_start_date=start,
             line_item_usage_end_date=start),
    ])
    got = sorted((r.hour, r.usage) for r in CostModel(bill).ec2_hourly_usage().collect())
    assert got == [
        (start - dt.timedelta(hours=1), Decimal("1")),
        (start, Decimal("0.25")),
        (start, Decimal("1")),
        (start + dt.timedelta(hours=1), Decimal("1")),
        (start + dt.timedelta(hours=2), Decimal("0.5")),
    ]


def test_conform_adds_missing_columns(spark):
    bill = make_bill(spark, [line()]).drop("reservation_reservation_a_r_n", "reservation_effective_cost")
    c = conform(bill)
    assert set(REQUIRED_COLUMNS) <= set(c.columns)
    w = CostModel(bill).wide
    assert w.count() == 1 and w.first().bb_cost == Decimal("1")


def test_rds_only_option(spark):
    bill = make_bill(spark, [line(line_item_product_code="AmazonRDS", product_database_engine="MySQL"),
                             line(line_item_product_code="AmazonS3")])
    default = {r.line_item_product_code: r.bb_rds_platform for r in CostModel(bill).wide.collect()}
    assert default == {"AmazonRDS": "x86", "AmazonS3": "x86"}  # T5: filled on every line
    only = {r.line_item_product_code: r.bb_rds_platform for r in CostModel(bill, rds_only=True).wide.collect()}
    assert only == {"AmazonRDS": "x86", "AmazonS3": None}


def test_null_key_lines_get_no_facet_columns(spark):
    """A NULL bb_id joins no facet row in the join form: facet columns stay
    NULL and the cost falls back to the unblended cost."""
    ebs = dict(line_item_usage_type="CNW1-EBS:VolumeUsage.gp3", line_item_product_code="AmazonEC2",
               line_item_resource_id="vol-1", line_item_unblended_cost=2)
    bill = make_bill(spark, [line(**ebs), line(**ebs, identity_line_item_id=None)])
    got = sorted(((r.bb_id is None), r.bb_ebs_volume_id, r.bb_service, r.bb_rds_platform, r.bb_cost)
                 for r in CostModel(bill).wide.collect())
    assert got == [(False, "vol-1", "AmazonEBS", "x86", Decimal("2")),
                   (True, None, "AmazonEC2", None, Decimal("2"))]


def test_guarded_columns_equal_joined_facets(small_model):
    """Every facet column, guarded in one pass, equals its view joined back."""
    from billmodel.operators.facets import FACETS
    from tools.facet_joins import join_every_facet

    joined = join_every_facet(small_model)
    names = [c for c in joined.columns if "__" in c]
    one_pass = small_model.base.select("bb_id", *[
        FACETS[f]().guarded(c).alias(f"{f}__{c}") for f, _, c in (n.partition("__") for n in names)])
    assert rows(joined.select("bb_id", *names)) == rows(one_pass)


def test_hourly_report_ignores_session_time_zone(spark):
    """A zone-less start inside a DST gap keeps its wall-clock hours."""
    start = dt.datetime(2024, 3, 10, 2)  # does not exist in Los Angeles
    ec2 = dict(line_item_product_code="AmazonEC2", line_item_usage_type="CNW1-BoxUsage:m5.large",
               product_product_family="Compute Instance", product_vcpu="2", product_servicecode="AmazonEC2")
    bill = make_bill(spark, [line(**ec2, line_item_usage_amount=Decimal("2.5"), line_item_usage_start_date=start,
                                  line_item_usage_end_date=start + dt.timedelta(hours=3))])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = sorted((r.hour, r.usage) for r in CostModel(bill).ec2_hourly_usage().collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(start, Decimal("1")), (start + dt.timedelta(hours=1), Decimal("1")),
                   (start + dt.timedelta(hours=2), Decimal("0.5"))]


def test_wide_plan_shape(spark, small_model):
    """Over a bill read from Parquet (as an export is), the wide table is one
    full scan plus small side inputs: no sort-merge, nested-loop or cartesian
    join, and the two EMR lookups share one broadcast."""
    import tempfile

    from billmodel import read_cur

    path = tempfile.mkdtemp(prefix="plan-") + "/cur"
    small_model.bill.write.parquet(path)
    wide = CostModel(read_cur(spark, path)).wide
    wide.collect()  # final adaptive plan
    plan = wide._jdf.queryExecution().executedPlan().toString()
    for bad in ("SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in plan, bad
    assert "ReusedExchange" in plan


def test_fee_grain_group_on_savings_plans(spark):
    """T4 for SP: two recurring-fee rows of one (day, arn)."""
    t = dt.datetime(2024, 2, 3, 5)
    use = line(line_item_line_item_type="SavingsPlanCoveredUsage", line_item_usage_start_date=t,
               savings_plan_savings_plan_effective_cost=3, savings_plan_savings_plan_a_r_n="sp1")
    fees = [line(line_item_line_item_type="SavingsPlanRecurringFee", line_item_unblended_cost=2,
                 line_item_usage_start_date=dt.datetime(2024, 2, 3, h), savings_plan_savings_plan_a_r_n="sp1")
            for h in (0, 1)]
    bill = make_bill(spark, [use, *fees])
    by_row = sorted(r.bb_sp_cost_unused for r in CostModel(bill).sp_unused().collect())
    assert by_row == [Decimal(-1), Decimal(-1)]  # each fee minus the whole day's use
    grouped = CostModel(bill).with_options(fee_grain="group")
    assert [r.bb_sp_cost_unused for r in grouped.sp_unused().collect()] == [Decimal(1)]
    assert grouped.qc_savings_plans().first().diff == 0


def test_zoned_timestamps_in_utc_session(spark, small_model):
    """An export with zoned timestamps (TIMESTAMP, not TIMESTAMP_NTZ) gives
    the same model in a UTC session."""
    from billmodel.streaming.refresh import wide_for_months

    ts = ["line_item_usage_start_date", "line_item_usage_end_date"]
    zoned = small_model.bill.select(*[F.col(c).cast("timestamp").alias(c) if c in ts else F.col(c)
                                      for c in small_model.bill.columns])
    m = CostModel(zoned)
    cols = ["bb_id", "bb_cost", "bb_usage_date", "bb_usage_year_month", "bb_emr_cluster_name"]
    assert rows(m.wide.select(cols)) == rows(small_model.wide.select(cols))
    hourly = [(r.hour.replace(tzinfo=None), r.usage) for r in m.ec2_hourly_usage().collect()]
    assert Counter(hourly) == Counter((r.hour, r.usage) for r in small_model.ec2_hourly_usage().collect())
    assert wide_for_months(zoned, ["2024-05"]).count() == \
        small_model.wide.where(F.col("bb_usage_year_month") == "2024-05").count()


def test_broadcast_bound_from_session_setting(spark):
    from billmodel.operators.joins import BROADCAST_BYTES_CONF, DEFAULT_BROADCAST_BYTES, broadcast_bound

    df = spark.range(3)
    assert broadcast_bound(df, 5) == 5
    spark.conf.set(BROADCAST_BYTES_CONF, "0")
    try:
        assert broadcast_bound(df, None) == 0
        m = CostModel(make_bill(spark, _emr_lines()))
        plan = m.wide._jdf.queryExecution().optimizedPlan().toString()
        assert "broadcast" not in plan.lower()  # beyond the bound: no broadcast hint
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)
    assert broadcast_bound(df, None) == DEFAULT_BROADCAST_BYTES


def test_reports_without_names_start_no_job(spark, small_model):
    """Reports that do not show the cluster name plan no lookup, and building
    them runs nothing."""
    tracker = spark.sparkContext.statusTracker()
    group = "no-names"
    spark.sparkContext.setJobGroup(group, group)
    try:
        m = CostModel(small_model.bill)
        reports = [m.ec2_hourly_usage(), m.qc_by_service(), m.qc_reserved(), m.qc_total(), m.qc_savings_plans(),
                   *(m.analysis(n) for n in ("monthly_cost", "credit_offset", "department_by_service", "department_share", "untagged_cost",
                                             "s3_cost_by_level", "s3_volume_by_level", "purchase_option_mix", "commitment_utilisation"))]
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("", "")
    for df in reports:
        assert "bb_emr_cluster_name" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_unread_names_cost_no_join(small_model):
    """With the full table, too, Catalyst drops lookups that nobody reads."""
    plan = small_model.wide.groupBy("bb_usage_year_month").agg({"bb_cost": "sum"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1  # the fees with their usage


def test_shuffled_names_spread_rows_without_an_id(spark):
    """Beyond the bound, with adaptive planning off: a real sort-merge join in
    which rows without one of the ids do not pile up on one partition."""
    from billmodel.operators.base import base_costs
    from billmodel.operators.emr import attach_cluster_names, cluster_name_by_id

    emr = "arn:cluster/j-"
    rows = [line(line_item_product_code="ElasticMapReduce", line_item_resource_id=f"{emr}{i}", resource_tags_user_name=f"n{i}") for i in range(4)]
    base = base_costs(make_bill(spark, rows))
    lines = base.sparkSession.createDataFrame([(f"k{i}", ["", None, "j-1"][i % 3], [None, "j-2"][i % 2]) for i in range(600)], "bb_id string, tag string, fee string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach_cluster_names(lines, cluster_name_by_id(base), "tag", "fee", 0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
        sizes = [len(p) for p in out.where("fee is null and coalesce(tag, '') <> ''").rdd.glom().collect()]
        assert max(sizes) < 60  # 100 rows with a tag only: not on one key of the second join
        got = {(r.tag, r.fee): r._emr_dim_name for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {("", None): None, (None, None): None, ("j-1", None): "n1", ("", "j-2"): "n2", (None, "j-2"): "n2", ("j-1", "j-2"): "n1"}


def test_shuffled_names_stay_shuffled_under_adaptive_planning(spark):
    out = CostModel(make_bill(spark, _emr_lines()), emr_broadcast_bytes=0).emr_name_lookup()
    assert out.collect() and out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("SortMergeJoin") >= 2


def test_tag_column_is_free(small_model):
    by_unit = small_model.analysis("department_share", tag="resource_tags_user_business")
    assert by_unit.columns == ["business", "cost", "share_pct"]
    assert abs(sum(r.share_pct for r in by_unit.collect()) - 100) < 1e-6


def test_wide_shuffled_names_choose_rows_by_a_plain_condition(spark):
    """Lines with no id, a blank one, NULLs in what the condition reads, no key."""
    flow, role = "resource_tags_aws_elasticmapreduce_job_flow_id", "resource_tags_aws_elasticmapreduce_instance_group_role"
    emr, arn = "ElasticMapReduce", "arn:aws-cn:elasticmapreduce:cn-northwest-1:1:cluster/j-"
    rows = [
        line(line_item_product_code=emr, line_item_resource_id=arn + "A", resource_tags_user_name="a"),
        line(line_item_product_code=emr, line_item_resource_id="none", resource_tags_user_name="b"),
        line(line_item_product_code=emr, line_item_resource_id=None, **{flow: "j-A"}),
        line(line_item_product_code=None, **{flow: "j-A"}),
        line(line_item_product_code=None, **{flow: None, role: "CORE"}),
        line(line_item_product_code="AmazonEC2", **{flow: "", role: "CORE"}),
        line(line_item_product_code="AmazonEC2", **{flow: None, role: None}),
        line(identity_line_item_id=None, line_item_product_code=emr, line_item_resource_id=arn + "A"),
    ]
    for names in (False, True):
        wide = [CostModel(make_bill(spark, rows), emr_broadcast_bytes=b, all_names=names).wide for b in (None, 0)]
        small, large = (sorted(map(repr, w.collect())) for w in wide)
        assert len(small) == len(rows) and small == large


def test_grouped_fees_are_spread(spark, monkeypatch):
    """More fee rows than the session's partitions should hold go to more parts."""
    from billmodel.operators import commitments

    rows = [line(line_item_line_item_type="RIFee", line_item_product_code="AmazonEC2", reservation_reservation_a_r_n=f"ri-{i % 30}",
                 line_item_unblended_cost=i) for i in range(90)]
    m = CostModel(make_bill(spark, rows), fee_grain="group")
    want = sorted(map(tuple, m.ri_unused.collect()))
    assert len(want) == 30 and sum(r[-1] for r in want) == sum(range(90))
    monkeypatch.setattr(commitments, "FEE_ROWS", 3)
    spread = CostModel(m.bill, fee_grain="group").ri_unused
    assert sorted(map(tuple, spread.collect())) == want
    assert "REPARTITION_BY_NUM" in spread._jdf.queryExecution().executedPlan().toString()
