"""Registered queries: one per operator of the model, each over a whole bill.

Every query takes ``(spark, sf_dir)``, derives the bill from that directory's
``lineitem`` table (all rows) and runs the model on it. ``edge`` renders
outputs for comparison with the DuckDB oracle: decimals as DOUBLE (money is
summed as DECIMAL inside, so both engines round the same exact value), dates
as ISO text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import CostModel
from ..operators.facets import FACETS
from ..session import shared_folder
from ..sources.cur import read_cur
from ..sources.dictionaries import read_dictionary, write_dictionary
from ..sources.fixture import lineitem_bill
from ..sources.sink import read_wide_table, write_wide_table
from ..streaming.refresh import refresh_changes
from .quality import Observed
from .views import FACET_VIEWS, publish_tables, publish_views


def edge(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast("string").alias(f.name))  # ISO yyyy-MM-dd, no time zone
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def model_for(spark: SparkSession, sf_dir: str, **options) -> CostModel:
    return CostModel(lineitem_bill(spark, sf_dir), **options)


def _q(fn: Callable[[CostModel], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(fn(model_for(spark, sf_dir)))
    run.__doc__ = fn.__doc__
    return run


ANALYSES = [
    "monthly_cost", "credit_offset", "department_by_service", "department_share", "untagged_cost",
    "s3_cost_by_level", "s3_volume_by_level", "purchase_option_mix", "parent_service_rollup",
    "commitment_utilisation",
]


def _facet(name: str) -> Callable[[CostModel], DataFrame]:
    return lambda m: m.facet(name)


def _analysis(name: str) -> Callable[[CostModel], DataFrame]:
    return lambda m: m.analysis(name)


def model_queries() -> dict[str, Callable[[CostModel], DataFrame]]:
    """Every registered query as a function of a ``CostModel`` (any bill)."""
    q: dict[str, Callable[[CostModel], DataFrame]] = {
        "finalised_bill": lambda m: m.finalised,
        "base_costs": lambda m: m.base,
    }
    for name in FACETS:
        q[name] = _facet(name)
    q.update({
        "ri_monthly_used": lambda m: m.ri_monthly_used(),
        "ri_unused": lambda m: m.ri_unused,
        "sp_daily_used": lambda m: m.sp_daily_used(),
        "sp_unused": lambda m: m.sp_unused(),
        "emr_cluster_names": lambda m: m.emr_cluster_names(),
        "emr_name_lookup": lambda m: m.emr_name_lookup(),
        "wide_costs": lambda m: m.wide,
        "ec2_hourly_usage": lambda m: m.ec2_hourly_usage(),
        "ec2_hourly_usage_by_account": lambda m: m.ec2_hourly_usage(by_account=True),
        "qc_total": lambda m: m.qc_total(),
        "qc_by_service": lambda m: m.qc_by_service(),
        "qc_savings_plans": lambda m: m.qc_savings_plans(),
        "sp_unused_filled": lambda m: m.with_options(fill_unused=True).sp_unused(),
        "qc_savings_plans_filled": lambda m: m.with_options(fill_unused=True).qc_savings_plans(),
        "qc_reserved": lambda m: m.qc_reserved(),
        "ri_unused_grouped": lambda m: m.with_options(fee_grain="group").ri_unused,
        "sp_unused_grouped": lambda m: m.with_options(fee_grain="group").sp_unused(),
        "qc_reserved_grouped": lambda m: m.with_options(fee_grain="group").qc_reserved(),
        "rds_only": lambda m: m.with_options(rds_only=True).facet("rds"),
        "wide_costs_rds_only": lambda m: m.with_options(rds_only=True).wide,
        "wide_costs_filled": lambda m: m.with_options(fill_unused=True).wide,
        "wide_costs_grouped": lambda m: m.with_options(fee_grain="group").wide,
        # The EMR name lookup beyond its broadcast bound (shuffle joins).
        "wide_costs_names_shuffled": lambda m: m.with_options(emr_broadcast_bytes=0).wide,
        "emr_name_lookup_shuffled": lambda m: m.with_options(emr_broadcast_bytes=0).emr_name_lookup(),
        "key_check": lambda m: m.key_check(),
        "dict_line_item_type": lambda m: m.dict_line_item_type(),
        "dict_usage_type": lambda m: m.dict_usage_type(),
    })
    for name in ANALYSES:
        q[name] = _analysis(name)
    business = "resource_tags_user_business"
    q.update({
        "business_by_service": lambda m: m.analysis("department_by_service", tag=business),
        "business_share": lambda m: m.analysis("department_share", tag=business),
        "untagged_business_cost": lambda m: m.analysis("untagged_cost", tag=business),
        "qc_by_service_drifted": _drifted,
        "wide_costs_untyped": lambda m: CostModel(untyped(m.bill)).wide,
        "published_monthly_cost": _published,
        "published_view_counts": _published_counts,
        "wide_costs_mixed_files": _mixed_files,
        "wide_costs_refreshed": _refreshed,
        "wide_costs_all_names": lambda m: m.with_options(all_names=True).wide,
        "emr_name_lookup_all_names": lambda m: m.with_options(all_names=True).emr_name_lookup(),
        "emr_name_lookup_all_names_shuffled": lambda m: m.with_options(all_names=True, emr_broadcast_bytes=0).emr_name_lookup(),
        "dict_usage_type_csv": _dictionary_csv,
        "qc_observed": _observed,
        "qc_total_from_totals": lambda m: m.totals().checks()["total"],
        "qc_by_service_from_totals": lambda m: _tampered(m).totals().checks()["by service"],
        "qc_savings_plans_from_totals": lambda m: m.totals().checks()["savings plans"],
        "qc_reserved_from_totals": lambda m: m.totals().checks()["reserved"],
    })
    return q


def _drifted(m: CostModel) -> DataFrame:
    """Q2 over a wide table whose lines no longer agree with the bill."""
    return _tampered(m).qc_by_service()


def _tampered(m: CostModel) -> CostModel:
    return CostModel(m.bill, wide=m.unnamed_wide.withColumn("bb_cost", F.col("bb_cost") + 1))


def untyped(bill: DataFrame) -> DataFrame:
    """The bill as a loosely typed export holds it: money as doubles, times in
    the session's zone."""
    return bill.withColumns({
        f.name: F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(f.name)).cast("timestamp")
        for f in bill.schema.fields if isinstance(f.dataType, (T.DecimalType, T.TimestampNTZType))})


def _mixed_files(m: CostModel) -> DataFrame:
    """The wide table of an export whose files store the same columns in types
    that don't merge: DECIMAL and zone-less times; DOUBLE and instants; other
    DECIMALs and times as text, with two offsets and without. Written and read in a
    session whose zone puts its clock back and forward within the bill's months."""
    spark, folder = m.bill.sparkSession, _scratch(m)
    money = [f.name for f in m.bill.schema if isinstance(f.dataType, T.DecimalType)]
    times = [f.name for f in m.bill.schema if isinstance(f.dataType, T.TimestampNTZType)]

    def at(c: str, hours: int, minutes: int, offset: str):
        return F.concat((F.col(c) + F.make_dt_interval(hours=F.lit(hours), mins=F.lit(minutes))).cast("string"), F.lit(offset))

    forms = [
        ({}, {}),
        ({c: F.col(c).cast("double") for c in money}, {c: at(c, 0, 0, "Z").cast("timestamp") for c in times}),
        ({c: F.col(c).cast("decimal(24,8)") for c in money}, {c: at(c, 5, 30, "+05:30") for c in times}),
        ({}, {c: at(c, -8, 0, " -0800") for c in times}),
        ({c: F.col(c).cast("string") for c in money}, {c: at(c, 0, 0, "") for c in times}),
    ]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Africa/Casablanca")
    try:
        for n, (amounts, clocks) in enumerate(forms):
            rows = m.bill.where(F.pmod(F.xxhash64("identity_line_item_id"), F.lit(len(forms))) == n)
            rows.withColumns({**amounts, **clocks}).write.mode("append").parquet(f"{folder}/cur")
        write_wide_table(CostModel(read_cur(spark, f"{folder}/cur")).wide, f"{folder}/wide")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return read_wide_table(spark, f"{folder}/wide")


def _refreshed(m: CostModel) -> DataFrame:
    """The wide table after two refreshes: an export without its taxes and
    cluster lines, then one that has them in files of their own."""
    spark, folder = m.bill.sparkSession, _scratch(m)
    late = F.coalesce(F.col("line_item_line_item_type") == "Tax", F.lit(False)) | F.coalesce(F.col("line_item_product_code") == "ElasticMapReduce", F.lit(False))
    for part in (~late, late):
        m.bill.where(part).write.mode("append").parquet(f"{folder}/cur")
        refresh_changes(spark, f"{folder}/cur", f"{folder}/wide", state=f"{folder}/state")
    return read_wide_table(spark, f"{folder}/wide")


def _scratch(m: CostModel) -> str:
    return f"{shared_folder(m.bill.sparkSession).rstrip('/')}/billmodel-query-{uuid.uuid4().hex}"


def _observed(m: CostModel) -> DataFrame:
    """Q1 and Q3 as the build takes them while it writes the table."""
    seen = Observed()
    write_wide_table(m.observed_wide(seen), _scratch(m) + "/wide", counted=m.unnamed_wide)
    total, bill, _ = seen.totals()
    fees, sp, _ = seen.savings_plans()
    kind = "decimal(38,12)"
    return m.bill.sparkSession.range(1).select(*[F.lit(None if v is None else str(v)).cast(kind).alias(n) for n, v in (
        ("bb_bwt_cost_total", total), ("cur_unblended_total", bill), ("sp_fees", fees), ("sp_cost", sp))])


def _dictionary_csv(m: CostModel) -> DataFrame:
    """P2 written as CSV and read back."""
    folder = _scratch(m)
    write_dictionary(m.dict_usage_type(), folder)
    return read_dictionary(m.bill.sparkSession, folder)


def _published_counts(m: CostModel) -> DataFrame:
    """Rows of the lasting views, asked for by a session of its own."""
    spark, database = m.bill.sparkSession, f"billmodel_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    publish_tables(m, _scratch(m), database)
    counted = ["bb_cur_table", "bb_dwd_costs", *FACET_VIEWS, "bb_dwd_ri_unused_costs", "bb_dwd_sp_unused_costs",
               "bb_dim_amazonemr_cluster_names", "bb_bwt_costs"]
    return spark.sql(" UNION ALL ".join(f"SELECT '{v}' AS view, COUNT(*) AS line_count FROM {database}.{v}" for v in counted))


def _published(m: CostModel) -> DataFrame:
    """Monthly cost asked for in SQL, by the name of the published view."""
    publish_views(m)
    return m.bill.sparkSession.sql("SELECT bb_usage_year_month, SUM(bb_cost) AS total_cost FROM bb_bwt_costs GROUP BY bb_usage_year_month")


def registered_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query over the bill derived from ``<sf_dir>/lineitem.parquet``."""
    return {name: _q(fn) for name, fn in model_queries().items()}
