"""The documented cost analyses over the wide table.

They are the dashboard questions of the model's documentation (cost by month,
credits, departments, S3 storage levels, purchase options, parent services,
commitment use) written as grouped aggregations. Every one is a partial +
final hash aggregate; shares use a scalar subquery for the grand total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.wide import ARN_COLUMN
from ..sources.cur import DEPARTMENT_TAG

MONTH = "bb_usage_year_month"


def _tag(column: str) -> Column:
    """A tag's value, NULL when untagged (missing or blank)."""
    return F.nullif(F.col(column), F.lit(""))


def tag_name(column: str) -> str:
    """Name of a tag column in results: ``resource_tags_user_x`` gives ``x``."""
    return column.removeprefix("resource_tags_user_")


def monthly_cost(wide: DataFrame) -> DataFrame:
    """Total cost per month."""
    return wide.groupBy(MONTH).agg(F.sum("bb_cost").alias("total_cost"))


def credit_offset(wide: DataFrame) -> DataFrame:
    """Per month, the total and the part offset by credits."""
    credit = F.when(F.col("line_item_line_item_type") == "Credit", F.col("bb_cost"))
    return wide.groupBy(MONTH).agg(
        F.sum("bb_cost").alias("total_cost"),
        F.coalesce(F.sum(credit), F.lit(0)).alias("credit_cost"),
    )


def department_by_service(wide: DataFrame, tag: str = DEPARTMENT_TAG) -> DataFrame:
    """D3: cost per department (or the value of another tag) and service."""
    return (wide.groupBy(_tag(tag).alias(tag_name(tag)), "bb_service")
            .agg(F.sum("bb_cost").alias("cost")))


def department_share(wide: DataFrame, tag: str = DEPARTMENT_TAG) -> DataFrame:
    """Each department's (or tag value's) share of the total cost, in percent."""
    per_dept = wide.groupBy(_tag(tag).alias(tag_name(tag))).agg(F.sum("bb_cost").alias("cost"))
    # The total comes from the aggregate itself: the subquery reuses its
    # exchange, so the wide table is read once.
    total = per_dept.select(F.sum("cost")).scalar()
    return per_dept.select(
        tag_name(tag), "cost",
        (F.col("cost").cast("double") * 100 / total.cast("double")).alias("share_pct"),
    )


def untagged_cost(wide: DataFrame, tag: str = DEPARTMENT_TAG) -> DataFrame:
    """Per month, the cost carrying no department (or other) tag and the total."""
    untagged = F.when(_tag(tag).isNull(), F.col("bb_cost"))
    return wide.groupBy(MONTH).agg(
        F.coalesce(F.sum(untagged), F.lit(0)).alias("untagged_cost"),
        F.sum("bb_cost").alias("total_cost"),
    )


def s3_cost_by_level(wide: DataFrame) -> DataFrame:
    """S3 storage cost per month and storage level."""
    return (wide.where(F.col("bb_s3_storage_level").isNotNull())
            .groupBy(MONTH, "bb_s3_storage_level").agg(F.sum("bb_cost").alias("cost")))


def s3_volume_by_level(wide: DataFrame) -> DataFrame:
    """S3 GB-months per month and storage level."""
    return (wide.where(F.col("bb_s3_storage_level").isNotNull())
            .groupBy(MONTH, "bb_s3_storage_level").agg(F.sum("bb_s3_gb_month").alias("gb_month")))


def purchase_option_mix(wide: DataFrame) -> DataFrame:
    """Cost, instance seconds and vCPU seconds per month and purchase
    option (On Demand, Reserved Instance, Savings Plans, Spot)."""
    return (
        wide.where(F.col("bb_ec2_purchase_option").isNotNull())
        .groupBy(MONTH, "bb_ec2_purchase_option")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("bb_cost").alias("cost"),
            F.sum("bb_ec2_seconds").alias("ec2_seconds"),
            F.sum("bb_ec2_vcpu_seconds").alias("vcpu_seconds"),
        )
    )


def parent_service_rollup(wide: DataFrame) -> DataFrame:
    """Cost per parent service, service, EMR cluster and role (so an EMR
    cluster's EC2 and EBS cost rolls up under AmazonEMR)."""
    return (wide.groupBy("bb_parent_service", "bb_service", "bb_emr_cluster_name", "bb_emr_instance_role")
            .agg(F.sum("bb_cost").alias("cost")))


def commitment_utilisation(wide: DataFrame, ri_unused: DataFrame | None = None) -> DataFrame:
    """Used and unused cost per commitment and month.

    Unused RI rows lose their arn in the wide table. Rows that still have it
    (``wide_costs(with_arn=True)``) need one pass; a written table's RI leftovers
    are taken from the leftover rows themselves (``commitments.ri_unused``).
    """
    sp, hidden = F.col("bb_sp_cost_type").isNotNull(), ARN_COLUMN in wide.columns
    ri = F.col("bb_ri_cost_type").isNotNull() if hidden else F.col("bb_ri_cost_type") == "Used"
    rows = wide.where(sp | ri).select(
        F.when(sp, F.lit("SavingsPlan")).otherwise(F.lit("ReservedInstance")).alias("commitment"),
        F.col(ARN_COLUMN).alias("arn") if hidden else F.when(sp, F.col("bb_sp_arn")).otherwise(F.col("bb_ri_arn")).alias("arn"),
        F.col(MONTH).alias("month"),
        F.coalesce("bb_sp_cost_type", "bb_ri_cost_type").alias("cost_type"),
        "bb_cost")
    if not hidden:
        rows = rows.unionByName(ri_unused.select(
            F.lit("ReservedInstance").alias("commitment"), F.col("bb_ri_arn").alias("arn"),
            F.col("_bb_usage_year_month").alias("month"), F.col("bb_ri_cost_type").alias("cost_type"), "bb_cost"))
    kind = F.col("cost_type")
    return rows.groupBy("commitment", "arn", "month").agg(
        F.coalesce(F.sum(F.when(kind == "Used", F.col("bb_cost"))), F.lit(0)).alias("used_cost"),
        F.coalesce(F.sum(F.when(kind == "Unused", F.col("bb_cost"))), F.lit(0)).alias("unused_cost"),
    )
