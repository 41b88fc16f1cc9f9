"""The row-level facets of the base bill.

Each function returns a ``Facet``; column names are those of the model's
debugging views (``_bb_*`` = intermediate, renamed in the wide table).

Fixed values: each declaration below states, as literal text and in the
model's order, the product codes, line-item types, product families and
LIKE patterns its predicate tests and the labels it outputs; the regular
expressions are collected under the next comment.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions.fx import extract_or_null
from .facet import Facet

c = F.col


def _line_type():
    return c("line_item_line_item_type")

def _usage_type():
    return c("line_item_usage_type")

def _amount():
    return c("line_item_usage_amount")

def _unblended():
    return c("line_item_unblended_cost")

def _product():
    return c("line_item_product_code")

def _operation():
    return c("line_item_operation")

def _resource():
    return c("line_item_resource_id")


# Usage-type pattern of instance hours, EMR cluster id, S3
# request tier, ELB name and type, RI instance type.
EC2_USAGE_PATTERN = r"(Box|Spot|Dedicated|Host|HostBox|ReservedHost|Sched|Unused)Usage"
EMR_CLUSTER_ID = r"(j-.+?)$"
S3_REQUEST_TIER = r".+?-(Tier\d)"
ELB_NAME = r"^.+:loadbalancer/(.+?)/(.+?)/(.+?)$"
ELB_TYPE = r"^LoadBalancing:(.+)$"
RI_INSTANCE_TYPE = r"^.+?:(.+)$"
RDS_NAME = r"^.+:(.+)$"


def data_transfer() -> Facet:
    return Facet("data_transfer", c("product_product_family") == "Data Transfer", {
        "_bb_parent_service": c("_bb_service"),
        "_bb_service": F.lit("AWSDataTransfer"),
        "_bb_dt_gb": _amount(),
        "_bb_dt_type": c("product_transfer_type"),
        "bb_dt_dir": K.dt_direction(_usage_type(), c("product_transfer_type"), _operation()),
    })


def ebs() -> Facet:
    return Facet("ebs", _usage_type().like("%EBS:%") & (_line_type() != "Credit"), {
        "_bb_parent_service": c("_bb_service"),
        "_bb_service": F.lit("AmazonEBS"),
        "bb_ebs_volume_id": _resource(),
        "bb_ebs_volume_type": c("product_volume_api_name"),
        "bb_ebs_gb_month": _amount(),
        "bb_cost": _unblended(),
        "_bb_ebs_usage_type": K.ebs_usage_type(c("product_product_family")),
    })


def ec2() -> Facet:
    pred = (
        (_product() == "AmazonEC2")
        & (c("product_vcpu") != "")
        & (c("product_servicecode") != "AWSDataTransfer")
        & (_line_type() != "Credit")
        & ~_usage_type().like("%EBS:Volume%")
        & _usage_type().rlike(EC2_USAGE_PATTERN)  # last: the test that costs most
    )
    itype = c("product_instance_type")
    return Facet("ec2", pred, {
        "_bb_service": F.lit("AmazonEC2"),
        "bb_ec2_instance_id": _resource(),
        "bb_ec2_seconds": _amount() * 3600,
        "_bb_ec2_instance_type_family": K.instance_family(c("product_instance_type_family"), itype),
        "_bb_ec2_instance_type_grand_family": K.instance_grand_family(itype),
        "_bb_ec2_instance_type": itype,
        # try_cast: the guard is not an evaluation order, a blank never raises.
        "bb_ec2_vcpu_seconds": c("product_vcpu").try_cast("int") * _amount() * 3600,
        "bb_ec2_platform": K.processor_platform(c("product_physical_processor")),
    })


def _compute_instance(spot: bool):
    spot_usage = _usage_type().like("%SpotUsage%")
    return (
        (_line_type() == "Usage")
        & (c("product_product_family") == "Compute Instance")
        & (spot_usage if spot else ~spot_usage)
    )


def ec2_on_demand() -> Facet:
    return Facet("ec2_on_demand", _compute_instance(False), {
        "bb_ec2_purchase_option": F.lit("On Demand"),
        "bb_cost_used": _unblended(),
    })


def ec2_spot() -> Facet:
    return Facet("ec2_spot", _compute_instance(True), {
        "bb_ec2_purchase_option": F.lit("Spot"),
        "bb_cost_used": _unblended(),
    })


def nat_gateway() -> Facet:
    return Facet("nat_gateway", c("product_product_family") == "NAT Gateway", {
        "_bb_vpc_usage_type": F.lit("NAT Gateway"),
        "_bb_ec2_nat_hours": _amount(),
    })


def ri_paid() -> Facet:
    return Facet("ri_paid", _line_type() == "RIFee", {
        "_bb_usage_year_month": c("_bb_usage_year_month"),
        "_bb_usage_date": c("_bb_usage_date"),
        "_bb_service": c("_bb_service"),
        "bb_ri_arn": c("reservation_reservation_a_r_n"),
        "bb_ec2_hours": _amount(),
        "bb_ec2_instance_type_inferred": extract_or_null(_usage_type(), RI_INSTANCE_TYPE, 1, ":"),
        "bb_cost": _unblended(),
    })


def ri_used() -> Facet:
    return Facet("ri_used", _line_type() == "DiscountedUsage", {
        "bb_ec2_purchase_option": F.lit("Reserved Instance"),
        "bb_ri_cost_type": F.lit("Used"),
        "bb_ri_arn": c("reservation_reservation_a_r_n"),
        "bb_ri_term_year": c("pricing_lease_contract_length"),
        "bb_cost_used": c("reservation_effective_cost"),
    })


def sp_used() -> Facet:
    return Facet("sp_used", _line_type() == "SavingsPlanCoveredUsage", {
        "_bb_usage_date": c("_bb_usage_date"),
        "_bb_usage_year_month": c("_bb_usage_year_month"),
        "bb_usage_type": F.lit("Savings Plans"),
        "bb_sp_cost_type": F.lit("Used"),
        "bb_sp_arn": c("savings_plan_savings_plan_a_r_n"),
        "bb_cost_used": c("savings_plan_savings_plan_effective_cost"),
        "bb_sp_term_year": c("savings_plan_purchase_term"),
    })


def sp_negation() -> Facet:
    return Facet("sp_negation", _line_type() == "SavingsPlanNegation", {
        "_bb_usage_date": c("_bb_usage_date"),
        "bb_sp_arn": c("savings_plan_savings_plan_a_r_n"),
        "bb_sp_cost_negation": _unblended(),
        "bb_cost": F.lit(0),
        "bb_ec2_seconds": F.lit(0),
    })


def sp_recurring() -> Facet:
    return Facet("sp_recurring", _line_type() == "SavingsPlanRecurringFee", {
        "_bb_usage_date": c("_bb_usage_date"),
        "_bb_usage_year_month": c("_bb_usage_year_month"),
        "bb_sp_arn": c("savings_plan_savings_plan_a_r_n"),
        "bb_sp_cost_recur": _unblended(),
        "bb_cost": F.lit(0),
    })


def rds(rds_only: bool = False) -> Facet:
    """Every row by default (the model's RDS view has no filter); with
    ``rds_only`` the columns are limited to AmazonRDS lines."""
    itype = c("product_instance_type")
    vtype = c("product_volume_type")
    return Facet("rds", (_product() == "AmazonRDS") if rds_only else None, {
        "bb_rds_usage_type": K.rds_usage_type(c("product_product_family")),
        "_bb_rds_platform": K.processor_platform(c("product_physical_processor")),
        "bb_rds_engine": c("product_database_engine"),
        "bb_rds_azness": c("product_deployment_option"),
        "bb_rds_instance_type": itype,
        "bb_rds_instance_arn": _resource(),
        "bb_rds_instance_name": extract_or_null(_resource(), RDS_NAME, 1, ":"),
        "_bb_rds_instance_type_family": K.instance_family(c("product_instance_type_family"), itype),
        "_bb_rds_instance_type_grand_family": K.instance_grand_family(itype),
        "rds_instance_seconds": F.when(c("product_database_engine").isNotNull(), _amount()),
        "rds_storage_volume_type": K.rds_volume_type(_usage_type(), c("line_item_line_item_description"), vtype),
        "rds_storage_gb_month": F.when(vtype.isNotNull(), _amount()),
    })


def emr_fee() -> Facet:
    return Facet("emr_fee", _product() == "ElasticMapReduce", {
        "bb_parent_service": F.lit("AmazonEMR"),
        "bb_emr_cluster_name": c("resource_tags_user_name"),
        "bb_emr_cluster_id": extract_or_null(_resource(), EMR_CLUSTER_ID, 1, "j-"),
    })


def emr_other() -> Facet:
    flow = c("resource_tags_aws_elasticmapreduce_job_flow_id")
    role = c("resource_tags_aws_elasticmapreduce_instance_group_role")
    return Facet("emr_other", (flow != "") | (role != ""), {
        "bb_parent_service": F.lit("AmazonEMR"),
        "bb_emr_cluster_id": flow,
        "bb_emr_instance_role": role,
    })


def s3_storage() -> Facet:
    return Facet("s3_storage", _usage_type().like("%-TimedStorage-%") & (_product() == "AmazonS3"), {
        "bb_s3_gb_month": _amount(),
        "bb_s3_bucket": _resource(),
        "bb_s3_storage_level": K.s3_storage_level(_operation()),
        "bb_s3_usage_type": F.lit("TimedStorage"),
        "bb_s3_is_overhead": _operation().like("%SizeOverhead%"),
    })


def s3_requests() -> Facet:
    return Facet("s3_requests", _usage_type().like("%-Requests-%") & (_product() == "AmazonS3"), {
        "bb_s3_requested_api": _operation(),
        "bb_s3_request_cost_tier": extract_or_null(_usage_type(), S3_REQUEST_TIER, 1, "-Tier"),
        "bb_s3_num_requests": _amount(),
        "bb_s3_bucket": _resource(),
        "bb_s3_usage_type": F.lit("Requests"),
    })


def elb() -> Facet:
    return Facet("elb", _product() == "AWSELB", {
        "bb_elb_name": extract_or_null(_resource(), ELB_NAME, 2, ":loadbalancer/"),
        "bb_elb_hour": _amount(),
        "bb_elb_usage_type": K.elb_usage_type(_usage_type()),
        "bb_elb_type": extract_or_null(_operation(), ELB_TYPE, 1, "LoadBalancing:"),
    })


def marketplace() -> Facet:
    return Facet("marketplace", c("bill_billing_entity") == "AWS Marketplace", {
        "bb_mp_seller": c("line_item_legal_entity"),
        "bb_mp_product_name": c("product_product_name"),
        "_bb_service": F.lit("AWSMarketplace"),
    })


FACETS = {
    f.__name__: f
    for f in (
        data_transfer, ebs, ec2, ec2_on_demand, ec2_spot, nat_gateway, ri_paid,
        ri_used, sp_used, sp_negation, sp_recurring, rds, emr_fee, emr_other,
        s3_storage, s3_requests, elb, marketplace,
    )
}
