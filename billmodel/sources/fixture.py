"""A cost-and-usage bill derived from the driver's ``lineitem`` table.

The driver tables hold no bill, so tests, the registry and the bench derive
one: every ``lineitem`` row becomes one bill line whose shape comes from one
of the archetype rows (picked by ``(7*orderkey + 3*linenumber + 11*partkey +
suppkey)`` modulo their number). Every supplier stands for a commitment: fee
rows of reserved instances (all suppliers, monthly) and savings plans (every
fourth, daily) come from the ``supplier`` table, priced by its balance without a
look at usage. The same construction is written in DuckDB SQL in
``billmodel.plans.oracle``.

This module only produces input rows in the bill schema. None of the model's
work (classification, cost model, leftovers, reports) happens here.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the fixture. Usage types, operations, transfer types and
# product families are literal values a real bill carries (several of them are
# exactly the values the model tests for); "" means blank.
# Columns: i, line type, product code, usage type, operation, product family,
# service code, instance type, instance family, vcpu, processor, transfer
# type, volume api name, volume type, database engine, deployment option,
# resource kind, tag kind, hours, description.
# ---------------------------------------------------------------------------
ARCHETYPES: list[tuple] = [
    (0, "Usage", "AmazonEC2", "CNW1-BoxUsage:m5.xlarge", "RunInstances", "Compute Instance", "AmazonEC2", "m5.xlarge", "m5", "4", "Intel Xeon", "", "", "", "", "", "inst", "", 1, ""),
    (1, "Usage", "AmazonEC2", "CNW1-BoxUsage:m6g.2xlarge", "RunInstances", "Compute Instance", "AmazonEC2", "m6g.2xlarge", "", "8", "AWS Graviton2 Processor", "", "", "", "", "", "inst", "", 1, ""),
    (2, "Usage", "AmazonEC2", "CNW1-SpotUsage:m6g.xlarge", "RunInstances:SV", "Compute Instance", "AmazonEC2", "m6g.xlarge", "", "4", "AWS Graviton2 Processor", "", "", "", "", "", "inst", "", 1, ""),
    (3, "DiscountedUsage", "AmazonEC2", "CNW1-BoxUsage:m5.large", "RunInstances", "Compute Instance", "AmazonEC2", "m5.large", "", "2", "Intel Xeon", "", "", "", "", "", "inst", "", 1, ""),
    (4, "SavingsPlanCoveredUsage", "AmazonEC2", "CNW1-BoxUsage:c5.xlarge", "RunInstances", "Compute Instance", "AmazonEC2", "c5.xlarge", "", "4", "Intel Xeon", "", "", "", "", "", "inst", "", 1, ""),
    (5, "SavingsPlanNegation", "AmazonEC2", "CNW1-BoxUsage:c5.xlarge", "RunInstances", "Compute Instance", "AmazonEC2", "", "", "", "", "", "", "", "", "", "none", "", 1, ""),
    (6, "SavingsPlanCoveredUsage", "AmazonECS", "CNW1-Fargate-vCPU-Hours:perCPU", "FargateTask", "Compute", "AmazonECS", "", "", "", "", "", "", "", "", "", "none", "", 1, ""),
    (7, "Usage", "AmazonEC2", "CNW1-EBS:VolumeUsage.gp3", "CreateVolume-Gp3", "Storage", "AmazonEC2", "", "", "", "", "", "gp3", "General Purpose", "", "", "vol", "", 1, ""),
    (8, "Usage", "AmazonEC2", "CNW1-EBS:SnapshotUsage", "CreateSnapshot", "Storage Snapshot", "AmazonEC2", "", "", "", "", "", "", "", "", "", "vol", "", 1, ""),
    (9, "Usage", "AmazonEC2", "CNW1-EBS:VolumeP-IOPS.gp3", "CreateVolume-Gp3", "System Operation", "AmazonEC2", "", "", "", "", "", "gp3", "", "", "", "vol", "flow", 1, ""),
    (10, "Usage", "AmazonEC2", "CNW1-NatGateway-Hours", "NatGateway", "NAT Gateway", "AmazonEC2", "", "", "", "", "", "", "", "", "", "none", "", 1, ""),
    (11, "Usage", "AmazonEC2", "CNW1-DataTransfer-Regional-Bytes", "InterZone-In", "Data Transfer", "AWSDataTransfer", "", "", "", "", "IntraRegion", "", "", "", "", "inst", "", 1, ""),
    (12, "Usage", "AmazonEC2", "CNW1-DataTransfer-Regional-Bytes", "VPCPeering-In", "Data Transfer", "AWSDataTransfer", "", "", "", "", "IntraRegion", "", "", "", "", "inst", "", 1, ""),
    (13, "Usage", "AmazonEC2", "CNW1-DataTransfer-Regional-Bytes", "PublicIP-In", "Data Transfer", "AWSDataTransfer", "", "", "", "", "IntraRegion", "", "", "", "", "inst", "", 1, ""),
    (14, "Usage", "AmazonECS", "CNW1-DataTransfer-Regional-Bytes", "FargateTask", "Data Transfer", "AWSDataTransfer", "", "", "", "", "IntraRegion", "", "", "", "", "none", "", 1, ""),
    (15, "Usage", "AmazonVPC", "CNW1-DataTransfer-Regional-Bytes", "VpcEndpoint", "Data Transfer", "AWSDataTransfer", "", "", "", "", "IntraRegion", "", "", "", "", "none", "", 1, ""),
    (16, "Usage", "AWSELB", "CNW1-DataTransfer-Regional-Bytes", "LoadBalancing-PublicIP-In", "Data Transfer", "AWSDataTransfer", "", "", "", "", "IntraRegion", "", "", "", "", "alb", "", 1, ""),
    (17, "Usage", "AmazonS3", "CNW1-DataTransfer-Out-Bytes", "GetObject", "Data Transfer", "AWSDataTransfer", "", "", "", "", "AWS Outbound", "", "", "", "", "bucket", "", 1, ""),
    (18, "Usage", "AWSDataTransfer", "CNW1-CNN1-AWS-Out-Bytes", "InterRegion-Out", "Data Transfer", "AWSDataTransfer", "", "", "", "", "InterRegion Outbound", "", "", "", "", "none", "", 1, ""),
    (19, "Usage", "AWSDataTransfer", "CNW1-CNN1-AWS-In-Bytes", "InterRegion-In", "Data Transfer", "AWSDataTransfer", "", "", "", "", "InterRegion Inbound", "", "", "", "", "none", "", 1, ""),
    (20, "Usage", "AmazonEC2", "CNW1-CloudFront-In-Bytes", "RunInstances", "Data Transfer", "AWSDataTransfer", "", "", "", "", "Other", "", "", "", "", "inst", "", 1, ""),
    (21, "Usage", "AmazonEC2", "CNW1-CloudFront-Out-Bytes", "RunInstances", "Data Transfer", "AWSDataTransfer", "", "", "", "", "Other", "", "", "", "", "inst", "", 1, ""),
    (22, "Usage", "AmazonEC2", "CNW1-DataTransfer-In-Bytes", "RunInstances", "Data Transfer", "AWSDataTransfer", "", "", "", "", "AWS Inbound", "", "", "", "", "inst", "", 1, ""),
    (23, "Usage", "AmazonEC2", "CNW1-DataTransfer-xAZ-In-Bytes", "InterZone-In", "Data Transfer", "AWSDataTransfer", "", "", "", "", "Other", "", "", "", "", "inst", "", 1, ""),
    (24, "Usage", "AmazonSageMaker", "CNW1-Hst:Data-Bytes-In", "Invoke", "Data Transfer", "AWSDataTransfer", "", "", "", "", "Other", "", "", "", "", "none", "", 1, ""),
    (25, "Usage", "AmazonSageMaker", "CNW1-Hst:Data-Bytes-Out", "Invoke", "Data Transfer", "AWSDataTransfer", "", "", "", "", "Other", "", "", "", "", "none", "", 1, ""),
    (26, "Usage", "AmazonVPC", "CNW1-TransitGateway-Bytes", "VPCPeering-Out", "Data Transfer", "AWSDataTransfer", "", "", "", "", "Other", "", "", "", "", "none", "", 1, ""),
    (27, "Usage", "AmazonCloudFront", "CN-DataTransfer-Out-OBytes", "GET", "Data Transfer", "AWSDataTransfer", "", "", "", "", "CloudFront to Origin", "", "", "", "", "none", "", 1, ""),
    (28, "Usage", "AmazonCloudFront", "CN-DataTransfer-Out-Bytes", "GET", "Data Transfer", "AWSDataTransfer", "", "", "", "", "CloudFront Outbound", "", "", "", "", "none", "", 1, ""),
    (29, "Usage", "AmazonEC2", "DataTransfer-Regional-Bytes", "InterZone-In", "Data Transfer", "AWSDataTransfer", "", "", "", "", "IntraRegion", "", "", "", "", "inst", "", 1, ""),
    (30, "Usage", "AmazonGuardDuty", "CNW1-PaidEventsAnalyzed-Bytes", "Scan", "Data Transfer", "AWSDataTransfer", "", "", "", "", "Other", "", "", "", "", "none", "", 1, ""),
    (31, "Usage", "AmazonRDS", "CNW1-InstanceUsage:db.m5.large", "CreateDBInstance", "Database Instance", "AmazonRDS", "db.m5.large", "", "2", "Intel Xeon", "", "", "", "MySQL", "Single-AZ", "rds", "", 1, ""),
    (32, "DiscountedUsage", "AmazonRDS", "CNW1-Multi-AZUsage:db.m6g.xl", "CreateDBInstance", "Database Instance", "AmazonRDS", "db.m6g.xlarge", "", "4", "AWS Graviton2 Processor", "", "", "", "PostgreSQL", "Multi-AZ", "rds", "", 1, ""),
    (33, "Usage", "AmazonRDS", "CNW1-RDS:GP3-Storage", "CreateDBInstance", "Database Storage", "AmazonRDS", "", "", "", "", "", "", "General Purpose-GP3", "MySQL", "Single-AZ", "rds", "", 1, ""),
    (34, "Usage", "AmazonRDS", "CNW1-RDS:GP2-Storage", "CreateDBInstance", "Database Storage", "AmazonRDS", "", "", "", "", "", "", "General Purpose", "MySQL", "Single-AZ", "rds", "", 1, ""),
    (35, "Usage", "AmazonRDS", "CNW1-RDS:PIOPS-Storage", "CreateDBInstance", "Database Storage", "AmazonRDS", "", "", "", "", "", "", "Provisioned IOPS", "MySQL", "Single-AZ", "rds", "", 1, "per GB-month of io1 storage"),
    (36, "Usage", "ElasticMapReduce", "CNW1-BoxUsage:m5.xlarge", "RunInstances", "Elastic Map Reduce Instance", "ElasticMapReduce", "m5.xlarge", "", "", "", "", "", "", "", "", "emr", "", 1, ""),
    (37, "Usage", "AmazonEC2", "CNW1-BoxUsage:r6g.2xlarge", "RunInstances", "Compute Instance", "AmazonEC2", "r6g.2xlarge", "", "8", "AWS Graviton2 Processor", "", "", "", "", "", "inst", "flow", 1, ""),
    (38, "Usage", "ElasticMapReduce", "CNW1-BoxUsage:m6g.xlarge", "RunInstances", "Elastic Map Reduce Instance", "ElasticMapReduce", "m6g.xlarge", "", "", "", "", "", "", "", "", "emr", "role", 1, ""),
    (39, "Usage", "AmazonS3", "CNW1-TimedStorage-INT-FA-ByteHrs", "IntelligentTieringFAStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "Intelligent-Tiering", "", "", "bucket", "", 1, ""),
    (40, "Usage", "AmazonS3", "CNW1-TimedStorage-ByteHrs", "StandardStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "Standard", "", "", "bucket", "", 1, ""),
    (41, "Usage", "AmazonS3", "CNW1-TimedStorage-INT-IA-ByteHrs", "IntelligentTieringIASizeOverhead", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (42, "Usage", "AmazonS3", "CNW1-Requests-GDA-Tier1", "PutObject", "API Request", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (43, "Usage", "AWSELB", "CNW1-LoadBalancerUsage", "LoadBalancing:Application", "Load Balancer-Application", "AWSELB", "", "", "", "", "", "", "", "", "", "alb", "", 1, ""),
    (44, "Usage", "AWSELB", "CNW1-LCUUsage", "LoadBalancing", "Load Balancer", "AWSELB", "", "", "", "", "", "", "", "", "", "clb", "", 1, ""),
    (45, "Usage", "3iq00ukl2p6hk970ch0km8jche", "", "", "", "", "", "", "", "", "", "", "", "", "", "seller", "", 1, ""),
    (46, "Tax", "AmazonEC2", "", "", "", "", "", "", "", "", "", "", "", "", "", "none", "", 1, ""),
    (47, "Usage", "AmazonEC2", "CNW1-BoxUsage:t3.2xlarge", "RunInstances", "Compute Instance", "AmazonEC2", "t3.2xlarge", "", "8", "Intel Xeon", "", "", "", "", "", "inst", "", 3, ""),
    (48, "Credit", "AmazonEC2", "CNW1-BoxUsage:m5.large", "RunInstances", "Compute Instance", "AmazonEC2", "m5.large", "", "2", "Intel Xeon", "", "", "", "", "", "none", "", 1, "Promotional credit"),
    (49, "Fee", "AWSSupportBusiness", "CNW1-Support", "", "", "", "", "", "", "", "", "", "", "", "", "none", "", 1, "One-time fee"),
    (50, "Refund", "AmazonS3", "CNW1-TimedStorage-ByteHrs", "StandardStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "Standard", "", "", "bucket", "", 1, "Refund"),
    (51, "Usage", "AmazonS3", "CNW1-TimedStorage-INT-IA-ByteHrs", "IntelligentTieringIAStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (52, "Usage", "AmazonS3", "CNW1-TimedStorage-INT-AIA-ByteHrs", "IntelligentTieringAIAStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (53, "Usage", "AmazonS3", "CNW1-TimedStorage-INT-AA-ByteHrs", "IntelligentTieringAAStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (54, "Usage", "AmazonS3", "CNW1-TimedStorage-INT-DAA-ByteHrs", "IntelligentTieringDAAStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (55, "Usage", "AmazonS3", "CNW1-TimedStorage-GDA-ByteHrs", "DeepArchiveStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (56, "Usage", "AmazonS3", "CNW1-TimedStorage-GDA-Staging", "DeepArchiveStagingStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (57, "Usage", "AmazonS3", "CNW1-TimedStorage-GDA-Overhead", "DeepArchiveS3ObjectOverhead", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (58, "Usage", "AmazonS3", "CNW1-TimedStorage-GDA-Index", "DeepArchiveObjectOverhead", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (59, "Usage", "AmazonS3", "CNW1-TimedStorage-XZ-ByteHrs", "ExpressOneZoneStorage", "Storage", "AmazonS3", "", "", "", "", "", "", "", "", "", "bucket", "", 1, ""),
    (60, "Usage", "AmazonEC2", "CNW1-BoxUsage:m5.large", "RunInstances", "Compute Instance", "AmazonEC2", "m5.large", "", "2", "Intel Xeon", "", "", "", "", "", "inst", "", 0, "Line of no length"),
    (61, "Usage", "ElasticMapReduce", "CNW1-BoxUsage:m5.large", "RunInstances", "Elastic Map Reduce Instance", "ElasticMapReduce", "m5.large", "", "", "", "", "", "", "", "", "emr", "flow", 1, ""),
]

ARCHETYPE_FIELDS = [
    "a_i", "a_type", "a_product", "a_usage", "a_operation", "a_family", "a_svc",
    "a_itype", "a_ifam", "a_vcpu", "a_proc", "a_transfer", "a_volapi", "a_voltype",
    "a_engine", "a_deploy", "a_resource", "a_tag", "a_hours", "a_desc",
]

# Fixed values of the fee rows: the billing period (2024-01-01 plus 181 days,
# i.e. six months).
PERIOD_START = "2024-01-01 00:00:00"
PERIOD_DAYS = 181
PERIOD_MONTHS = 6
RI_FEE_USAGE_TYPE = "CNW1-HeavyUsage:m5.large"
SP_FEE_USAGE_TYPE = "CNW1-ComputeSP:1yrNoUpfront"
# Fees, b = the supplier's whole balance modulo 100: RI = 40 + b + month index;
# SP = 2 + b + 0.5 * (day index % 7).
RI_FEE_BASE = 40
SP_FEE_BASE = 2
SP_FEE_DAY_STEP = "0.5"
FEE_HOURS = 720
#: Fee rows that a task makes, about.
FEE_ROWS = 250_000

DEC = T.DecimalType(18, 6)

# Column order of the derived bill (the 38 model inputs plus two tags).
BILL_COLUMNS = [
    "identity_line_item_id", "line_item_usage_start_date", "line_item_usage_end_date",
    "bill_invoice_id", "bill_billing_entity", "line_item_legal_entity",
    "line_item_line_item_type", "line_item_product_code", "line_item_usage_type",
    "line_item_operation", "line_item_resource_id", "line_item_usage_account_id",
    "line_item_usage_amount", "line_item_unblended_cost", "line_item_line_item_description",
    "pricing_lease_contract_length", "product_product_family", "product_product_name",
    "product_region", "product_region_code", "product_servicecode", "product_transfer_type",
    "product_instance_type", "product_instance_type_family", "product_vcpu",
    "product_physical_processor", "product_volume_api_name", "product_volume_type",
    "product_database_engine", "product_deployment_option",
    "reservation_reservation_a_r_n", "reservation_effective_cost",
    "savings_plan_savings_plan_a_r_n", "savings_plan_savings_plan_effective_cost",
    "savings_plan_purchase_term", "resource_tags_user_name",
    "resource_tags_aws_elasticmapreduce_job_flow_id",
    "resource_tags_aws_elasticmapreduce_instance_group_role",
    "resource_tags_user_department", "resource_tags_user_business",
]


# Resource ids by kind: text before a number of the part, its modulus (None: the
# part key itself) and the text after it. Other kinds have a blank id.
RESOURCES: dict[str, tuple[str, int | None, str]] = {
    "inst": ("i-", 500, ""),
    "vol": ("vol-", None, ""),
    "bucket": ("bucket-", 20, ""),
    "rds": ("arn:aws-cn:rds:cn-northwest-1:1:db:db-", 30, ""),
    "alb": ("arn:aws-cn:elb:cn-northwest-1:1:loadbalancer/app/lb-", 10, "/50dc"),
    "clb": ("arn:aws-cn:elb:cn-northwest-1:1:loadbalancer/lb-", 10, ""),
    "emr": ("arn:aws-cn:elasticmapreduce:cn-northwest-1:1:cluster/j-C", 10, ""),
}


def archetypes(spark: SparkSession) -> DataFrame:
    """The archetype rows, with what follows from an archetype alone: a line only
    looks it up, so that the code of a line stays small enough to be compiled."""
    import pyarrow as pa  # a local table, which the optimizer sees into

    rows = []
    for a in ARCHETYPES:
        r = dict(zip(ARCHETYPE_FIELDS, a, strict=True))
        before, modulus, after = RESOURCES.get(r["a_resource"], (None, None, None))
        r["a_desc"] = r["a_desc"] or f"{r['a_type']} {r['a_usage']}"
        r |= {"a_length": dt.timedelta(hours=r["a_hours"]), "a_amount": Decimal(r["a_hours"]) - Decimal("0.5") if r["a_hours"] > 1 else None,
              "a_before": before, "a_modulus": modulus, "a_after": after,
              "a_entity": "AWS Marketplace" if r["a_resource"] == "seller" else "AWS",
              "a_role": "CORE" if r["a_tag"] in ("flow", "role") else "",
              "a_term": "1yr" if r["a_type"] in ("SavingsPlanCoveredUsage", "SavingsPlanNegation") else "",
              "a_sign": -1 if r["a_type"] in ("Credit", "Refund", "SavingsPlanNegation") else int(r["a_type"] != "DiscountedUsage")}
        rows.append(r)
    text, number = pa.string(), pa.int64()
    schema = pa.schema(
        [pa.field("a_i", pa.int32(), False)]
        + [pa.field(n, text, False) for n in ARCHETYPE_FIELDS[1:18]]
        + [pa.field("a_hours", pa.int32(), False), pa.field("a_desc", text, False),
           pa.field("a_length", pa.duration("us"), False), pa.field("a_amount", pa.decimal128(18, 6)),
           pa.field("a_before", text), pa.field("a_modulus", number), pa.field("a_after", text),
           pa.field("a_entity", text, False), pa.field("a_role", text, False), pa.field("a_term", text, False),
           pa.field("a_sign", pa.int32(), False)])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def _s(c: Column) -> Column:
    return c.cast("string")


def usage_lines(lineitem: DataFrame, arch: DataFrame) -> DataFrame:
    """One bill line per lineitem row (all lineitem rows, no sampling)."""
    ok, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    li = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_shipdate",
        ((ok * 7 + ln * 3 + pk * 11 + sk) % len(ARCHETYPES)).cast("int").alias("a_i"),
    )
    # The fixed archetype rows: a bounded broadcast.
    x = li.join(F.broadcast(arch), "a_i")
    typ = F.col("a_type")
    res = F.col("a_resource")
    # Interval arithmetic on zone-less timestamps: the wall clock, in any
    # session time zone.
    x = x.withColumns({
        "cost": (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(0.0001).cast("decimal(18,4)")).cast(DEC),
        "start": F.lit(PERIOD_START).cast("timestamp_ntz") + F.make_dt_interval(
            days=(ok % PERIOD_DAYS).cast("int"), hours=(sk % 24).cast("int")),
    })
    cost, start = F.col("cost"), F.col("start")
    is_sp = F.col("a_term") != ""
    number = F.when(F.col("a_modulus").isNull(), pk).otherwise(pk % F.col("a_modulus"))
    resource = F.when(F.col("a_before").isNull(), F.lit("")).otherwise(F.concat("a_before", _s(number), "a_after"))
    cols = {
        "identity_line_item_id": F.concat_ws("-", _s(ok), _s(ln), _s(pk), _s(sk), _s(F.to_date("l_shipdate"))),
        "line_item_usage_start_date": start,
        "line_item_usage_end_date": start + F.col("a_length"),
        "bill_invoice_id": F.when(ok % 50 == 0, F.lit("")).when(ok % 50 == 1, F.lit(None).cast("string")).otherwise(F.lit("INV-1")),
        "bill_billing_entity": F.col("a_entity"),
        "line_item_legal_entity": F.when(res == "seller", F.concat(F.lit("Seller "), _s(pk % 3))).otherwise(F.lit("AWS")),
        "line_item_line_item_type": typ,
        "line_item_product_code": F.col("a_product"),
        "line_item_usage_type": F.col("a_usage"),
        "line_item_operation": F.col("a_operation"),
        "line_item_resource_id": resource,
        "line_item_usage_account_id": F.concat(F.lit("acct-"), _s(sk % 5)),
        "line_item_usage_amount": F.coalesce("a_amount", F.col("l_quantity").cast(DEC)),
        "line_item_unblended_cost": F.when(F.col("a_sign") == 0, F.lit(0).cast(DEC))
        .when(F.col("a_sign") < 0, (-cost).cast(DEC))
        .otherwise(cost),
        "line_item_line_item_description": F.col("a_desc"),
        "pricing_lease_contract_length": F.when(typ == "DiscountedUsage", F.when(pk % 2 == 0, F.lit("1yr")).otherwise(F.lit("3yr"))).otherwise(F.lit("")),
        "product_product_family": F.col("a_family"),
        "product_product_name": F.col("a_product"),
        "product_region": F.lit("China (Ningxia)"),
        "product_region_code": F.lit("cn-northwest-1"),
        "product_servicecode": F.col("a_svc"),
        "product_transfer_type": F.col("a_transfer"),
        "product_instance_type": F.col("a_itype"),
        "product_instance_type_family": F.col("a_ifam"),
        "product_vcpu": F.col("a_vcpu"),
        "product_physical_processor": F.col("a_proc"),
        "product_volume_api_name": F.col("a_volapi"),
        "product_volume_type": F.col("a_voltype"),
        "product_database_engine": F.col("a_engine"),
        "product_deployment_option": F.col("a_deploy"),
        "reservation_reservation_a_r_n": F.when(typ == "DiscountedUsage", F.concat(F.lit("arn:ri/"), _s(sk))).otherwise(F.lit("")),
        "reservation_effective_cost": F.when(typ == "DiscountedUsage", cost),
        "savings_plan_savings_plan_a_r_n": F.when(is_sp, F.concat(F.lit("arn:sp/"), _s(sk))).otherwise(F.lit("")),
        "savings_plan_savings_plan_effective_cost": F.when(typ == "SavingsPlanCoveredUsage", F.round(cost * F.lit(0.7).cast("decimal(2,1)"), 6).cast(DEC)),
        "savings_plan_purchase_term": F.col("a_term"),
        "resource_tags_user_name": F.when((res == "emr") & (pk % 7 != 0), F.concat(F.lit("cluster-"), _s(pk % 20))).otherwise(F.lit("")),
        "resource_tags_aws_elasticmapreduce_job_flow_id": F.when(F.col("a_tag") == "flow", F.concat(F.lit("j-C"), _s(pk % 12))).otherwise(F.lit("")),
        "resource_tags_aws_elasticmapreduce_instance_group_role": F.col("a_role"),
        "resource_tags_user_business": F.when(ln % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("unit-"), _s(pk % 6))),
        "resource_tags_user_department": F.when(ok % 5 == 0, F.lit("")).when(ok % 5 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("dept-"), _s(ok % 4))),
    }
    return x.select(*[c.alias(n) for n, c in cols.items()])


def _fee_rows(period: DataFrame, arn_col: str, prefix: str, fee_type: str,
              product: str, usage_type: str, term: str) -> DataFrame:
    """Fee lines of one commitment kind; ``period`` has start, label, arn, fee."""
    blank = F.lit("")
    cols = {
        "identity_line_item_id": F.concat(F.lit(prefix), F.col("label"), F.lit("-"), F.col("arn")),
        "line_item_usage_start_date": F.col("start"),
        "line_item_usage_end_date": F.col("start") + F.make_dt_interval(hours=F.lit(1)),
        "bill_invoice_id": F.lit("INV-1"),
        "bill_billing_entity": F.lit("AWS"),
        "line_item_legal_entity": F.lit("AWS"),
        "line_item_line_item_type": F.lit(fee_type),
        "line_item_product_code": F.lit(product),
        "line_item_usage_type": F.lit(usage_type),
        "line_item_operation": blank,
        "line_item_resource_id": blank,
        "line_item_usage_account_id": F.lit("acct-0"),
        "line_item_usage_amount": F.lit(FEE_HOURS).cast(DEC),
        "line_item_unblended_cost": F.col("fee").cast(DEC),
        "line_item_line_item_description": F.lit(f"{fee_type} {usage_type}"),
        "pricing_lease_contract_length": blank,
        "product_product_family": blank,
        "product_product_name": F.lit(product),
        "product_region": F.lit("China (Ningxia)"),
        "product_region_code": F.lit("cn-northwest-1"),
    }
    for name in BILL_COLUMNS:
        if name in cols:
            continue
        if name == arn_col:
            cols[name] = F.col("arn")
        elif name == "savings_plan_purchase_term":
            cols[name] = F.lit(term)
        elif name in ("reservation_effective_cost", "savings_plan_savings_plan_effective_cost"):
            cols[name] = F.lit(None).cast(DEC)
        else:
            cols[name] = blank
    return period.select(*[cols[n].alias(n) for n in BILL_COLUMNS])


def fee_lines(supplier: DataFrame) -> DataFrame:
    """RIFee rows per (month, supplier) and recurring-fee rows per (day, supplier):
    the model finds what was used of them and what is left.

    A supplier gives 187 of them, so a file that is one task to read holds the rows
    of many: suppliers are dealt out before they are repeated."""
    suppliers = supplier.count()
    base = F.lit(PERIOD_START).cast("timestamp_ntz")
    k = F.col("s_suppkey")
    balance = (F.floor(F.abs("s_acctbal")).cast("long") % 100).alias("b")

    def periods(rows: DataFrame, count: int) -> DataFrame:
        tasks = -(-suppliers * count // FEE_ROWS)
        if tasks > 1:
            rows = rows.select("s_suppkey", "s_acctbal").repartition(tasks)
        return rows.select(k, balance, F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("i"))

    months = (
        periods(supplier, PERIOD_MONTHS)
        .select((base + F.make_ym_interval(months=F.col("i"))).alias("start"), k, "b", "i")
        .select("start", F.date_format("start", "yyyy-MM").alias("label"), F.concat(F.lit("arn:ri/"), _s(k)).alias("arn"),
                (F.lit(RI_FEE_BASE) + F.col("b") + F.col("i")).cast(DEC).alias("fee"))
    )
    days = (
        periods(supplier, PERIOD_DAYS)
        .select((base + F.make_dt_interval(days=F.col("i"))).alias("start"), k, "b", "i")
        .select("start", F.date_format("start", "yyyy-MM-dd").alias("label"), F.concat(F.lit("arn:sp/"), _s(k)).alias("arn"),
                (F.lit(SP_FEE_BASE) + F.col("b") + (F.col("i") % 7) * F.lit(SP_FEE_DAY_STEP).cast("decimal(2,1)")).cast(DEC).alias("fee"))
    )
    ri_rows = _fee_rows(months, "reservation_reservation_a_r_n", "rifee-", "RIFee",
                        "AmazonEC2", RI_FEE_USAGE_TYPE, "")
    sp_rows = _fee_rows(days, "savings_plan_savings_plan_a_r_n", "spfee-",
                        "SavingsPlanRecurringFee", "ComputeSavingsPlans", SP_FEE_USAGE_TYPE, "1yr")
    return ri_rows.unionByName(sp_rows)


def lineitem_bill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived bill for one scale-factor directory (usage lines + fee lines)."""
    usage = usage_lines(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), archetypes(spark))
    fees = fee_lines(spark.read.parquet(f"{sf_dir}/supplier.parquet"))
    return usage.select(*BILL_COLUMNS).unionByName(fees)
