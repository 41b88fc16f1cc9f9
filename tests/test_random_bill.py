"""A seeded random bill, NULLs and blanks everywhere, through every query:
Spark's single pass against the rule tables in DuckDB."""

from __future__ import annotations

import datetime as dt
import os
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

from billmodel import CostModel
from billmodel.plans.oracle import oracle_queries
from billmodel.plans.registry import edge, model_queries
from billmodel.sources.fixture import BILL_COLUMNS
from conftest import DECIMAL_COLUMNS, TIMESTAMP_COLUMNS, make_bill
from tools.oracle_check import _key, _norm

ARN = "arn:aws-cn:"
POOLS = {
    "line_item_line_item_type": ["Usage"] * 6 + ["Tax", "Credit", "Fee", "DiscountedUsage", "SavingsPlanCoveredUsage",
                                                 "SavingsPlanNegation", "SavingsPlanRecurringFee", "RIFee", None],
    "line_item_product_code": ["AmazonEC2"] * 3 + ["AmazonRDS", "AmazonS3", "ElasticMapReduce", "AWSELB", "AmazonVPC",
                                                   "AWSDataTransfer", "ComputeSavingsPlans", "AmazonECS", "mkt-1", None],
    "line_item_usage_type": [
        "CNW1-BoxUsage:m5.xlarge", "CNW1-SpotUsage:c5.large", "CNW1-DedicatedUsage:m5.large", "CNW1-BoxUsage",
        "CNW1-HeavyUsage:m5.large", "CNW1-EBS:VolumeUsage.gp3", "CNW1-EBS:SnapshotUsage", "CNW1-EBS:VolumeP-IOPS.gp3",
        "CNW1-DataTransfer-Regional-Bytes", "DataTransfer-Regional-Bytes", "CNW1-DataTransfer-Out-Bytes",
        "CNW1-CNN1-AWS-Out-Bytes", "CNW1-CNN1-AWS-In-Bytes", "CNW1-CloudFront-In-Bytes", "CNW1-CloudFront-Out-Bytes",
        "CNW1-DataTransfer-xAZ-Out-Bytes", "CNW1-Hst:Data-Bytes-In", "CNW1-Hst:Data-Bytes-Out",
        "CNW1-TimedStorage-ByteHrs", "CNW1-TimedStorage-GlacierByteHrs", "TimedStorage-ByteHrs",
        "CNW1-Requests-Tier1", "CNW1-Requests-GDA-Tier2", "Requests-Tier1", "CNW1-LoadBalancerUsage", "CNW1-LCUUsage",
        "CNW1-RDS:GP2-Storage", "CNW1-RDS:GP3-Storage", "CNW1-RDS:PIOPS-Storage", "CNW1-InstanceUsage:db.r6g.large",
        "CNW1-NatGateway-Hours", "", None],
    "line_item_operation": [
        "RunInstances", "VPCPeering-In", "FargateTask", "PublicIP-Out", "VpcEndpoint", "LoadBalancing-PublicIP-%",
        "LoadBalancing:Network", "LoadBalancing", "StandardStorage", "IntelligentTieringAIAStorage",
        "IntelligentTieringDAAStorage", "DeepArchiveStorage", "DeepArchiveS3ObjectOverhead",
        "DeepArchiveObjectOverhead", "ExpressOneZoneStorage", "StandardIASizeOverhead", "GetObject", "", None],
    "product_product_family": ["Compute Instance"] * 3 + [
        "Data Transfer", "Data Transfer", "Storage", "Storage Snapshot", "NAT Gateway", "Database Instance",
        "Database Storage", "API Request", "", None],
    "product_servicecode": ["AmazonEC2", "AmazonEC2", "AWSDataTransfer", "", None],
    "product_transfer_type": ["AWS Inbound", "CloudFront to Origin", "CloudFront Outbound", "IntraRegion",
                              "IntraRegion", "AWS Outbound", "Other", "", None],
    "product_instance_type": ["m5.xlarge", "db.r6g.large", "c7gn.16xlarge", "u-6tb1.metal", "m5", "", None],
    "product_instance_type_family": ["m5", "", "", None],
    "product_vcpu": ["4", "16", "", "", None],
    "product_physical_processor": ["AWS Graviton2 Processor", "Intel Xeon", "", None],
    "product_volume_api_name": ["gp3", "io2", "", None],
    "product_volume_type": ["General Purpose-GP3", "Provisioned IOPS", "Magnetic", "", None],
    "product_database_engine": ["MySQL", "", None],
    "product_deployment_option": ["Multi-AZ", "", None],
    "line_item_line_item_description": ["per GB-month of io2 storage", "io1 provisioned", "Usage", "", None],
    "line_item_resource_id": [
        "i-1", "i-2", "vol-2", ARN + "rds:cn-northwest-1:1:db:db-3", ARN + "elb:cn-northwest-1:1:loadbalancer/net/nlb-1/abc",
        ARN + "elb:cn-northwest-1:1:loadbalancer/app/alb-2/def", ARN + "elb:cn-northwest-1:1:loadbalancer/clb-3",
        "bucket-1", "", None],
    "bill_invoice_id": ["INV-1"] * 8 + ["", None],
    "bill_billing_entity": ["AWS"] * 4 + ["AWS Marketplace", None],
    "line_item_legal_entity": ["Seller A", "AWS", None],
    "product_product_name": ["Product X", None],
    "reservation_reservation_a_r_n": ["ri/1", "ri/2", "", None],
    "savings_plan_savings_plan_a_r_n": ["sp/1", "sp/2", "", None],
    "pricing_lease_contract_length": ["1yr", "3yr", "", None],
    "savings_plan_purchase_term": ["1yr", "", None],
    "resource_tags_aws_elasticmapreduce_job_flow_id": ["j-X1", "j-X2", "j-X9", "", "", None],
    "resource_tags_aws_elasticmapreduce_instance_group_role": ["MASTER", "CORE", "", "", None],
    "resource_tags_user_department": ["dept-1", "dept-2", "", None],
    "resource_tags_user_business": ["unit-1", "", None],
    "product_region": ["China (Ningxia)", None],
    "product_region_code": ["cn-northwest-1", None],
    "line_item_usage_account_id": ["acct-1", "acct-2", None],
}


def _money(r: random.Random, nullable: bool = True):
    if nullable and r.random() < 0.1:
        return None
    return Decimal(r.randint(-200_000, 2_000_000)) / Decimal(100_000)


def random_bill_rows(seed: int = 7, n: int = 2500) -> list[dict]:
    r = random.Random(seed)
    rows = []
    for i in range(n):
        row = {c: r.choice(v) for c, v in POOLS.items()}
        row["identity_line_item_id"] = None if r.random() < 0.01 else f"id-{i}"
        start = dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randint(0, 24 * 180))
        row["line_item_usage_start_date"] = start
        row["line_item_usage_end_date"] = start + dt.timedelta(hours=r.choice([1, 1, 1, 0, 2, 3, -2]))
        row["line_item_usage_amount"] = _money(r)
        row["line_item_unblended_cost"] = _money(r)
        row["reservation_effective_cost"] = _money(r)
        row["savings_plan_savings_plan_effective_cost"] = _money(r)
        if row["line_item_product_code"] == "ElasticMapReduce":
            # Clusters of two names, and tag ids that differ from the fee id: one
            # row a line, tag id first, the smaller name (the stated difference).
            k = r.randint(1, 3)
            row["line_item_resource_id"] = ARN + f"elasticmapreduce:cn-northwest-1:1:cluster/j-X{k}"
            row["resource_tags_user_name"] = r.choice([f"name-{k}", f"alias-{k}", "", None])
            row["resource_tags_aws_elasticmapreduce_job_flow_id"] = r.choice([f"j-X{k}", "j-X2", "j-X9", "", None])
        else:
            row["resource_tags_user_name"] = r.choice(["someone", "", None])
        rows.append(row)
    return rows


@pytest.fixture(scope="module")
def setup(spark):
    rows = random_bill_rows(int(os.environ.get("BILLMODEL_RANDOM_SEED", "7")))
    bill = make_bill(spark, rows)
    fields = []
    for c in BILL_COLUMNS:
        t = pa.decimal128(18, 6) if c in DECIMAL_COLUMNS else pa.timestamp("us") if c in TIMESTAMP_COLUMNS else pa.string()
        fields.append(pa.field(c, t))
    table = pa.Table.from_pylist([{c: row[c] for c in BILL_COLUMNS} for row in rows], schema=pa.schema(fields))
    con = duckdb.connect()
    con.register("random_bill", table)
    return CostModel(bill), con, oracle_queries("SELECT * FROM random_bill")


@pytest.mark.parametrize("name", sorted(model_queries()))
def test_random_bill_matches_the_rules(setup, name):
    model, con, sqls = setup
    sdf = edge(model_queries()[name](model))
    rel = con.sql(sqls[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    si = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    di = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    a = sorted((tuple(_norm(r[i]) for i in si) for r in sdf.collect()), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in rel.fetchall()), key=_key)
    assert len(a) == len(b)
    assert a == b
