"""One case per branch of the classification columns, plus blank and NULL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from billmodel.functions import classify as K
from billmodel.functions.fx import extract_or_null, least_one

DT_CASES = [
    # (usage type, transfer type, operation, expected direction)
    ("CNW1-DataTransfer-In-Bytes", "AWS Inbound", "RunInstances", "AWS ← Internet"),
    ("CN-DataTransfer-Out-OBytes", "CloudFront to Origin", "GET", "CloudFront → Origin"),
    ("CN-DataTransfer-Out-Bytes", "CloudFront Outbound", "GET", "CloudFront → Internet"),
    ("CNW1-CloudFront-In-Bytes", "Other", "RunInstances", "CloudFront ← CNW1"),
    ("CNW1-CloudFront-Out-Bytes", "Other", "RunInstances", "CloudFront → CNW1"),
    ("CNW1-DataTransfer-Regional-Bytes", "IntraRegion", "VPCPeering-In", "VPC1.AZ1 ← Peering → VPC2.AZ2"),
    ("CNW1-DataTransfer-Regional-Bytes", "IntraRegion", "FargateTask", "FargateAZ1 ←→ FargateAZ2"),
    ("CNW1-DataTransfer-Regional-Bytes", "IntraRegion", "PublicIP-In", "AZ1 ← Public IP → AZ2"),
    ("CNW1-DataTransfer-Regional-Bytes", "IntraRegion", "VpcEndpoint", "AZ1 ← VPC Endpoint → AZ2"),
    # the literal '%' in the model's equality: only this exact text reaches the branch
    ("CNW1-DataTransfer-Regional-Bytes", "IntraRegion", "LoadBalancing-PublicIP-%", "AZ1 ← Load Balacner Public IP → AZ2"),
    ("CNW1-DataTransfer-Regional-Bytes", "IntraRegion", "LoadBalancing-PublicIP-In", "CNW1.AZ1 ←→ CNW1.AZ2"),
    ("CNW1-DataTransfer-Regional-Bytes", "IntraRegion", "InterZone-In", "CNW1.AZ1 ←→ CNW1.AZ2"),
    # no region prefix: the regex does not match and the usage type comes back
    ("DataTransfer-Regional-Bytes", "IntraRegion", "InterZone-In", "DataTransfer-Regional-Bytes"),
    ("CNW1-DataTransfer-Out-Bytes", "AWS Outbound", "GetObject", "CNW1 → Internet"),
    ("CNW1-CNN1-AWS-Out-Bytes", "InterRegion Outbound", "InterRegion-Out", "CNW1 → CNN1"),
    ("CNW1-CNN1-AWS-In-Bytes", "InterRegion Inbound", "InterRegion-In", "CNW1 ← CNN1"),
    ("CNW1-DataTransfer-xAZ-In-Bytes", "Other", "InterZone-In", "Same AZ"),
    ("CNW1-Hst:Data-Bytes-In", "Other", "Invoke", "SageMaker Endpoint ← Any"),
    ("CNW1-Hst:Data-Bytes-Out", "Other", "Invoke", "SageMaker Endpoint → Any"),
    ("CNW1-TransitGateway-Bytes", "Other", "VPCPeering-Out", "VPC ← Peering → VPC"),
    ("CNW1-PaidEventsAnalyzed-Bytes", "Other", "Scan", "Other"),
    (None, None, None, None),
    ("", "", "", ""),
]


def _eval(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_dt_direction_every_branch(spark):
    rows = [c[:3] for c in DT_CASES]
    got = _eval(spark, rows, "u string, t string, o string",
                K.dt_direction(F.col("u"), F.col("t"), F.col("o")))
    assert got == [c[3] for c in DT_CASES]


def test_s3_storage_levels(spark):
    ops = list(K.S3_STORAGE_LEVELS) + ["SomethingElse", None]
    got = _eval(spark, [(o,) for o in ops], "o string", K.s3_storage_level(F.col("o")))
    assert got == list(K.S3_STORAGE_LEVELS.values()) + ["SomethingElse", None]
    assert "Inlteligent Tiering (Frequent)" in got  # label kept byte for byte


@pytest.mark.parametrize("usage,desc,vtype,expected", [
    ("CNW1-RDS:GP2-Storage", "", "General Purpose", "GP2"),
    ("CNW1-RDS:GP3-Storage", "", "General Purpose-GP3", "GP3"),
    ("CNW1-RDS:PIOPS-Storage", "per GB-month of io1 storage", "Provisioned IOPS", "IO1"),
    ("CNW1-RDS:PIOPS-Storage", "per GB-month of io2 storage", "Provisioned IOPS", "IO2"),
    ("CNW1-RDS:Magnetic", "", "Magnetic-Standard", "Standard"),
    ("CNW1-RDS:Magnetic", "", "Magnetic", "Magnetic"),
    ("Usage", "", "", None),
    ("Usage", "", None, None),
])
def test_rds_volume_type(spark, usage, desc, vtype, expected):
    got = _eval(spark, [(usage, desc, vtype)], "u string, d string, v string",
                K.rds_volume_type(F.col("u"), F.col("d"), F.col("v")))
    assert got == [expected]


@pytest.mark.parametrize("fam,itype,family,grand", [
    ("m5", "m5.xlarge", "m5", "M"),
    ("", "m6g.2xlarge", "m6g", "M"),
    ("", "r6gd.4xlarge", "r6gd", "R"),
    ("", "db.m5.large", "db", "DB.M"),
    ("", "cache.m6g.large", "cache", "CACHE.M"),
    ("", "x2iedn.xlarge", "x2iedn", "X"),
    ("", "", "Unknown", "Unknown"),
    (None, None, "Unknown", "Unknown"),
])
def test_instance_family(spark, fam, itype, family, grand):
    df = spark.createDataFrame([(fam, itype)], "f string, t string")
    r = df.select(K.instance_family(F.col("f"), F.col("t")).alias("a"),
                  K.instance_grand_family(F.col("t")).alias("b")).first()
    assert (r.a, r.b) == (family, grand)


def test_platform_elb_ebs(spark):
    df = spark.createDataFrame([("AWS Graviton2 Processor", "CNW1-LoadBalancerUsage", "Storage Snapshot"),
                                ("Intel Xeon", "CNW1-LCUUsage", "Storage"),
                                (None, "CNW1-DataProcessing-Bytes", None)], "p string, u string, f string")
    got = [tuple(r) for r in df.select(K.processor_platform(F.col("p")), K.elb_usage_type(F.col("u")),
                                        K.ebs_usage_type(F.col("f"))).collect()]
    assert got == [("Graviton", "Usage", "Snapshot"), ("x86", "LCU", "Storage"),
                   ("x86", "CNW1-DataProcessing-Bytes", "Storage")]


def test_extract_or_null_and_least(spark):
    df = spark.createDataFrame([("abc", 0.5), ("", 1.5), (None, None)], "s string, x double")
    got = [tuple(r) for r in df.select(extract_or_null(F.col("s"), r"^(b)", 1),
                                        extract_or_null(F.col("s"), r"^(a)", 1),
                                        least_one(F.col("x"))).collect()]
    assert got == [(None, "a", 0.5), (None, None, 1.0), (None, None, None)]


SEARCHED = [("RI_INSTANCE_TYPE", 1, ":"), ("RDS_NAME", 1, ":"), ("EMR_CLUSTER_ID", 1, "j-"), ("S3_REQUEST_TIER", 1, "-Tier"),
            ("ELB_NAME", 2, ":loadbalancer/"), ("ELB_TYPE", 1, "LoadBalancing:"), ("INSTANCE_FAMILY", 1, "."), ("INSTANCE_GRAND_FAMILY", 1, ".")]


def test_texts_are_searched_once(spark):
    """Texts that can't match are not searched, others once; the values are those of an extract, NULL for none."""
    from billmodel.operators import facets

    texts = [None, "", ":", ".", "a:", ":b", "a:b:", "a:b:c", "a:b\nc:d", "a:b\n", "j-", "j-C1", "x/j-C1/j-C2", "j-a\nj-b", "u-Requests-Tier1",
             "-Tier1", "u-Tier1-Tier2", "u-Tierx", "n:loadbalancer/app/lb-1/50dc", "n:loadbalancer/lb-1", "LoadBalancing:", "LoadBalancing:Net",
             "xLoadBalancing:Net", "m5.large", "db.m6g.xlarge", "m5.", ".large", "u-24tb1.metal", "General Purpose-GP3", "-", "GP3"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    s = F.col("s")
    found = [extract_or_null(s, getattr(facets, n, None) or getattr(K, n), g, holds) for n, g, holds in SEARCHED]
    plain = [F.nullif(F.regexp_extract(s, getattr(facets, n, None) or getattr(K, n), g), F.lit("")) for n, g, _ in SEARCHED]
    out = df.select(*[c.alias(f"c{i}") for i, c in enumerate(found)])
    assert [tuple(r) for r in out.collect()] == [tuple(r) for r in df.select(*plain).collect()]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract") == len(SEARCHED)  # nullif(regexp_extract) has it twice
    volume = K.rds_volume_type(F.lit("u"), F.lit("d"), s)
    suffix = F.nullif(F.regexp_extract(s, K.RDS_VOLUME_SUFFIX, 2), F.lit(""))
    assert df.where(~volume.eqNullSafe(suffix)).count() == 0


def test_a_search_is_the_last_test_of_a_line(spark):
    """The pattern of instance hours is tried only on lines that pass the plain tests."""
    from billmodel.operators import facets

    names = ["line_item_product_code", "line_item_usage_type", "line_item_line_item_type", "product_vcpu", "product_servicecode"]
    df = spark.createDataFrame([("AmazonEC2", "u-BoxUsage:m5.large", "Usage", "2", "AmazonEC2")], names)
    plan = df.where(facets.ec2().predicate)._jdf.queryExecution().analyzed().toString()
    assert all(plan.index("RLIKE") > plan.index(n) for n in names) and plan.index("RLIKE") > plan.rindex("NOT (")
    assert df.where(facets.ec2().predicate).count() == 1
