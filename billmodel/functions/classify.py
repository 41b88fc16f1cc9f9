"""Classification columns of the model (first match wins, exact labels).

Labels are kept byte for byte, including their spelling, since users filter on
them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fx import extract_or_null, first_match, lookup

# ---------------------------------------------------------------------------
# S3 storage level by operation, in the model's order.
# ---------------------------------------------------------------------------
S3_STORAGE_LEVELS: dict[str, str] = {
    "StandardStorage": "Standard",
    "IntelligentTieringIAStorage": "Intelligent Tiering (Infrequent)",
    "IntelligentTieringFAStorage": "Inlteligent Tiering (Frequent)",
    "IntelligentTieringAIAStorage": "Intelligent Tiering (Instant Archive)",
    "IntelligentTieringAAStorage": "Intelligent Tiering (Archive)",
    "IntelligentTieringDAAStorage": "Intelligent Tiering (Deep Archive)",
    "DeepArchiveStorage": "Deep Archive",
    "DeepArchiveStagingStorage": "Deep Archive - Multipart",
    "DeepArchiveS3ObjectOverhead": "Deep Archive - Name Metadata",
    "DeepArchiveObjectOverhead": "Deep Archive - Index Metadata",
    "ExpressOneZoneStorage": "Express One Zone",
}

# Data-transfer direction labels and patterns, in the model's
# order. Replacement strings use Java's $n group syntax.
DT_TRANSFER_TYPE_LABELS: dict[str, str] = {
    "AWS Inbound": "AWS ← Internet",
    "CloudFront to Origin": "CloudFront → Origin",
    "CloudFront Outbound": "CloudFront → Internet",
}
DT_CLOUDFRONT_IN = ("%-CloudFront-In-Bytes", r"^(.+?)-CloudFront-In-Bytes$", "CloudFront ← $1")
DT_CLOUDFRONT_OUT = ("%-CloudFront-Out-Bytes", r"^(.+?)-CloudFront-Out-Bytes$", "CloudFront → $1")
DT_REGIONAL = r"^(.+?)-DataTransfer-Regional-Bytes$"
DT_PEERING_AZ = "VPC1.AZ1 ← Peering → VPC2.AZ2"
DT_FARGATE = "FargateAZ1 ←→ FargateAZ2"
DT_PUBLIC_IP = "AZ1 ← Public IP → AZ2"
DT_VPC_ENDPOINT = "AZ1 ← VPC Endpoint → AZ2"
DT_LB_PUBLIC_IP_OPERATION = "LoadBalancing-PublicIP-%"  # compared with '=', so a literal %
DT_LB_PUBLIC_IP = "AZ1 ← Load Balacner Public IP → AZ2"
DT_AZ_TO_AZ = "$1.AZ1 ←→ $1.AZ2"
DT_OUT = ("%-DataTransfer-Out-Bytes", r"^(.+?)-DataTransfer-Out-Bytes$", "$1 → Internet")
DT_AWS_OUT = ("%-AWS-Out-Bytes", r"^(.+?)-(.+?)-AWS-Out-Bytes$", "$1 → $2")
DT_AWS_IN = ("%-AWS-In-Bytes", r"^(.+?)-(.+?)-AWS-In-Bytes$", "$1 ← $2")
DT_SAME_AZ = ("%-DataTransfer-xAZ-%-Bytes", "Same AZ")
DT_SAGEMAKER_IN = ("%-Hst:Data-Bytes-In", "SageMaker Endpoint ← Any")
DT_SAGEMAKER_OUT = ("%-Hst:Data-Bytes-Out", "SageMaker Endpoint → Any")
DT_PEERING = "VPC ← Peering → VPC"

# Instance-type patterns (family = text before the first dot;
# grand family = letters before the generation digit), RDS volume type.
INSTANCE_FAMILY = r"^(.+?)\..+$"
INSTANCE_GRAND_FAMILY = r"^(.+?)[1-9][0-9]*[a-z]*\..+$"
RDS_VOLUME_SUFFIX = r"^(.+-)?(.+)$"


def dt_direction(usage_type: Column, transfer_type: Column, operation: Column) -> Column:
    """``bb_dt_dir``: the direction of a data-transfer line."""
    def rx(pattern: str, repl: str) -> Column:
        return F.regexp_replace(usage_type, pattern, repl)

    intra_region = first_match(
        [
            (operation.like("VPCPeering-%"), rx(DT_REGIONAL, DT_PEERING_AZ)),
            (operation == "FargateTask", F.lit(DT_FARGATE)),
            (operation.like("PublicIP-%"), F.lit(DT_PUBLIC_IP)),
            (operation == "VpcEndpoint", F.lit(DT_VPC_ENDPOINT)),
            (operation == DT_LB_PUBLIC_IP_OPERATION, F.lit(DT_LB_PUBLIC_IP)),
        ],
        rx(DT_REGIONAL, DT_AZ_TO_AZ),
    )
    rules = [(transfer_type == k, F.lit(v)) for k, v in DT_TRANSFER_TYPE_LABELS.items()]
    rules += [
        (usage_type.like(DT_CLOUDFRONT_IN[0]), rx(*DT_CLOUDFRONT_IN[1:])),
        (usage_type.like(DT_CLOUDFRONT_OUT[0]), rx(*DT_CLOUDFRONT_OUT[1:])),
        (transfer_type == "IntraRegion", intra_region),
        (usage_type.like(DT_OUT[0]), rx(*DT_OUT[1:])),
        (usage_type.like(DT_AWS_OUT[0]), rx(*DT_AWS_OUT[1:])),
        (usage_type.like(DT_AWS_IN[0]), rx(*DT_AWS_IN[1:])),
        (usage_type.like(DT_SAME_AZ[0]), F.lit(DT_SAME_AZ[1])),
        (usage_type.like(DT_SAGEMAKER_IN[0]), F.lit(DT_SAGEMAKER_IN[1])),
        (usage_type.like(DT_SAGEMAKER_OUT[0]), F.lit(DT_SAGEMAKER_OUT[1])),
        (operation.like("VPCPeering-%"), F.lit(DT_PEERING)),
    ]
    return first_match(rules, transfer_type)


def s3_storage_level(operation: Column) -> Column:
    return lookup(operation, S3_STORAGE_LEVELS, operation)


def instance_family(type_family: Column, instance_type: Column) -> Column:
    """Declared family if not blank, else the text before the first dot."""
    return F.coalesce(
        F.nullif(type_family, F.lit("")),
        extract_or_null(instance_type, INSTANCE_FAMILY, 1, "."),
        F.lit("Unknown"),
    )


def instance_grand_family(instance_type: Column) -> Column:
    return F.coalesce(F.upper(extract_or_null(instance_type, INSTANCE_GRAND_FAMILY, 1, ".")), F.lit("Unknown"))


def processor_platform(processor: Column) -> Column:
    return F.when(processor.like("%Graviton%"), F.lit("Graviton")).otherwise(F.lit("x86"))


def rds_volume_type(usage_type: Column, description: Column, volume_type: Column) -> Column:
    return first_match(
        [
            (usage_type.like("%GP2-Storage%"), F.lit("GP2")),
            (usage_type.like("%GP3-Storage%"), F.lit("GP3")),
            (description.like("%io1%"), F.lit("IO1")),
            (description.like("%io2%"), F.lit("IO2")),
        ],
        F.when(volume_type != "", extract_or_null(volume_type, RDS_VOLUME_SUFFIX, 2)),
    )


def rds_usage_type(product_family: Column) -> Column:
    return lookup(product_family, {"Database Instance": "Instance", "Database Storage": "Storage"})


def ebs_usage_type(product_family: Column) -> Column:
    return F.when(product_family == "Storage Snapshot", F.lit("Snapshot")).otherwise(F.lit("Storage"))


def elb_usage_type(usage_type: Column) -> Column:
    return first_match(
        [
            (usage_type.like("%LoadBalancerUsage%"), F.lit("Usage")),
            (usage_type.like("%LCUUsage%"), F.lit("LCU")),
        ],
        usage_type,
    )
