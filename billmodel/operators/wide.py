"""The wide cost table, built in one pass over the base bill.

The model builds it as the base LEFT JOINed to 15 facet views on ``bb_id``,
a theta join to the EMR name dimension, and FULL JOINs to the two leftover
views. Here:

* every facet column is a guarded ``CASE WHEN predicate THEN expr END`` of
  the same scan (equal to the LEFT JOIN when ``bb_id`` is unique, which
  ``key_check`` verifies), so the base is never shuffled;
* the EMR names come from two equi-joins against a size-checked broadcast
  dimension (``emr.attach_cluster_names``);
* the leftover rows carry suffixed keys no base row has, so the FULL JOINs
  only append rows: a ``unionByName``.

The result keeps the model's column order: model columns, then every base
column (the bill passes through), then ``bb_usage_year_month`` last, which is
the partition column of the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import commitments, emr, facets

# Fee line types that the wide table replaces by used + unused rows.
REPLACED_FEE_TYPES = ("SavingsPlanNegation", "SavingsPlanRecurringFee", "RIFee")

# Model columns of the wide table, in order (before the passed-through base).
WIDE_MODEL_COLUMNS = [
    "bb_id", "bb_cost", "bb_service", "bb_parent_service",
    "bb_ebs_volume_id", "bb_ebs_volume_type", "bb_ebs_gb_month", "bb_ebs_usage_type",
    "bb_ec2_instance_id", "bb_ec2_instance_type", "bb_ec2_instance_type_family",
    "bb_ec2_instance_type_grand_family", "bb_ec2_seconds", "bb_ec2_vcpu_seconds", "bb_ec2_platform",
    "bb_ri_arn", "bb_ri_term_year", "bb_sp_arn", "bb_sp_term_year", "bb_sp_cost_unused",
    "bb_ec2_nat_hours", "bb_vpc_usage_type", "bb_sp_cost_type", "bb_ri_cost_type",
    "bb_emr_cluster_name", "bb_emr_cluster_id", "bb_emr_instance_role", "bb_ec2_purchase_option",
    "bb_s3_gb_month", "bb_s3_storage_level", "bb_s3_is_overhead", "bb_s3_request_cost_tier",
    "bb_s3_num_requests", "bb_s3_bucket", "bb_s3_usage_type", "bb_mp_seller", "bb_mp_product_name",
    "bb_usage_date", "bb_dt_type", "bb_dt_gb", "bb_dt_dir",
    "bb_rds_usage_type", "bb_rds_engine", "bb_rds_instance_arn", "bb_rds_instance_name",
    "bb_rds_platform", "bb_rds_azness", "bb_rds_instance_type", "bb_rds_instance_type_family",
    "bb_rds_instance_type_grand_family", "rds_instance_seconds", "rds_storage_volume_type",
    "rds_storage_gb_month", "bb_elb_name", "bb_elb_usage_type", "bb_elb_type",
]
PARTITION_COLUMN = "bb_usage_year_month"
# The commitment of used and unused rows alike. The model's table has none for
# unused RI rows, so it is there for those that ask for it.
ARN_COLUMN = "_bb_commitment_arn"


def _facets(rds_only: bool) -> dict:
    fs = {name: make() for name, make in facets.FACETS.items() if name != "rds"}
    fs["rds"] = facets.rds(rds_only)
    return fs


def _with_cluster_names(base: DataFrame, fs: dict, names: DataFrame | None, max_bytes: int | None, all_names: bool) -> DataFrame:
    """Kept base rows plus the EMR name lookup (``_emr_*`` columns; without
    ``names`` only the candidate ids).

    The lookups run on the narrow base rows, before the wide projection, so
    the joins stay inside whole-stage code generation and the wide row is
    built once, at the top.
    """
    fee, other = fs["emr_fee"], fs["emr_other"]
    typ = F.col("line_item_line_item_type")
    kept = base.where(typ.isNull() | ~typ.isin(*REPLACED_FEE_TYPES)).select(
        "*",
        other.guarded("bb_emr_cluster_id").alias("_emr_tag_id"),
        fee.guarded("bb_emr_cluster_id").alias("_emr_fee_id"),
    )
    if names is None:
        return kept
    flow = F.col("resource_tags_aws_elasticmapreduce_job_flow_id")
    may_have_id = F.coalesce(flow != "", F.lit(False)) | F.coalesce(fee.predicate, F.lit(False))
    return emr.attach_cluster_names(kept, names, "_emr_tag_id", "_emr_fee_id", max_bytes, all_names, may_have_id=may_have_id)


def _base_rows(base: DataFrame, rds_only: bool, names: DataFrame | None, max_bytes: int | None, all_names: bool) -> DataFrame:
    """Model columns of every kept base row: one projection over one scan."""
    fs = _facets(rds_only)
    ebs, ec2, od, spot, ri, sp = (fs[k] for k in ("ebs", "ec2", "ec2_on_demand", "ec2_spot", "ri_used", "sp_used"))
    dt, nat, fee, other, s3s, s3r, mp, rds, elb = (
        fs[k] for k in ("data_transfer", "nat_gateway", "emr_fee", "emr_other", "s3_storage",
                        "s3_requests", "marketplace", "rds", "elb"))
    c = F.col
    model = {
        "bb_cost": F.coalesce(sp.guarded("bb_cost_used"), ebs.guarded("bb_cost"), od.guarded("bb_cost_used"),
                              ri.guarded("bb_cost_used"), c("line_item_unblended_cost")),
        "bb_service": F.coalesce(dt.guarded("_bb_service"), ebs.guarded("_bb_service"), ec2.guarded("_bb_service"),
                                 mp.guarded("_bb_service"), c("_bb_service")),
        "bb_parent_service": F.coalesce(fee.guarded("bb_parent_service"), other.guarded("bb_parent_service"),
                                        dt.guarded("_bb_parent_service"), ebs.guarded("_bb_parent_service"),
                                        ec2.guarded("_bb_service"), mp.guarded("_bb_service"), c("_bb_service")),
        "bb_ebs_volume_id": ebs.guarded("bb_ebs_volume_id"),
        "bb_ebs_volume_type": ebs.guarded("bb_ebs_volume_type"),
        "bb_ebs_gb_month": ebs.guarded("bb_ebs_gb_month"),
        "bb_ebs_usage_type": ebs.guarded("_bb_ebs_usage_type"),
        "bb_ec2_instance_id": ec2.guarded("bb_ec2_instance_id"),
        "bb_ec2_instance_type": ec2.guarded("_bb_ec2_instance_type"),
        "bb_ec2_instance_type_family": ec2.guarded("_bb_ec2_instance_type_family"),
        "bb_ec2_instance_type_grand_family": ec2.guarded("_bb_ec2_instance_type_grand_family"),
        "bb_ec2_seconds": ec2.guarded("bb_ec2_seconds"),
        "bb_ec2_vcpu_seconds": ec2.guarded("bb_ec2_vcpu_seconds"),
        "bb_ec2_platform": ec2.guarded("bb_ec2_platform"),
        "bb_ri_arn": ri.guarded("bb_ri_arn"),
        "bb_ri_term_year": ri.guarded("bb_ri_term_year"),
        "bb_sp_arn": sp.guarded("bb_sp_arn"),
        "bb_sp_term_year": sp.guarded("bb_sp_term_year"),
        "bb_sp_cost_unused": F.lit(None),
        "bb_ec2_nat_hours": nat.guarded("_bb_ec2_nat_hours"),
        "bb_vpc_usage_type": nat.guarded("_bb_vpc_usage_type"),
        "bb_sp_cost_type": sp.guarded("bb_sp_cost_type"),
        "bb_ri_cost_type": ri.guarded("bb_ri_cost_type"),
        "bb_emr_cluster_name": F.coalesce(c("_emr_dim_name"), fee.guarded("bb_emr_cluster_name"),
                                          c("_emr_dim_id"), c("_emr_fee_id")),
        "bb_emr_cluster_id": F.coalesce(c("_emr_tag_id"), c("_emr_fee_id")),
        "bb_emr_instance_role": other.guarded("bb_emr_instance_role"),
        "bb_ec2_purchase_option": F.coalesce(od.guarded("bb_ec2_purchase_option"), ri.guarded("bb_ec2_purchase_option"),
                                             sp.guarded("bb_usage_type"), spot.guarded("bb_ec2_purchase_option")),
        "bb_s3_gb_month": s3s.guarded("bb_s3_gb_month"),
        "bb_s3_storage_level": s3s.guarded("bb_s3_storage_level"),
        "bb_s3_is_overhead": s3s.guarded("bb_s3_is_overhead"),
        "bb_s3_request_cost_tier": s3r.guarded("bb_s3_request_cost_tier"),
        "bb_s3_num_requests": s3r.guarded("bb_s3_num_requests"),
        "bb_s3_bucket": F.coalesce(s3s.guarded("bb_s3_bucket"), s3r.guarded("bb_s3_bucket")),
        "bb_s3_usage_type": F.coalesce(s3s.guarded("bb_s3_usage_type"), s3r.guarded("bb_s3_usage_type")),
        "bb_mp_seller": mp.guarded("bb_mp_seller"),
        "bb_mp_product_name": mp.guarded("bb_mp_product_name"),
        "bb_usage_date": c("_bb_usage_date"),
        "bb_dt_type": dt.guarded("_bb_dt_type"),
        "bb_dt_gb": dt.guarded("_bb_dt_gb"),
        "bb_dt_dir": dt.guarded("bb_dt_dir"),
        "bb_rds_usage_type": rds.guarded("bb_rds_usage_type"),
        "bb_rds_engine": rds.guarded("bb_rds_engine"),
        "bb_rds_instance_arn": rds.guarded("bb_rds_instance_arn"),
        "bb_rds_instance_name": rds.guarded("bb_rds_instance_name"),
        "bb_rds_platform": rds.guarded("_bb_rds_platform"),
        "bb_rds_azness": rds.guarded("bb_rds_azness"),
        "bb_rds_instance_type": rds.guarded("bb_rds_instance_type"),
        "bb_rds_instance_type_family": rds.guarded("_bb_rds_instance_type_family"),
        "bb_rds_instance_type_grand_family": rds.guarded("_bb_rds_instance_type_grand_family"),
        "rds_instance_seconds": rds.guarded("rds_instance_seconds"),
        "rds_storage_volume_type": rds.guarded("rds_storage_volume_type"),
        "rds_storage_gb_month": rds.guarded("rds_storage_gb_month"),
        "bb_elb_name": elb.guarded("bb_elb_name"),
        "bb_elb_usage_type": elb.guarded("bb_elb_usage_type"),
        "bb_elb_type": elb.guarded("bb_elb_type"),
    }
    if names is None:
        del model["bb_emr_cluster_name"]
    rows = _with_cluster_names(base, fs, names, max_bytes, all_names)
    return rows.select(
        c("bb_id"),
        *[model[n].alias(n) for n in WIDE_MODEL_COLUMNS if n in model],
        *[c(n) for n in base.columns if n != "bb_id"],
        F.coalesce(sp.guarded("bb_sp_arn"), ri.guarded("bb_ri_arn")).alias(ARN_COLUMN),
        c("_bb_usage_year_month").alias(PARTITION_COLUMN),
    )


def _leftover_rows(base: DataFrame, fill_unused: bool, fee_grain: str, used: DataFrame | None) -> DataFrame:
    """Leftover rows of both kinds, from one pass over the fees and one over the usage."""
    left = commitments.unused(base, ("ri", "sp"), fill_unused=fill_unused, fee_grain=fee_grain, used=used)
    sp, ri = F.col("kind") == "sp", F.col("kind") == "ri"
    return left.select(
        "bb_id",
        F.col("cost").alias("bb_cost"),
        F.col("service").alias("bb_service"),
        F.col("service").alias("bb_parent_service"),
        F.when(sp, F.col("arn")).alias("bb_sp_arn"),
        F.when(sp, F.col("cost")).alias("bb_sp_cost_unused"),
        F.when(sp, F.lit("Unused")).alias("bb_sp_cost_type"),
        F.when(ri, F.lit("Unused")).alias("bb_ri_cost_type"),
        F.col("arn").alias(ARN_COLUMN),
        F.col("day").alias("bb_usage_date"),
        F.col("month").alias(PARTITION_COLUMN),
    )


def wide_costs(base: DataFrame, *, fill_unused: bool = False, fee_grain: str = "row",
               rds_only: bool = False, emr_broadcast_bytes: int | None = None,
               emr_names: DataFrame | None = None, with_names: bool = True, used: DataFrame | None = None,
               all_names: bool = False, with_arn: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """The wide cost table (``bb_bwt_costs``) from the base bill (``base_costs``).

    Options default to the model's behaviour: ``fill_unused`` (COALESCE a
    day without savings-plan usage to 0), ``fee_grain='group'`` (sum fee rows
    per commitment and period before subtracting), ``rds_only`` (fill the RDS
    columns on AmazonRDS lines only). ``emr_names`` is a dimension of one name
    per cluster id (``emr.cluster_name_by_id``), for instance of the whole bill
    when ``base`` holds only some months; ``used`` are commitments' totals that are
    known already (``commitments.used_totals``). ``with_names=False`` leaves the EMR
    name column out, and with it the dimension: nothing runs before the plan is
    used, for the many reports that do not read the name. ``all_names`` repeats a
    line for every name its clusters have, as the model does (``emr``; a given
    ``emr_names`` then has arrays). ``with_arn`` adds the hidden column of every
    row's commitment. ``lines`` are the base's rows once more, for the branch that
    reads them all (with an observation on them, say).
    """
    names = None
    if with_names:
        by_id = emr.cluster_names_by_id if all_names else emr.cluster_name_by_id
        names = by_id(base) if emr_names is None else emr_names
    rows = _base_rows(base if lines is None else lines, rds_only, names, emr_broadcast_bytes, all_names)
    order = [c for c in rows.columns if with_arn or c != ARN_COLUMN]
    return rows.unionByName(_leftover_rows(base, fill_unused, fee_grain, used), allowMissingColumns=True).select(*order)
