"""The model as data, for the DuckDB oracle.

Nothing here is written as a chain of views or joins. What a line *is* and how
it is labelled are rows of rule tables: a test names a bill column, a comparison
and a text. The bill's tested columns are turned into long form (one row per
line and column), joined to the tests, and a line belongs to a facet, or takes a
label, when all tests of one of the rule's alternatives hold (a NULL passes no
test); of several labels the lowest rank wins. Columns are then filled from
tables of sources, and unused commitments of both kinds come from one statement
over fees and used totals.
"""

from __future__ import annotations

# What makes a line a member of a facet, as alternatives of tests
# (column, comparison, text). ``rds`` has no test: every line.
MEMBERS: dict[str, list[list[tuple[str, str, str]]]] = {
    "data_transfer": [[("product_product_family", "=", "Data Transfer")]],
    "ebs": [[("line_item_usage_type", "like", "%EBS:%"), ("line_item_line_item_type", "<>", "Credit")]],
    "ec2": [[("line_item_product_code", "=", "AmazonEC2"), ("line_item_usage_type", "unlike", "%EBS:Volume%"),
             ("line_item_usage_type", "regex", "(Box|Spot|Dedicated|Host|HostBox|ReservedHost|Sched|Unused)Usage"),
             ("product_vcpu", "<>", ""), ("product_servicecode", "<>", "AWSDataTransfer"),
             ("line_item_line_item_type", "<>", "Credit")]],
    "ec2_on_demand": [[("line_item_line_item_type", "=", "Usage"), ("product_product_family", "=", "Compute Instance"),
                       ("line_item_usage_type", "unlike", "%SpotUsage%")]],
    "ec2_spot": [[("line_item_line_item_type", "=", "Usage"), ("product_product_family", "=", "Compute Instance"),
                  ("line_item_usage_type", "like", "%SpotUsage%")]],
    "nat_gateway": [[("product_product_family", "=", "NAT Gateway")]],
    "ri_paid": [[("line_item_line_item_type", "=", "RIFee")]],
    "ri_used": [[("line_item_line_item_type", "=", "DiscountedUsage")]],
    "sp_used": [[("line_item_line_item_type", "=", "SavingsPlanCoveredUsage")]],
    "sp_negation": [[("line_item_line_item_type", "=", "SavingsPlanNegation")]],
    "sp_recurring": [[("line_item_line_item_type", "=", "SavingsPlanRecurringFee")]],
    "rds": [[]],
    "emr_fee": [[("line_item_product_code", "=", "ElasticMapReduce")]],
    "emr_other": [[("resource_tags_aws_elasticmapreduce_job_flow_id", "<>", "")],
                  [("resource_tags_aws_elasticmapreduce_instance_group_role", "<>", "")]],
    "s3_storage": [[("line_item_usage_type", "like", "%-TimedStorage-%"), ("line_item_product_code", "=", "AmazonS3")]],
    "s3_requests": [[("line_item_usage_type", "like", "%-Requests-%"), ("line_item_product_code", "=", "AmazonS3")]],
    "elb": [[("line_item_product_code", "=", "AWSELB")]],
    "marketplace": [[("bill_billing_entity", "=", "AWS Marketplace")]],
}
RDS_ONLY = [[("line_item_product_code", "=", "AmazonRDS")]]

_TRANSFER, _USAGE, _OPERATION = "product_transfer_type", "line_item_usage_type", "line_item_operation"
_INTRA = (_TRANSFER, "=", "IntraRegion")
# Labels in the order in which they are tried: tests, a pattern
# (of the usage type; none: the text itself), the text.
LABELS: dict[str, list[tuple[list[tuple[str, str, str]], str | None, str]]] = {
    "direction": [
        ([(_TRANSFER, "=", "AWS Inbound")], None, "AWS ← Internet"),
        ([(_TRANSFER, "=", "CloudFront to Origin")], None, "CloudFront → Origin"),
        ([(_TRANSFER, "=", "CloudFront Outbound")], None, "CloudFront → Internet"),
        ([(_USAGE, "like", "%-CloudFront-In-Bytes")], r"^(.+?)-CloudFront-In-Bytes$", r"CloudFront ← \1"),
        ([(_USAGE, "like", "%-CloudFront-Out-Bytes")], r"^(.+?)-CloudFront-Out-Bytes$", r"CloudFront → \1"),
        ([_INTRA, (_OPERATION, "like", "VPCPeering-%")], r"^(.+?)-DataTransfer-Regional-Bytes$", "VPC1.AZ1 ← Peering → VPC2.AZ2"),
        ([_INTRA, (_OPERATION, "=", "FargateTask")], None, "FargateAZ1 ←→ FargateAZ2"),
        ([_INTRA, (_OPERATION, "like", "PublicIP-%")], None, "AZ1 ← Public IP → AZ2"),
        ([_INTRA, (_OPERATION, "=", "VpcEndpoint")], None, "AZ1 ← VPC Endpoint → AZ2"),
        ([_INTRA, (_OPERATION, "=", "LoadBalancing-PublicIP-%")], None, "AZ1 ← Load Balacner Public IP → AZ2"),
        ([_INTRA], r"^(.+?)-DataTransfer-Regional-Bytes$", r"\1.AZ1 ←→ \1.AZ2"),
        ([(_USAGE, "like", "%-DataTransfer-Out-Bytes")], r"^(.+?)-DataTransfer-Out-Bytes$", r"\1 → Internet"),
        ([(_USAGE, "like", "%-AWS-Out-Bytes")], r"^(.+?)-(.+?)-AWS-Out-Bytes$", r"\1 → \2"),
        ([(_USAGE, "like", "%-AWS-In-Bytes")], r"^(.+?)-(.+?)-AWS-In-Bytes$", r"\1 ← \2"),
        ([(_USAGE, "like", "%-DataTransfer-xAZ-%-Bytes")], None, "Same AZ"),
        ([(_USAGE, "like", "%-Hst:Data-Bytes-In")], None, "SageMaker Endpoint ← Any"),
        ([(_USAGE, "like", "%-Hst:Data-Bytes-Out")], None, "SageMaker Endpoint → Any"),
        ([(_OPERATION, "like", "VPCPeering-%")], None, "VPC ← Peering → VPC"),
    ],
    "level": [([(_OPERATION, "=", operation)], None, level) for operation, level in (
        ("StandardStorage", "Standard"),
        ("IntelligentTieringIAStorage", "Intelligent Tiering (Infrequent)"),
        ("IntelligentTieringFAStorage", "Inlteligent Tiering (Frequent)"),
        ("IntelligentTieringAIAStorage", "Intelligent Tiering (Instant Archive)"),
        ("IntelligentTieringAAStorage", "Intelligent Tiering (Archive)"),
        ("IntelligentTieringDAAStorage", "Intelligent Tiering (Deep Archive)"),
        ("DeepArchiveStorage", "Deep Archive"),
        ("DeepArchiveStagingStorage", "Deep Archive - Multipart"),
        ("DeepArchiveS3ObjectOverhead", "Deep Archive - Name Metadata"),
        ("DeepArchiveObjectOverhead", "Deep Archive - Index Metadata"),
        ("ExpressOneZoneStorage", "Express One Zone"))],
    "volume": [
        ([(_USAGE, "like", "%GP2-Storage%")], None, "GP2"),
        ([(_USAGE, "like", "%GP3-Storage%")], None, "GP3"),
        ([("line_item_line_item_description", "like", "%io1%")], None, "IO1"),
        ([("line_item_line_item_description", "like", "%io2%")], None, "IO2"),
    ],
    "elb_use": [([(_USAGE, "like", "%LoadBalancerUsage%")], None, "Usage"), ([(_USAGE, "like", "%LCUUsage%")], None, "LCU")],
    "ebs_use": [([("product_product_family", "=", "Storage Snapshot")], None, "Snapshot")],
    "rds_use": [([("product_product_family", "=", "Database Instance")], None, "Instance"),
                ([("product_product_family", "=", "Database Storage")], None, "Storage")],
    "platform": [([("product_physical_processor", "like", "%Graviton%")], None, "Graviton")],
}


def _found(column: str, pattern: str, group: int) -> str:
    return f"NULLIF(regexp_extract({column}, '{pattern}', {group}), '')"


# What a line without a matching label gets, and texts cut out of
# a column by the model's patterns.
OTHERWISE = {
    "direction": _TRANSFER, "level": _OPERATION, "volume": _found("product_volume_type", "^(.+-)?(.+)$", 2),
    "elb_use": _USAGE, "ebs_use": "'Storage'", "rds_use": "NULL", "platform": "'x86'",
}
CUT = {
    "family": "COALESCE(NULLIF(product_instance_type_family, ''), " + _found("product_instance_type", r"^(.+?)\..+$", 1) + ", 'Unknown')",
    "grand_family": "COALESCE(upper(" + _found("product_instance_type", r"^(.+?)[1-9][0-9]*[a-z]*\..+$", 1) + "), 'Unknown')",
    "cluster": _found("line_item_resource_id", "(j-.+?)$", 1),
    "reserved_type": _found(_USAGE, "^.+?:(.+)$", 1),
    "db_name": _found("line_item_resource_id", "^.+:(.+)$", 1),
    "tier": _found(_USAGE, r".+?-(Tier\d)", 1),
    "lb_name": _found("line_item_resource_id", "^.+:loadbalancer/(.+?)/(.+?)/(.+?)$", 2),
    "lb_type": _found(_OPERATION, "^LoadBalancing:(.+)$", 1),
}

_AMOUNT, _COST, _RESOURCE = "line_item_usage_amount", "line_item_unblended_cost", "line_item_resource_id"
_DAY, _MONTH = "_bb_usage_date", "_bb_usage_year_month"
_RI, _SP = "reservation_reservation_a_r_n", "savings_plan_savings_plan_a_r_n"
# The facets' columns, in the model's order, and where each comes
# from: a bill column, a label, a cut text or a constant.
SOURCES: dict[str, dict[str, str]] = {
    "data_transfer": {"_bb_parent_service": "_bb_service", "_bb_service": "'AWSDataTransfer'", "_bb_dt_gb": _AMOUNT,
                      "_bb_dt_type": _TRANSFER, "bb_dt_dir": "direction"},
    "ebs": {"_bb_parent_service": "_bb_service", "_bb_service": "'AmazonEBS'", "bb_ebs_volume_id": _RESOURCE,
            "bb_ebs_volume_type": "product_volume_api_name", "bb_ebs_gb_month": _AMOUNT, "bb_cost": _COST, "_bb_ebs_usage_type": "ebs_use"},
    "ec2": {"_bb_service": "'AmazonEC2'", "bb_ec2_instance_id": _RESOURCE, "bb_ec2_seconds": f"{_AMOUNT} * 3600",
            "_bb_ec2_instance_type_family": "family", "_bb_ec2_instance_type_grand_family": "grand_family",
            "_bb_ec2_instance_type": "product_instance_type", "bb_ec2_vcpu_seconds": f"TRY_CAST(product_vcpu AS INTEGER) * {_AMOUNT} * 3600",
            "bb_ec2_platform": "platform"},
    "ec2_on_demand": {"bb_ec2_purchase_option": "'On Demand'", "bb_cost_used": _COST},
    "ec2_spot": {"bb_ec2_purchase_option": "'Spot'", "bb_cost_used": _COST},
    "nat_gateway": {"_bb_vpc_usage_type": "'NAT Gateway'", "_bb_ec2_nat_hours": _AMOUNT},
    "ri_paid": {_MONTH: _MONTH, _DAY: _DAY, "_bb_service": "_bb_service", "bb_ri_arn": _RI, "bb_ec2_hours": _AMOUNT,
                "bb_ec2_instance_type_inferred": "reserved_type", "bb_cost": _COST},
    "ri_used": {"bb_ec2_purchase_option": "'Reserved Instance'", "bb_ri_cost_type": "'Used'", "bb_ri_arn": _RI,
                "bb_ri_term_year": "pricing_lease_contract_length", "bb_cost_used": "reservation_effective_cost"},
    "sp_used": {_DAY: _DAY, _MONTH: _MONTH, "bb_usage_type": "'Savings Plans'", "bb_sp_cost_type": "'Used'", "bb_sp_arn": _SP,
                "bb_cost_used": "savings_plan_savings_plan_effective_cost", "bb_sp_term_year": "savings_plan_purchase_term"},
    "sp_negation": {_DAY: _DAY, "bb_sp_arn": _SP, "bb_sp_cost_negation": _COST, "bb_cost": "0", "bb_ec2_seconds": "0"},
    "sp_recurring": {_DAY: _DAY, _MONTH: _MONTH, "bb_sp_arn": _SP, "bb_sp_cost_recur": _COST, "bb_cost": "0"},
    "rds": {"bb_rds_usage_type": "rds_use", "_bb_rds_platform": "platform", "bb_rds_engine": "product_database_engine",
            "bb_rds_azness": "product_deployment_option", "bb_rds_instance_type": "product_instance_type", "bb_rds_instance_arn": _RESOURCE,
            "bb_rds_instance_name": "db_name", "_bb_rds_instance_type_family": "family", "_bb_rds_instance_type_grand_family": "grand_family",
            "rds_instance_seconds": f"if(product_database_engine IS NULL, NULL, {_AMOUNT})", "rds_storage_volume_type": "volume",
            "rds_storage_gb_month": f"if(product_volume_type IS NULL, NULL, {_AMOUNT})"},
    "emr_fee": {"bb_parent_service": "'AmazonEMR'", "bb_emr_cluster_name": "resource_tags_user_name", "bb_emr_cluster_id": "cluster"},
    "emr_other": {"bb_parent_service": "'AmazonEMR'", "bb_emr_cluster_id": "resource_tags_aws_elasticmapreduce_job_flow_id",
                  "bb_emr_instance_role": "resource_tags_aws_elasticmapreduce_instance_group_role"},
    "s3_storage": {"bb_s3_gb_month": _AMOUNT, "bb_s3_bucket": _RESOURCE, "bb_s3_storage_level": "level",
                   "bb_s3_usage_type": "'TimedStorage'", "bb_s3_is_overhead": f"{_OPERATION} LIKE '%SizeOverhead%'"},
    "s3_requests": {"bb_s3_requested_api": _OPERATION, "bb_s3_request_cost_tier": "tier", "bb_s3_num_requests": _AMOUNT,
                    "bb_s3_bucket": _RESOURCE, "bb_s3_usage_type": "'Requests'"},
    "elb": {"bb_elb_name": "lb_name", "bb_elb_hour": _AMOUNT, "bb_elb_usage_type": "elb_use", "bb_elb_type": "lb_type"},
    "marketplace": {"bb_mp_seller": "line_item_legal_entity", "bb_mp_product_name": "product_product_name", "_bb_service": "'AWSMarketplace'"},
}

# Wide columns that several facets compete for, best first ("" is the line itself).
CONTESTS: dict[str, list[tuple[str, str]]] = {
    "bb_cost": [("sp_used", "bb_cost_used"), ("ebs", "bb_cost"), ("ec2_on_demand", "bb_cost_used"), ("ri_used", "bb_cost_used"), ("", _COST)],
    "bb_service": [("data_transfer", "_bb_service"), ("ebs", "_bb_service"), ("ec2", "_bb_service"), ("marketplace", "_bb_service"), ("", "_bb_service")],
    "bb_parent_service": [("emr_fee", "bb_parent_service"), ("emr_other", "bb_parent_service"), ("data_transfer", "_bb_parent_service"),
                          ("ebs", "_bb_parent_service"), ("ec2", "_bb_service"), ("marketplace", "_bb_service"), ("", "_bb_service")],
    "bb_ec2_purchase_option": [("ec2_on_demand", "bb_ec2_purchase_option"), ("ri_used", "bb_ec2_purchase_option"),
                               ("sp_used", "bb_usage_type"), ("ec2_spot", "bb_ec2_purchase_option")],
    "bb_emr_cluster_id": [("emr_other", "bb_emr_cluster_id"), ("emr_fee", "bb_emr_cluster_id")],
    "bb_s3_bucket": [("s3_storage", "bb_s3_bucket"), ("s3_requests", "bb_s3_bucket")],
    "bb_s3_usage_type": [("s3_storage", "bb_s3_usage_type"), ("s3_requests", "bb_s3_usage_type")],
}
# Facet columns that the wide table does not show, or not as the facet's.
HIDDEN = {"_bb_service", "_bb_parent_service", "bb_parent_service", "bb_cost", "bb_cost_used", "bb_usage_type", "bb_elb_hour",
          "bb_s3_requested_api", "bb_emr_cluster_name", "_bb_usage_date", "_bb_usage_year_month", *CONTESTS}
UNSHOWN_FACETS = {"ri_paid", "sp_negation", "sp_recurring"}
REPLACED = ("SavingsPlanNegation", "SavingsPlanRecurringFee", "RIFee")


def _text(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _rule_tables(rds_only: bool) -> str:
    """tests(rule, alternative, column, comparison, text) and labels(rule, label, rank, pattern, text)."""
    tests, labels = [], []
    for facet, alternatives in {**MEMBERS, **({"rds": RDS_ONLY} if rds_only else {})}.items():
        tests += [(facet, n, *t) for n, alternative in enumerate(alternatives) for t in alternative]
    for label, rules in LABELS.items():
        for rank, (wanted, pattern, text) in enumerate(rules):
            tests += [(f"{label} {rank}", 0, *t) for t in wanted]
            labels.append(f"({_text(f'{label} {rank}')}, {_text(label)}, {rank}, {_text(pattern)}, {_text(text)})")
    rows = ",\n  ".join(f"({_text(r)}, {n}, {_text(c)}, {_text(op)}, {_text(x)})" for r, n, c, op, x in tests)
    return (f"tests(rule, alternative, col, op, x) AS (VALUES\n  {rows}),\n"
            "labels(rule, label, place, pattern, x) AS (VALUES\n  " + ",\n  ".join(labels) + ")")


def _guarded(facet: str, column: str) -> str:
    if not facet:
        return column
    return f"CASE WHEN bb_id IS NOT NULL AND list_contains(facets, '{facet}') THEN {SOURCES[facet][column]} END"


def _shown(column: str) -> str:
    return column[1:] if column.startswith("_bb_") else column


def model_ctes(filled: bool = False, rds_only: bool = False, grouped: bool = False, all_names: bool = False) -> str:
    """CTEs over ``cur`` ending in ``wide_raw``; options as in the library."""
    tested = sorted({t[0] for alternatives in MEMBERS.values() for a in alternatives for t in a} | {t[0] for t in RDS_ONLY[0]}
                    | {t[0] for rules in LABELS.values() for wanted, _, _ in rules for t in wanted})
    pairs = ", ".join(f"{{'col': '{c}', 'v': {c}}}" for c in tested)
    everyone = "" if rds_only else "\n  UNION ALL SELECT r, 'rds' FROM lines"
    label_columns = ",\n         ".join(
        f"if(list_contains(map_keys(named), '{n}'), named['{n}'], {default}) AS {n}" for n, default in OTHERWISE.items())
    cut_columns = ",\n         ".join(f"{sql} AS {n}" for n, sql in CUT.items())
    views = ",\n".join(
        f"v_{facet} AS (SELECT bb_id, {', '.join(f'{sql} AS {c}' for c, sql in columns.items())} FROM marked WHERE list_contains(facets, '{facet}'))"
        for facet, columns in SOURCES.items())
    shown = [f"COALESCE({', '.join(_guarded(f, c) for f, c in options)}) AS {n}" for n, options in CONTESTS.items()]
    shown += [f"{_guarded(facet, c)} AS {_shown(c)}" for facet, columns in SOURCES.items() if facet not in UNSHOWN_FACETS
              for c in columns if c not in HIDDEN]
    used = "COALESCE(used.total, 0)" if filled else "used.total"
    fee_group = """
  SELECT kind, MIN(bb_id) AS bb_id, arg_min_null(day, bb_id) AS day, arg_min_null(month, bb_id) AS month, arg_min_null(service, bb_id) AS service,
         arn, period, SUM(cost) AS cost
  FROM fee_lines GROUP BY kind, arn, period""" if grouped else "SELECT * FROM fee_lines"
    cluster_rows = """SELECT DISTINCT r, bb_emr_cluster_name AS dim_name, id AS dim_id FROM candidates JOIN d_emr_names ON id = bb_emr_cluster_id""" if all_names else """
  SELECT r, arg_min(bb_emr_cluster_name, (place, bb_emr_cluster_name)) AS dim_name, arg_min(id, (place, bb_emr_cluster_name)) AS dim_id
  FROM candidates JOIN d_emr_names ON id = bb_emr_cluster_id GROUP BY r"""
    return rf"""
bb_cur AS (SELECT * FROM cur WHERE bill_invoice_id <> ''),
costs AS (
  SELECT *, CAST(line_item_usage_start_date AS VARCHAR) || identity_line_item_id AS bb_id,
         CAST(line_item_usage_start_date AS DATE) AS _bb_usage_date, strftime(line_item_usage_start_date, '%Y-%m') AS _bb_usage_year_month,
         line_item_product_code AS _bb_service, line_item_unblended_cost AS bb_cost_no_tax, line_item_line_item_description AS bb_cost_desc,
         line_item_usage_account_id AS bb_account_id, product_region AS bb_region, product_region_code AS bb_region_code,
         line_item_line_item_type = 'Tax' AS bb_is_tax, line_item_line_item_type = 'Credit' AS bb_is_credit
  FROM bb_cur),
lines AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM costs),
{_rule_tables(rds_only)},
facts AS (SELECT r, f.col, f.v FROM (SELECT r, unnest([{pairs}]) AS f FROM lines)),
passed AS MATERIALIZED (
  SELECT r, rule, alternative
  FROM facts JOIN tests USING (col)
  WHERE CASE op WHEN '=' THEN v = x WHEN '<>' THEN v <> x WHEN 'like' THEN v LIKE x WHEN 'unlike' THEN v NOT LIKE x ELSE regexp_matches(v, x) END
  GROUP BY r, rule, alternative
  HAVING COUNT(*) = (SELECT COUNT(*) FROM tests n WHERE n.rule = tests.rule AND n.alternative = tests.alternative)),
members AS (
  SELECT r, list(DISTINCT rule) AS facets
  FROM (SELECT r, rule FROM passed WHERE rule NOT IN (SELECT rule FROM labels){everyone})
  GROUP BY r),
named AS (
  SELECT r, map_from_entries(list({{'k': label, 'v': v}})) AS named
  FROM (SELECT r, label, arg_min_null(if(pattern IS NULL, x, regexp_replace(line_item_usage_type, pattern, x)), place) AS v
        FROM passed JOIN labels USING (rule) JOIN lines USING (r) GROUP BY r, label)
  GROUP BY r),
marked AS MATERIALIZED (
  SELECT lines.*, COALESCE(facets, []) AS facets,
         {label_columns},
         {cut_columns}
  FROM lines LEFT JOIN members USING (r) LEFT JOIN named USING (r)),
{views},
d_emr_names AS (SELECT DISTINCT bb_emr_cluster_name, bb_emr_cluster_id FROM v_emr_fee WHERE bb_emr_cluster_name <> ''),
candidates AS (
  SELECT r, 1 AS place, {SOURCES['emr_other']['bb_emr_cluster_id']} AS id FROM marked WHERE bb_id IS NOT NULL AND list_contains(facets, 'emr_other')
  UNION ALL SELECT r, 2, cluster FROM marked WHERE bb_id IS NOT NULL AND list_contains(facets, 'emr_fee')),
clusters AS (
  {cluster_rows}),
fee_lines AS (
  SELECT 'ri' AS kind, bb_id, _bb_usage_date AS day, _bb_usage_year_month AS month, _bb_service AS service, {_RI} AS arn,
         _bb_usage_year_month AS period, {_COST} AS cost
  FROM marked WHERE list_contains(facets, 'ri_paid')
  UNION ALL
  SELECT 'sp', bb_id, _bb_usage_date, _bb_usage_year_month, 'ComputeSavingsPlans', {_SP}, CAST(_bb_usage_date AS VARCHAR), {_COST}
  FROM marked WHERE list_contains(facets, 'sp_recurring')),
fees AS ({fee_group}),
used AS (
  SELECT if(list_contains(facets, 'ri_used'), 'ri', 'sp') AS kind, if(list_contains(facets, 'ri_used'), {_RI}, {_SP}) AS arn, _bb_usage_year_month AS month,
         if(list_contains(facets, 'ri_used'), NULL, _bb_usage_date) AS day,
         if(list_contains(facets, 'ri_used'), _bb_usage_year_month, CAST(_bb_usage_date AS VARCHAR)) AS period,
         SUM(if(list_contains(facets, 'ri_used'), reservation_effective_cost, savings_plan_savings_plan_effective_cost)) AS total
  FROM marked WHERE list_has_any(facets, ['ri_used', 'sp_used']) GROUP BY ALL),
c_ri_monthly_used AS (SELECT month AS _bb_usage_year_month, arn AS bb_ri_arn, total AS bb_cost_used FROM used WHERE kind = 'ri'),
c_sp_daily_used AS (SELECT arn AS bb_sp_arn, month AS _bb_usage_year_month, day AS _bb_usage_date, total AS bb_sp_daily_cost FROM used WHERE kind = 'sp'),
unused AS (
  SELECT fees.kind, bb_id || if(fees.kind = 'ri', 'UNUSEDRI', 'UNUSEDSP') AS bb_id, fees.day, fees.month, service, fees.arn,
         CAST(if(fees.kind = 'ri', CAST(ROUND(cost - COALESCE(used.total, 0), 2) AS DECIMAL(38,6)), CAST(ROUND(cost - {used}, 4) AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS cost
  FROM fees LEFT JOIN used ON used.kind = fees.kind AND used.arn = fees.arn AND used.period = fees.period),
c_ri_unused AS (
  SELECT bb_id, month AS _bb_usage_year_month, day AS _bb_usage_date, service AS _bb_service, arn AS bb_ri_arn, 'Unused' AS bb_ri_cost_type, cost AS bb_cost
  FROM unused WHERE kind = 'ri'),
c_sp_unused AS (
  SELECT bb_id, month AS _bb_usage_year_month, day AS _bb_usage_date, service AS _bb_service, arn AS bb_sp_arn, 'Unused' AS bb_sp_cost_type, cost AS bb_sp_cost_unused
  FROM unused WHERE kind = 'sp'),
wide_lines AS (
  SELECT bb_id, {(',' + chr(10) + '         ').join(shown)},
         COALESCE(dim_name, {_guarded('emr_fee', 'bb_emr_cluster_name')}, dim_id, {_guarded('emr_fee', 'bb_emr_cluster_id')}) AS bb_emr_cluster_name,
         _bb_usage_date AS bb_usage_date, _bb_usage_year_month AS bb_usage_year_month, r
  FROM marked LEFT JOIN clusters USING (r)
  WHERE line_item_line_item_type IS NULL OR line_item_line_item_type NOT IN {REPLACED}),
wide_raw AS (
  SELECT * EXCLUDE (r) FROM wide_lines JOIN (SELECT * EXCLUDE (bb_id) FROM lines) passed_through USING (r)
  UNION ALL BY NAME
  SELECT bb_id, cost AS bb_cost, service AS bb_service, service AS bb_parent_service, day AS bb_usage_date, month AS bb_usage_year_month,
         if(kind = 'ri', 'Unused', NULL) AS bb_ri_cost_type, if(kind = 'sp', 'Unused', NULL) AS bb_sp_cost_type,
         if(kind = 'sp', arn, NULL) AS bb_sp_arn, if(kind = 'sp', cost, NULL) AS bb_sp_cost_unused
  FROM unused)
"""
