"""A5: publish the model's named views, for a session or for good.

BI and ad-hoc SQL keep using the table and view names of the original model
(``SELECT ... FROM bb_bwt_costs``). ``publish_views`` registers the lazily composed
DataFrames of this library as temp views, planned by Catalyst like the DataFrame
calls. ``publish_tables`` creates lasting views in the catalog: their SQL text is
rendered from the same declarations (every facet's predicate and columns, as
Catalyst spells them), over the bill's catalog table and the written wide table,
so that no data but that table is written. The four checks that the original
script only printed (by service, SP, RI) are published under descriptive names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..model import CostModel
from ..operators import commitments, facets
from ..operators.base import keyed
from ..sources.cur import conform, finalised
from ..sources.sink import replace_view, write_wide_table
from .quality import EXCLUDED_BY_SERVICE, KEYS

WIDE_VIEW = "bb_bwt_costs"
#: Catalog table of the export's files.
SOURCE_TABLE = "bb_cur_source"

# The view names of the original model, with the facet each
# one shows.
FACET_VIEWS: dict[str, str] = {
    "bb_dwd_data_transfer_costs": "data_transfer",
    "bb_dwd_amazonebs_costs": "ebs",
    "bb_dwd_amazonec2_costs": "ec2",
    "bb_dwd_amazonec2_od_costs": "ec2_on_demand",
    "bb_dwd_amazonec2_spot_costs": "ec2_spot",
    "bb_dwd_ec2_nat_costs": "nat_gateway",
    "bb_dwd_ri_paid_costs": "ri_paid",
    "bb_dwd_ri_costs": "ri_used",
    "bb_dwd_sp_costs": "sp_used",
    "bb_dwd_sp_negation_costs": "sp_negation",
    "bb_dwd_sp_recur_costs": "sp_recurring",
    "bb_dwd_rds_costs": "rds",
    "bb_dwd_amazonemr_fee_costs": "emr_fee",
    "bb_dwd_amazonemr_other_costs": "emr_other",
    "bb_dwd_amazons3_storage_level": "s3_storage",
    "bb_dwd_amazons3_costs_requests": "s3_requests",
    "bb_dwd_awselb_costs": "elb",
    "bb_dwd_aws_marketplace_costs": "marketplace",
}


def model_views(model: CostModel) -> dict[str, DataFrame]:
    views: dict[str, DataFrame] = {
        "bb_cur_table": model.finalised,
        "bb_dwd_costs": model.base,
    }
    views.update({view: model.facet(name) for view, name in FACET_VIEWS.items()})
    views.update({
        "bb_dwd_ri_unused_costs": model.ri_unused,
        "bb_dwd_sp_unused_costs": model.sp_unused(),
        "bb_dim_amazonemr_cluster_names": model.emr_cluster_names(),
        "bb_bwt_costs": model.wide,
        "bb_rpt_ec2_hourly_usage": model.ec2_hourly_usage(),
        "bb_bwt_costs_total_q": model.qc_total(),
        "bb_qc_by_service": model.qc_by_service(),
        "bb_qc_savings_plans": model.qc_savings_plans(),
        "bb_qc_reserved": model.qc_reserved(),
    })
    return views


def publish_views(model: CostModel) -> list[str]:
    """Register every view of the model as a temp view; returns the names."""
    views = model_views(model)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


# --- lasting views ----------------------------------------------------------------


def spelled(df: DataFrame, columns: dict[str, Column] | None = None) -> dict[str, str]:
    """SQL text of columns over ``df``, or of the projection that ``df`` ends in,
    as Catalyst spells the analysed expressions."""
    if columns is not None:
        df = df.select(*[c.alias(n) for n, c in columns.items()])
    found = df._jdf.queryExecution().analyzed().expressions()
    out = {}
    for i in range(found.size()):
        e = found.apply(i)
        out[e.name()] = (e.child() if e.getClass().getSimpleName() == "Alias" else e).sql()
    return out


def _select(columns: dict[str, str], source: str, where: str | None = None) -> str:
    listed = ",\n  ".join(f"{sql} AS `{name}`" for name, sql in columns.items())
    return f"SELECT {listed}\nFROM {source}" + (f"\nWHERE {where}" if where else "")


def _unused(kind: str, costs: str, columns: str, fill_unused: bool, fee_grain: str) -> str:
    """C2 and C4 in SQL (``commitments.unused``)."""
    fee, usage, arn, cost, digits, suffix, service = commitments.KINDS[kind]
    period = "_bb_usage_year_month" if kind == "ri" else "_bb_usage_date"
    fees = (f"SELECT bb_id, _bb_usage_date AS day, _bb_usage_year_month AS month, {'_bb_service' if service is None else repr(service)} AS service, "
            f"{arn} AS arn, {period} AS period, line_item_unblended_cost AS fee FROM {costs} WHERE line_item_line_item_type = '{fee}'")
    if fee_grain == "group":
        fees = ("SELECT MIN(bb_id) AS bb_id, MIN_BY(day, bb_id) AS day, MIN_BY(month, bb_id) AS month, MIN_BY(service, bb_id) AS service, "
                f"arn, period, SUM(fee) AS fee FROM ({fees}) GROUP BY arn, period")
    used = "COALESCE(used, 0)" if kind == "ri" or fill_unused else "used"
    return (f"SELECT {columns.format(id=f'CONCAT(bb_id, {suffix!r})', cost=f'ROUND(fee - {used}, {digits})')}\n"
            f"FROM ({fees}) fees\nLEFT JOIN (SELECT {arn} AS arn, {period} AS period, SUM({cost}) AS used FROM {costs} "
            f"WHERE line_item_line_item_type = '{usage}' GROUP BY 1, 2) totals USING (arn, period)")


def view_statements(spark: SparkSession, source: DataFrame, named: dict[str, str], fill_unused: bool = False, fee_grain: str = "row",
                    rds_only: bool = False) -> dict[str, str]:
    """SELECT statements of all views but the wide table, in an order in which
    each refers to those before it. ``named`` has the catalog names of the views,
    of the bill's table and of the wide table."""
    empty = lambda schema: spark.createDataFrame([], schema)
    bill = empty(source.schema)
    conformed = empty(conform(bill).schema)
    base = empty(keyed(conformed).schema)
    cur, costs, wide = named["bb_cur_table"], named["bb_dwd_costs"], named[WIDE_VIEW]
    out = {
        "bb_cur_table": f"SELECT * FROM ({_select(spelled(conform(bill)), named[SOURCE_TABLE])})\nWHERE {_condition(finalised(conformed))}",
        "bb_dwd_costs": _select(spelled(keyed(conformed)), cur),
    }
    for view, name in FACET_VIEWS.items():
        facet = facets.rds(rds_only) if name == "rds" else facets.FACETS[name]()
        where = None if facet.predicate is None else _condition(base.where(facet.predicate))
        out[view] = _select({"bb_id": "bb_id"} | spelled(base, facet.columns), costs, where)
    out["bb_dwd_ri_unused_costs"] = _unused(
        "ri", costs, "{id} AS bb_id, month AS _bb_usage_year_month, day AS _bb_usage_date, service AS _bb_service, arn AS bb_ri_arn, "
        "'Unused' AS bb_ri_cost_type, {cost} AS bb_cost", fill_unused, fee_grain)
    out["bb_dwd_sp_unused_costs"] = _unused(
        "sp", costs, "{id} AS bb_id, month AS _bb_usage_year_month, day AS _bb_usage_date, arn AS bb_sp_arn, service AS _bb_service, "
        "'Unused' AS bb_sp_cost_type, {cost} AS bb_sp_cost_unused", fill_unused, fee_grain)
    out["bb_dim_amazonemr_cluster_names"] = (
        f"SELECT DISTINCT bb_emr_cluster_name, bb_emr_cluster_id FROM {named['bb_dwd_amazonemr_fee_costs']} WHERE bb_emr_cluster_name <> ''")
    out["bb_rpt_ec2_hourly_usage"] = f"""
SELECT started + make_dt_interval(0, i, 0, 0) AS hour, LEAST(1, amount - i) AS usage, bb_ec2_purchase_option
FROM (SELECT line_item_usage_start_date AS started, line_item_usage_amount AS amount, bb_ec2_purchase_option,
             EXPLODE(SEQUENCE(0, CAST(EXTRACT(DAY FROM span) * 24 + EXTRACT(HOUR FROM span) AS INT) - 1)) AS i
      FROM (SELECT *, line_item_usage_end_date - line_item_usage_start_date AS span FROM {wide}
            WHERE bb_service = 'AmazonEC2' AND bb_ec2_purchase_option IS NOT NULL))
WHERE amount - i > 0"""
    out["bb_bwt_costs_total_q"] = f"""
SELECT bb_bwt_cost_total, cur_unblended_total, bb_bwt_cost_total - cur_unblended_total AS diff
FROM (SELECT SUM(bb_cost) AS bb_bwt_cost_total FROM {wide}), (SELECT SUM(line_item_unblended_cost) AS cur_unblended_total FROM {cur})"""
    keys = ", ".join(KEYS)
    out["bb_qc_by_service"] = f"""
SELECT _bb_service, {keys}, a_total, b_total, ROUND(a_total - b_total, 2) AS diff
FROM (SELECT _bb_service, {keys}, SUM(bb_cost) AS a_total FROM {wide} GROUP BY ALL)
JOIN (SELECT line_item_product_code AS _bb_service, {keys}, SUM(line_item_unblended_cost) AS b_total FROM {cur} GROUP BY ALL) USING (_bb_service, {keys})
WHERE line_item_line_item_type NOT IN {EXCLUDED_BY_SERVICE} AND ROUND(a_total - b_total, 2) <> 0"""
    out["bb_qc_savings_plans"] = f"""
SELECT a_total, b_total, ROUND(a_total - b_total, 2) AS diff
FROM (SELECT SUM(line_item_unblended_cost) AS a_total FROM {cur} WHERE line_item_line_item_type = 'SavingsPlanRecurringFee'),
     (SELECT SUM(bb_cost) AS b_total FROM {wide} WHERE bb_sp_cost_type IS NOT NULL)"""
    out["bb_qc_reserved"] = f"""
SELECT bb_usage_year_month, a_total, b_total, ROUND(a_total - b_total, 2) AS diff
FROM (SELECT _bb_usage_year_month AS a_month, SUM(line_item_unblended_cost) AS a_total FROM {costs} WHERE line_item_line_item_type = 'RIFee' GROUP BY 1)
FULL JOIN (SELECT bb_usage_year_month, SUM(bb_cost) AS b_total FROM {wide} WHERE bb_ri_cost_type IS NOT NULL GROUP BY 1) ON a_month = bb_usage_year_month"""
    return out


def _condition(filtered: DataFrame) -> str:
    return filtered._jdf.queryExecution().analyzed().condition().sql()


def publish_tables(model: CostModel, path: str, database: str | None = None, cur: str | None = None) -> list[str]:
    """Write the wide table under ``path`` and create every view of the model in
    the catalog, where other sessions find them. ``cur`` is the folder of the
    export, or the name of its catalog table; a bill that is neither is written as
    the table ``bb_cur_source`` first. The wide table's name is switched by later
    refreshes (``sources.sink``), and the other views follow."""
    spark = model.bill.sparkSession
    prefix = f"`{database}`." if database else ""
    named = {v: f"{prefix}`{v}`" for v in (SOURCE_TABLE, WIDE_VIEW, *model_views(model))}
    made = [SOURCE_TABLE]
    if cur is None:
        model.bill.write.mode("overwrite").option("path", f"{path}/{SOURCE_TABLE}").saveAsTable(named[SOURCE_TABLE])
    elif "/" not in cur:
        named[SOURCE_TABLE], made = cur, []
    else:
        place = cur.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {named[SOURCE_TABLE]}")
        spark.sql(f"CREATE TABLE {named[SOURCE_TABLE]} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{place}'")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{SOURCE_TABLE}" if database else SOURCE_TABLE)):
            spark.catalog.recoverPartitions(f"{database}.{SOURCE_TABLE}" if database else SOURCE_TABLE)
    write_wide_table(model.wide, f"{path}/{WIDE_VIEW}", table=f"{database}.{WIDE_VIEW}" if database else WIDE_VIEW)
    statements = view_statements(spark, spark.table(named[SOURCE_TABLE]), named, model.fill_unused, model.fee_grain, model.rds_only)
    for view, sql in statements.items():
        replace_view(spark, f"{database}.{view}" if database else view, sql)
    return [f"{database}.{v}" if database else v for v in (*made, WIDE_VIEW, *statements)]
