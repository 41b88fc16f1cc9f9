"""The wide table as DuckDB would be asked for it by hand: guarded columns in one
pass, from the rule tables of the oracle. For timing only (``bench.py``); the oracle
evaluates the same rules another way, to be independent."""

from __future__ import annotations

from billmodel.plans import oracle_model as m


def _text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _test(column: str, op: str, x: str) -> str:
    forms = {"like": "{c} LIKE {x}", "unlike": "{c} NOT LIKE {x}", "regex": "regexp_matches({c}, {x})"}
    return forms.get(op, "{c} " + op + " {x}").format(c=column, x=_text(x))


def _every(tests: list[tuple[str, str, str]]) -> str:
    return " AND ".join(_test(*t) for t in tests) or "true"


def _label(name: str) -> str:
    cases = " ".join(f"WHEN {_every(tests)} THEN " + (_text(x) if pattern is None else f"regexp_replace(line_item_usage_type, '{pattern}', {_text(x)})")
                     for tests, pattern, x in m.LABELS[name])
    return f"CASE {cases} ELSE {m.OTHERWISE[name]} END"


def _column(facet: str, column: str) -> str:
    return column if not facet else f"CASE WHEN is_{facet} THEN {m.SOURCES[facet][column]} END"


def projection(cur: str) -> str:
    """The wide table over the relation ``cur``."""
    members = ",\n  ".join(f"bb_id IS NOT NULL AND ({' OR '.join(f'({_every(a)})' for a in alternatives)}) AS is_{f}" for f, alternatives in m.MEMBERS.items())
    derived = ",\n  ".join([f"{_label(n)} AS {n}" for n in m.LABELS] + [f"{sql} AS {n}" for n, sql in m.CUT.items()])
    shown = [f"COALESCE({', '.join(_column(f, c) for f, c in options)}) AS {n}" for n, options in m.CONTESTS.items()]
    shown += [f"{_column(f, c)} AS {m._shown(c)}" for f, columns in m.SOURCES.items() if f not in m.UNSHOWN_FACETS for c in columns if c not in m.HIDDEN]
    ri, sp = "reservation_reservation_a_r_n", "savings_plan_savings_plan_a_r_n"

    def unused(fee: str, usage: str, arn: str, cost: str, period: str, used: str, digits: int, suffix: str, service: str, kind: str) -> str:
        arn_column = f", arn AS bb_sp_arn, CAST(ROUND(fee - {used}, {digits}) AS DECIMAL(38,6)) AS bb_sp_cost_unused" if kind == "sp" else ""
        return (f"SELECT bb_id || '{suffix}' AS bb_id, CAST(ROUND(fee - {used}, {digits}) AS DECIMAL(38,6)) AS bb_cost, {service} AS bb_service, {service} AS bb_parent_service, "
                f"_bb_usage_date AS bb_usage_date, _bb_usage_year_month AS bb_usage_year_month, 'Unused' AS bb_{kind}_cost_type{arn_column}\n"
                f"FROM (SELECT *, {arn} AS arn, {period} AS period, line_item_unblended_cost AS fee FROM costs WHERE line_item_line_item_type = '{fee}') f\n"
                f"LEFT JOIN (SELECT {arn} AS arn, {period} AS period, SUM({cost}) AS used FROM costs WHERE line_item_line_item_type = '{usage}' GROUP BY 1, 2) u USING (arn, period)")

    return f"""
WITH costs AS (
  SELECT *, CAST(line_item_usage_start_date AS VARCHAR) || identity_line_item_id AS bb_id, CAST(line_item_usage_start_date AS DATE) AS _bb_usage_date,
         strftime(line_item_usage_start_date, '%Y-%m') AS _bb_usage_year_month, line_item_product_code AS _bb_service,
         line_item_unblended_cost AS bb_cost_no_tax, line_item_line_item_description AS bb_cost_desc, line_item_usage_account_id AS bb_account_id,
         product_region AS bb_region, product_region_code AS bb_region_code, line_item_line_item_type = 'Tax' AS bb_is_tax,
         line_item_line_item_type = 'Credit' AS bb_is_credit
  FROM {cur} WHERE bill_invoice_id <> ''),
marked AS (SELECT *, {members},
  {derived} FROM costs),
names AS (
  SELECT cluster AS id, MIN(resource_tags_user_name) AS name FROM marked
  WHERE line_item_product_code = 'ElasticMapReduce' AND resource_tags_user_name <> '' AND cluster IS NOT NULL GROUP BY 1)
SELECT bb_id, {(',' + chr(10) + '  ').join(shown)},
  COALESCE(t.name, f.name, {_column('emr_fee', 'bb_emr_cluster_name')}, t.id, f.id, {_column('emr_fee', 'bb_emr_cluster_id')}) AS bb_emr_cluster_name,
  _bb_usage_date AS bb_usage_date, _bb_usage_year_month AS bb_usage_year_month, marked.* EXCLUDE (bb_id, {', '.join([f'is_{f}' for f in m.MEMBERS] + [*m.LABELS, *m.CUT])})
FROM marked LEFT JOIN names t ON is_emr_other AND resource_tags_aws_elasticmapreduce_job_flow_id = t.id LEFT JOIN names f ON is_emr_fee AND cluster = f.id
WHERE line_item_line_item_type IS NULL OR line_item_line_item_type NOT IN {m.REPLACED}
UNION ALL BY NAME
{unused('RIFee', 'DiscountedUsage', ri, 'reservation_effective_cost', '_bb_usage_year_month', 'COALESCE(used, 0)', 2, 'UNUSEDRI', '_bb_service', 'ri')}
UNION ALL BY NAME
{unused('SavingsPlanRecurringFee', 'SavingsPlanCoveredUsage', sp, 'savings_plan_savings_plan_effective_cost', '_bb_usage_date', 'used', 4, 'UNUSEDSP', "'ComputeSavingsPlans'", 'sp')}"""
