"""Serving queries and key figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import core as O
from projectmart.operators.joins import join_on
from projectmart.plans import serve
from registry import scalar  # noqa: F401  (the fixed predictions in SQL)
from registry.base import Tables, query


@query(
    "qs_1_cost_trend",
    f"SELECT period_year_month, project_type, {O.msum('total_budget_eur')} AS budget,"
    f" {O.msum('total_actual_eur')} AS actual, {O.msum('total_variance_eur')} AS variance"
    f" FROM g_cost_variance_monthly WHERE period_year_month IS NOT NULL GROUP BY 1, 2 ORDER BY 1",
)
def _(t: Tables):
    return serve.cost_trend(t.gold)


@query(
    "qs_2_schedule_overview",
    "SELECT project_name, takt_zone, completion_rate_pct, delay_rate_pct, avg_delay_days, status"
    " FROM g_schedule_kpi WHERE project_name IS NOT NULL ORDER BY completion_rate_pct ASC NULLS FIRST,"
    " project_id ASC NULLS FIRST, takt_zone ASC NULLS FIRST LIMIT 50",
)
def _(t: Tables):
    return serve.schedule_overview(t.gold)


@query(
    "qs_3_vendor_leaderboard",
    "SELECT vendor_name, vendor_type, trade_category, avg_overall_score, rehire_rate_pct,"
    " evaluation_count, total_invoices, disputed_invoices FROM g_vendor_scorecard"
    " WHERE vendor_name IS NOT NULL AND avg_overall_score IS NOT NULL"
    " ORDER BY avg_overall_score DESC, vendor_id LIMIT 30",
)
def _(t: Tables):
    return serve.vendor_leaderboard(t.gold)


@query(
    "qs_4_aging_distribution",
    f"SELECT aging_bucket, payment_status, CAST(sum(invoice_count) AS BIGINT) AS invoices,"
    f" {O.msum('total_amount_eur')} AS amount_eur FROM g_invoice_aging GROUP BY 1, 2 ORDER BY 1",
)
def _(t: Tables):
    return serve.aging_distribution(t.gold)


@query(
    "qs_5_project_health",
    "SELECT project_name, project_type, municipality, status, budget_utilization_pct,"
    " milestone_completion_pct, avg_delay_days, risk_score, risk_level FROM g_project_summary"
    " WHERE project_name IS NOT NULL ORDER BY risk_score DESC NULLS LAST, project_id LIMIT 50",
)
def _(t: Tables):
    return serve.project_health(t.gold)


@query(
    "qs_6_risk_predictions",
    "SELECT s.project_id, p.project_name, p.project_type, s.overrun_probability, s.risk_level"
    " FROM p_scores s JOIN s_dim_projects p ON s.project_id = p.project_id"
    " WHERE s.risk_level = 'high' ORDER BY overrun_probability DESC, s.project_id LIMIT 20",
)
def _(t: Tables):
    return serve.risk_predictions(t.fixed_scores, t.silver["dim_projects"])


@query(
    "jn_8_scores_to_dimension",
    "SELECT s.project_id, s.risk_level, p.project_name FROM p_scores s"
    " JOIN s_dim_projects p ON s.project_id = p.project_id",
)
def _(t: Tables):
    scores = t.fixed_scores.select("project_id", "risk_level")
    names = t.silver["dim_projects"].select(F.col("project_id").alias("known_id"), "project_name")
    return join_on(scores, names, "project_id", "known_id").drop("known_id")


@query(
    "qs_7_employee_purchasing",
    "SELECT * EXCLUDE (employee_id) FROM g_employee_purchase_summary WHERE full_name IS NOT NULL"
    " ORDER BY total_po_value_eur DESC NULLS LAST, employee_id LIMIT 30",
)
def _(t: Tables):
    return serve.employee_purchasing(t.gold)


@query(
    "qs_8_cost_kpis",
    f"SELECT {O.msum('total_budget_eur')} AS total_budget, {O.msum('total_actual_eur')} AS total_actual,"
    f" {O.msum('total_variance_eur')} AS total_variance,"
    f" {O.mean('budget_utilization_pct')} AS avg_utilization,"
    f" count(*) FILTER (WHERE is_over_budget) AS overrun_lines, count(*) AS total_lines"
    f" FROM g_cost_variance_monthly",
)
def _(t: Tables):
    return serve.cost_kpis(t.gold)


@query(
    "qs_9_schedule_kpis",
    f"SELECT {O.mean('completion_rate_pct')} AS avg_completion_rate,"
    f" {O.mean('delay_rate_pct')} AS avg_delay_rate, {O.mean('avg_delay_days')} AS avg_delay_days,"
    f" CAST(sum(total_milestones) AS BIGINT) AS total_milestones,"
    f" CAST(sum(completed_milestones) AS BIGINT) AS completed_milestones,"
    f" CAST(sum(delayed_milestones) AS BIGINT) AS delayed_milestones FROM g_schedule_kpi",
)
def _(t: Tables):
    return serve.schedule_kpis(t.gold)


@query(
    "qs_10_vendor_kpis",
    f"SELECT count(*) AS total_vendors, {O.mean('avg_overall_score')} AS avg_vendor_score,"
    f" CAST(sum(total_invoices) AS BIGINT) AS total_invoices_reviewed,"
    f" CAST(sum(disputed_invoices) AS BIGINT) AS total_disputed,"
    f" {O.mean('rehire_rate_pct')} AS avg_rehire_rate FROM g_vendor_scorecard",
)
def _(t: Tables):
    return serve.vendor_kpis(t.gold)


_old = "CASE WHEN aging_bucket = '90+ days' THEN total_amount_eur END"


@query(
    "qs_11_invoice_kpis",
    f"SELECT CAST(sum(invoice_count) AS BIGINT) AS total_invoices,"
    f" {O.msum('total_amount_eur')} AS total_invoice_value,"
    f" {O.mean('avg_days_overdue')} AS avg_days_overdue,"
    f" CAST(sum(invoice_count) FILTER (WHERE aging_bucket = '90+ days') AS BIGINT) AS count_90plus,"
    f" {O.msum(_old)} AS amount_90plus FROM g_invoice_aging",
)
def _(t: Tables):
    return serve.invoice_kpis(t.gold)


@query(
    "qs_12_risk_kpis",
    f"SELECT *, {O.pct('high_risk', 'total_scored', 1)} AS high_risk_pct FROM ("
    f"SELECT count(*) FILTER (WHERE risk_level = 'high') AS high_risk,"
    f" count(*) FILTER (WHERE risk_level = 'medium') AS medium_risk,"
    f" count(*) FILTER (WHERE risk_level = 'low') AS low_risk, count(*) AS total_scored"
    f" FROM p_scores)",
)
def _(t: Tables):
    return serve.risk_kpis(t.fixed_scores)


@query(
    "qs_13_portfolio_kpis",
    f"SELECT count(*) AS total_projects, {O.mean('budget_utilization_pct')} AS avg_budget_util,"
    f" {O.mean('milestone_completion_pct')} AS avg_milestone_pct,"
    f" count(*) FILTER (WHERE risk_level = 'low') AS low_risk,"
    f" count(*) FILTER (WHERE risk_level = 'medium') AS medium_risk,"
    f" count(*) FILTER (WHERE risk_level = 'high') AS high_risk FROM g_project_summary",
)
def _(t: Tables):
    return serve.portfolio_kpis(t.gold)


@query(
    "qs_14_over_budget_projects",
    "SELECT project_id, project_name, budget_utilization_pct, total_variance_eur"
    " FROM g_project_summary WHERE budget_utilization_pct > 100",
)
def _(t: Tables):
    return serve.over_budget_projects(t.gold)


@query(
    "qs_15_vendors_below",
    "SELECT vendor_id, vendor_name, vendor_type, avg_safety_score AS score FROM g_vendor_scorecard"
    " WHERE avg_safety_score < 5.5",
)
def _(t: Tables):
    return serve.vendors_below(t.gold, "avg_safety_score", 5.5)


@query(
    "qs_16_average_delay",
    f"SELECT p.project_type, count(*) AS complete_milestones,"
    f" {O.half_up(O.avg('m.delay_days'), 2)} AS avg_delay_days"
    f" FROM s_fact_schedule_milestones m JOIN s_dim_projects p ON m.project_id = p.project_id"
    f" WHERE m.delay_days IS NOT NULL GROUP BY 1",
)
def _(t: Tables):
    return serve.average_delay(t.silver)
