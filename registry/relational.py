"""Joins, aggregates, order and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import core as O
from projectmart.functions.values import aging_bucket
from projectmart.operators import aggregates as A
from projectmart.operators.joins import enrich, enrich_hot, join_on, orphan_rate, orphans, star
from projectmart.operators.topk import top_k
from projectmart.plans.silver import key_report
from registry.base import Tables, query
from registry.layers import key_report_sql


@query(
    "jn_1_enrich_aggregate",
    f"SELECT o.*, v.vendor_name, v.trade_category FROM (SELECT vendor_id, po_status,"
    f" count(*) AS orders, {O.msum('po_value_eur')} AS value FROM s_fact_purchase_orders"
    f" GROUP BY 1, 2) o LEFT JOIN s_dim_vendors v ON o.vendor_id = v.vendor_id",
)
def _(t: Tables):
    orders = t.silver["fact_purchase_orders"].groupBy("vendor_id", "po_status").agg(
        F.count("*").alias("orders"), A.money_sum(F.col("po_value_eur")).alias("value")
    )
    return enrich(orders, t.silver["dim_vendors"], "vendor_id", ("vendor_name", "trade_category"))


@query(
    "jn_2_enrich_before_grouping",
    "SELECT p.municipality, m.milestone_status, count(*) AS n FROM s_fact_schedule_milestones m"
    " LEFT JOIN s_dim_projects p ON m.project_id = p.project_id GROUP BY 1, 2",
)
def _(t: Tables):
    joined = enrich_hot(
        t.silver["fact_schedule_milestones"], t.silver["dim_projects"], "project_id",
        ("municipality",),
    )
    return joined.groupBy("municipality", "milestone_status").agg(F.count("*").alias("n"))


@query(
    "jn_3_keep_entities",
    "SELECT p.project_id, count(o.po_id) AS orders FROM s_dim_projects p"
    " LEFT JOIN s_fact_purchase_orders o ON p.project_id = o.project_id GROUP BY 1",
)
def _(t: Tables):
    orders = t.silver["fact_purchase_orders"].groupBy("project_id").agg(
        F.count("po_id").alias("orders")
    )
    joined = t.silver["dim_projects"].select("project_id").join(orders, "project_id", "left")
    return joined.fillna(0, subset=["orders"])


@query(
    "jn_4_star",
    "SELECT p.project_id, c.* EXCLUDE (project_id), m.* EXCLUDE (project_id),"
    " o.* EXCLUDE (project_id) FROM s_dim_projects p"
    " LEFT JOIN (SELECT project_id, count(*) AS lines FROM s_fact_project_costs GROUP BY 1) c"
    " ON p.project_id = c.project_id LEFT JOIN (SELECT project_id, count(*) AS milestones"
    " FROM s_fact_schedule_milestones GROUP BY 1) m ON p.project_id = m.project_id"
    " LEFT JOIN (SELECT project_id, count(*) AS orders FROM s_fact_purchase_orders GROUP BY 1) o"
    " ON p.project_id = o.project_id",
)
def _(t: Tables):
    facts = {
        "lines": "fact_project_costs",
        "milestones": "fact_schedule_milestones",
        "orders": "fact_purchase_orders",
    }
    parts = [
        (t.silver[fact].groupBy("project_id").agg(F.count("*").alias(name)), "project_id", "left")
        for name, fact in facts.items()
    ]
    return star(t.silver["dim_projects"].select("project_id"), parts)


@query(
    "jn_5_join_on",
    "SELECT p.project_id, p.project_name, e.employee_id, e.full_name FROM s_dim_projects p"
    " JOIN s_dim_employee e ON p.project_manager_id = e.employee_id",
)
def _(t: Tables):
    projects = t.silver["dim_projects"].select("project_id", "project_name", "project_manager_id")
    people = t.silver["dim_employee"].select("employee_id", "full_name")
    return join_on(projects, people, "project_manager_id", "employee_id").drop("project_manager_id")


@query(
    "jn_6_mixed_star",
    "SELECT p.project_id, p.project_type, c.lines, e.evaluations FROM s_dim_projects p"
    " JOIN (SELECT project_id, count(*) AS lines FROM s_fact_project_costs GROUP BY 1) c"
    " ON p.project_id = c.project_id LEFT JOIN (SELECT project_id, count(*) AS evaluations"
    " FROM s_fact_subcontractor_performance GROUP BY 1) e ON p.project_id = e.project_id",
)
def _(t: Tables):
    costs = t.silver["fact_project_costs"].groupBy("project_id").agg(F.count("*").alias("lines"))
    evaluations = (
        t.silver["fact_subcontractor_performance"]
        .groupBy("project_id")
        .agg(F.count("*").alias("evaluations"))
    )
    return star(
        t.silver["dim_projects"].select("project_id", "project_type"),
        [(costs, "project_id", "inner"), (evaluations, "project_id", "left")],
    )


@query(
    "jn_7_orphans",
    "SELECT cost_id, project_id FROM s_fact_project_costs WHERE project_id IS NOT NULL"
    " AND project_id NOT IN (SELECT project_id FROM s_dim_projects)",
)
def _(t: Tables):
    costs = t.silver["fact_project_costs"].select("cost_id", "project_id")
    return orphans(costs, t.silver["dim_projects"], "project_id")


@query(
    "jn_7_orphan_rate",
    f"SELECT *, {O.pct('orphans', '"rows"')} AS orphan_pct FROM (SELECT count(*) AS \"rows\","
    f" count(*) FILTER (WHERE project_id NOT IN (SELECT project_id FROM s_dim_projects))"
    f" AS orphans FROM s_fact_project_costs WHERE project_id IS NOT NULL)",
)
def _(t: Tables):
    return orphan_rate(t.silver["fact_project_costs"], t.silver["dim_projects"], "project_id")


@query(
    "ag_1_grouped_sum",
    f"SELECT vendor_id, {O.msum('amount_eur')} AS amount, count(*) AS n FROM s_fact_invoices"
    f" GROUP BY 1",
)
def _(t: Tables):
    return t.silver["fact_invoices"].groupBy("vendor_id").agg(
        A.money_sum(F.col("amount_eur")).alias("amount"), F.count("*").alias("n")
    )


@query(
    "ag_2_mean_min_max",
    f"SELECT project_id, {O.mean('overall_score')} AS mean_score, min(overall_score) AS min_score,"
    f" max(overall_score) AS max_score FROM s_fact_subcontractor_performance GROUP BY 1",
)
def _(t: Tables):
    score = F.col("overall_score")
    return t.silver["fact_subcontractor_performance"].groupBy("project_id").agg(
        A.mean(score).alias("mean_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )


@query(
    "ag_3_count_if",
    "SELECT po_category, count(*) FILTER (WHERE is_over_invoiced) AS over_invoiced,"
    " count(*) FILTER (WHERE po_status = 'open') AS still_open FROM s_fact_purchase_orders"
    " GROUP BY 1",
)
def _(t: Tables):
    return t.silver["fact_purchase_orders"].groupBy("po_category").agg(
        F.count_if("is_over_invoiced").alias("over_invoiced"),
        F.count_if(F.col("po_status") == "open").alias("still_open"),
    )


@query(
    "ag_4_avg_if",
    f"SELECT takt_zone, {O.avg('''CASE WHEN milestone_status = 'complete' THEN delay_days END''')}"
    f" AS avg_delay FROM s_fact_schedule_milestones GROUP BY 1",
)
def _(t: Tables):
    complete = F.col("milestone_status") == "complete"
    return t.silver["fact_schedule_milestones"].groupBy("takt_zone").agg(
        A.avg_if(complete, F.col("delay_days")).alias("avg_delay")
    )


@query(
    "ag_5_count_distinct",
    "SELECT project_id, count(DISTINCT vendor_id) AS vendors, count(DISTINCT po_category)"
    " AS categories FROM s_fact_purchase_orders GROUP BY 1",
)
def _(t: Tables):
    return t.silver["fact_purchase_orders"].groupBy("project_id").agg(
        A.n_distinct(F.col("vendor_id")).alias("vendors"),
        A.n_distinct(F.col("po_category")).alias("categories"),
    )


@query(
    "ag_5_approx_count_distinct",
    "SELECT po_category, count(DISTINCT vendor_id) AS vendors, TRUE AS close"
    " FROM s_fact_purchase_orders GROUP BY 1",
)
def _(t: Tables):
    exact, near = (A.n_distinct(F.col("vendor_id"), approx=a) for a in (False, True))
    # Three standard errors of the sketch.
    return t.silver["fact_purchase_orders"].groupBy("po_category").agg(
        exact.alias("vendors"), (F.abs(near - exact) <= exact * 0.15).alias("close")
    )


@query(
    "ag_6_ratio",
    f"SELECT project_id, {O.pct(O.msum('actual_eur'), O.msum('budget_eur'))} AS used_pct,"
    f" {O.ratio(O.msum('committed_eur'), O.msum('budget_eur'))} AS committed_ratio"
    f" FROM s_fact_project_costs GROUP BY 1",
)
def _(t: Tables):
    total = {c: A.money_sum(F.col(f"{c}_eur")) for c in ("budget", "committed", "actual")}
    return t.silver["fact_project_costs"].groupBy("project_id").agg(
        A.pct(total["actual"], total["budget"]).alias("used_pct"),
        A.ratio(total["committed"], total["budget"]).alias("committed_ratio"),
    )


@query(
    "ag_7_group_by_expression",
    f"SELECT {O.bucket('days_overdue')} AS aging_bucket, count(*) AS n FROM s_fact_invoices"
    f" GROUP BY 1",
)
def _(t: Tables):
    bucket = aging_bucket(F.col("days_overdue")).alias("aging_bucket")
    return t.silver["fact_invoices"].groupBy(bucket).agg(F.count("*").alias("n"))


@query("ag_8_duplicate_keys", key_report_sql("b_"))
def _(t: Tables):
    return key_report(t.raw)


@query(
    "ag_9_global",
    f"SELECT count(*) AS n, {O.msum('amount_eur')} AS amount, max(days_overdue) AS max_overdue"
    f" FROM s_fact_invoices",
)
def _(t: Tables):
    return t.silver["fact_invoices"].agg(
        F.count("*").alias("n"),
        A.money_sum(F.col("amount_eur")).alias("amount"),
        F.max("days_overdue").alias("max_overdue"),
    )


@query(
    "ag_10_frequencies",
    "SELECT milestone_status, count(*) AS \"count\" FROM s_fact_schedule_milestones GROUP BY 1",
)
def _(t: Tables):
    return A.frequencies(t.silver["fact_schedule_milestones"], "milestone_status")


@query(
    "ag_11_sum_of_sums",
    f"SELECT cost_category, {O.msum('total_actual_eur')} AS actual,"
    f" CAST(sum(line_count) AS BIGINT) AS lines FROM g_cost_variance_monthly GROUP BY 1",
)
def _(t: Tables):
    return t.gold["gold_cost_variance_monthly"].groupBy("cost_category").agg(
        A.money_sum(F.col("total_actual_eur")).alias("actual"), F.sum("line_count").alias("lines")
    )


@query(
    "so_1_order_by",
    "SELECT project_id, takt_zone, total_milestones FROM g_schedule_kpi ORDER BY 1, 2",
)
def _(t: Tables):
    return (
        t.gold["gold_schedule_kpi"]
        .select("project_id", "takt_zone", "total_milestones")
        .orderBy("project_id", "takt_zone")
    )


@query(
    "so_2_top_k",
    "SELECT invoice_id, amount_eur FROM s_fact_invoices"
    " ORDER BY amount_eur DESC NULLS LAST, invoice_id LIMIT 20",
)
def _(t: Tables):
    amounts = t.silver["fact_invoices"].select("invoice_id", "amount_eur")
    return top_k(amounts, "amount_eur", 20, tie_break=("invoice_id",))


@query(
    "se_1_union",
    "SELECT vendor_id, count(*) AS n FROM (SELECT vendor_id FROM s_fact_invoices UNION ALL"
    " SELECT vendor_id FROM s_fact_purchase_orders) GROUP BY 1",
)
def _(t: Tables):
    both = t.silver["fact_invoices"].select("vendor_id").unionByName(
        t.silver["fact_purchase_orders"].select("vendor_id")
    )
    return both.groupBy("vendor_id").agg(F.count("*").alias("n"))

