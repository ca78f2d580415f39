"""Projections, filters, expectations and cleansing operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import core as O
from projectmart.functions import dates as D
from projectmart.functions import fixed_values as V
from projectmart.functions import values as N
from projectmart.operators.aggregates import duplicate_key_groups, frequencies, money_sum
from projectmart.operators.keys import clean_keys, first_per_key
from projectmart.plans import declarative, model
from projectmart.plans.features import project_features, schedule_features
from registry.base import Tables, mapped, query, union, values, values_sql

DATES = {
    "dim_projects": ("start_date", "planned_end_date", "actual_end_date"),
    "fact_schedule_milestones": ("planned_date", "forecast_date", "actual_date"),
    "fact_purchase_orders": ("po_date",),
    "fact_invoices": ("invoice_date", "due_date", "paid_date"),
    "fact_subcontractor_performance": ("evaluation_date",),
}
MONTHS = {"fact_project_costs": ("period_month",)}
ENUMS = {
    ("dim_employee", "role"): (V.ROLES, V.ROLE_VARIANTS),
    ("dim_employee", "department"): ((*V.DEPARTMENTS, V.UNASSIGNED), V.DEPARTMENT_VARIANTS),
    ("dim_projects", "project_type"): (V.PROJECT_TYPES, V.PROJECT_TYPE_VARIANTS),
    ("dim_projects", "status"): (V.PROJECT_STATUSES, V.PROJECT_STATUS_VARIANTS),
    ("dim_vendors", "vendor_type"): (V.VENDOR_TYPES, V.VENDOR_TYPE_VARIANTS),
    ("dim_vendors", "trade_category"): (V.TRADES, V.TRADE_VARIANTS),
    ("dim_vendors", "dun_bradstreet_rating"): (V.RATINGS, {}),
    ("dim_vendors", "approved_status"): (V.APPROVALS, V.APPROVAL_VARIANTS),
    ("fact_schedule_milestones", "milestone_status"): (
        V.MILESTONE_STATUSES, V.MILESTONE_STATUS_VARIANTS,
    ),
    ("fact_project_costs", "cost_category"): (V.COST_CATEGORIES, V.COST_CATEGORY_VARIANTS),
    ("fact_purchase_orders", "po_category"): (V.PO_CATEGORIES, V.PO_CATEGORY_VARIANTS),
    ("fact_purchase_orders", "po_status"): (V.PO_STATUSES, V.PO_STATUS_VARIANTS),
    ("fact_invoices", "payment_status"): (V.PAYMENT_STATUSES, V.PAYMENT_STATUS_VARIANTS),
}
ENUM_COLUMNS: dict[str, tuple[str, ...]] = {}
for _table, _column in ENUMS:
    ENUM_COLUMNS[_table] = (*ENUM_COLUMNS.get(_table, ()), _column)
MUNICIPALITY = {"dim_projects": ("municipality",)}
FLAGS = {
    "dim_vendors": ("rala_certified",),
    "fact_subcontractor_performance": ("would_rehire",),
}
SCORES = {"fact_subcontractor_performance": tuple(V.SCORE_WEIGHTS)}
REFERENCES = {
    ("dim_projects", "project_manager_id"): "employee_id",
    ("dim_projects", "client_id"): "client_id",
    ("fact_schedule_milestones", "project_id"): "project_id",
    ("fact_project_costs", "project_id"): "project_id",
    ("fact_purchase_orders", "project_id"): "project_id",
    ("fact_purchase_orders", "vendor_id"): "vendor_id",
    ("fact_invoices", "po_id"): "po_id",
    ("fact_invoices", "vendor_id"): "vendor_id",
    ("fact_subcontractor_performance", "vendor_id"): "vendor_id",
    ("fact_subcontractor_performance", "project_id"): "project_id",
}


# --- projections, filters, expectations ---------------------------------------------------------


@query("pr_1_add_columns", "SELECT * FROM c_dim_employee")
def _(t: Tables):
    return t.raw["dim_employee"].transform(first_per_key, ["employee_id"]).select(
        "*",
        N.fold(F.col("role")).alias("role_clean"),
        N.fold(F.col("department")).alias("department_clean"),
    )


@query(
    "pr_2_replace_columns",
    "SELECT * REPLACE (lower(trim(vendor_type)) AS vendor_type,"
    " lower(trim(trade_category)) AS trade_category) FROM b_dim_vendors",
)
def _(t: Tables):
    return t.raw["dim_vendors"].withColumns(
        {c: N.fold(F.col(c)) for c in ("vendor_type", "trade_category")}
    )


@query(
    "fl_1_null_filter",
    "SELECT payment_status, count(*) AS n FROM b_fact_invoices"
    " WHERE vendor_id IS NOT NULL AND paid_date IS NULL GROUP BY 1",
)
def _(t: Tables):
    known = t.raw["fact_invoices"].filter(
        F.col("vendor_id").isNotNull() & F.col("paid_date").isNull()
    )
    return known.groupBy("payment_status").agg(F.count("*").alias("n"))


@query(
    "fl_2_text_predicate",
    "SELECT invoice_id, count(*) AS n FROM b_fact_invoices GROUP BY 1 HAVING count(*) > 1",
)
def _(t: Tables):
    return duplicate_key_groups(t.raw["fact_invoices"], "invoice_id")


@query(
    "fl_3_not_in_set",
    f"SELECT payment_status, count(*) AS n FROM b_fact_invoices WHERE payment_status NOT IN"
    f" ({O.in_list(V.PAYMENT_STATUSES)}) GROUP BY 1",
)
def _(t: Tables):
    status = F.col("payment_status")
    return (
        t.raw["fact_invoices"]
        .filter(~status.isin(*V.PAYMENT_STATUSES) & status.isNotNull())
        .groupBy("payment_status")
        .agg(F.count("*").alias("n"))
    )


@query(
    "fl_4_out_of_range",
    "SELECT quality_score, count(*) AS n FROM b_fact_subcontractor_performance"
    " WHERE quality_score < 1 OR quality_score > 10 GROUP BY 1",
)
def _(t: Tables):
    return (
        t.raw["fact_subcontractor_performance"]
        .filter("quality_score < 1 OR quality_score > 10")
        .groupBy("quality_score")
        .agg(F.count("*").alias("n"))
    )


@query("fl_5_equality", "SELECT * FROM g_invoice_aging WHERE aging_bucket = '90+ days'")
def _(t: Tables):
    return t.gold["gold_invoice_aging"].filter(F.col("aging_bucket") == "90+ days")


def _expectation_sql(rules) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, count(*) AS \"rows\","
        f" count(*) FILTER (WHERE NOT coalesce({predicate}, FALSE)) AS violations FROM c_{table}"
        for table, predicates in rules.items()
        for rule, predicate in predicates.items()
    )


@query("ex_1_expect_or_drop", _expectation_sql(O.EXPECTED))
def _(t: Tables):
    return declarative.expectation_report(t.raw, declarative.required_rules(), declarative.CHECKED)


@query("ex_2_expect", _expectation_sql(O.WARNED))
def _(t: Tables):
    return declarative.expectation_report(t.raw, declarative.warning_rules(), declarative.WARNED)


# --- cleansing of single values -----------------------------------------------------------------

mapped("cl_1_parse_dates", DATES, D.parse_date, O.parse_date("raw"))
mapped(
    "cl_2_parse_dates_three_formats",
    DATES,
    lambda raw: D.parse_date(raw, V.THREE_FORMATS),
    O.parse_date("raw", V.THREE_FORMATS),
)
mapped("cl_4_parse_month", MONTHS, D.parse_month, O.parse_month("raw"))
mapped(
    "cl_5_parse_month_three_formats",
    MONTHS,
    lambda raw: D.parse_month(raw, V.MONTH_FORMATS_SHORT),
    O.parse_month("raw", V.MONTH_FORMATS_SHORT),
)
mapped("cl_8_fold", ENUM_COLUMNS, N.fold, O.fold("raw"))
mapped(
    "cl_10_map_enum_keep_unmapped",
    MUNICIPALITY,
    lambda raw: N.map_enum(raw, (), V.MUNICIPALITY_VARIANTS, keep_unmapped=True),
    O.map_enum("raw", (), V.MUNICIPALITY_VARIANTS, keep=True),
)
mapped("cl_11_parse_bool", FLAGS, N.parse_bool, O.parse_bool("raw"))
mapped(
    "cl_12_business_id_flag",
    {"dim_vendors": ("business_id",)},
    lambda raw: N.matches_flag(raw, V.BUSINESS_ID),
    O.flag("raw"),
)
mapped("cl_15_null_outside", SCORES, N.null_outside, O.in_range("raw"))


@query(
    "cl_9_map_enum",
    " UNION ALL ".join(
        f"SELECT *, {O.map_enum('raw', valid, variants)} AS result"
        f" FROM ({values_sql('b_', {table: (column,)})})"
        for (table, column), (valid, variants) in ENUMS.items()
    ),
)
def _(t: Tables):
    return union(
        [
            values(t.raw, {table: (column,)}).withColumn(
                "result", N.map_enum(F.col("raw"), valid, variants)
            )
            for (table, column), (valid, variants) in ENUMS.items()
        ]
    )


@query(
    "cl_13_null_unless_matches",
    " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", {O.fk(c, kind)} AS result,"
        f" count(*) AS n FROM b_{table} GROUP BY 3"
        for (table, c), kind in REFERENCES.items()
    ),
)
def _(t: Tables):
    return union(
        [
            t.raw[table]
            .groupBy(N.null_unless_matches(F.col(c), V.WIDE_KEYS[kind]).alias("result"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(table).alias("table"), F.lit(c).alias("column"), "result", "n")
            for (table, c), kind in REFERENCES.items()
        ]
    )


# --- keys ---------------------------------------------------------------------------------------


@query("cl_6_clean_keys", "SELECT * FROM u_fact_purchase_orders")
def _(t: Tables):
    return clean_keys(t.raw["fact_purchase_orders"], "po_id")


@query("cl_7_dedup", "SELECT * FROM q_fact_purchase_orders")
def _(t: Tables):
    return first_per_key(t.raw["fact_purchase_orders"], ["po_id"])


@query("wn_1_row_number", "SELECT * FROM u_fact_schedule_milestones")
def _(t: Tables):
    return clean_keys(t.raw["fact_schedule_milestones"], "milestone_id")


@query("wn_2_first_per_key", "SELECT * FROM q_fact_subcontractor_performance")
def _(t: Tables):
    return first_per_key(t.raw["fact_subcontractor_performance"], ["perf_id"])


# --- derived values -----------------------------------------------------------------------------


@query(
    "cl_14_abs_amount",
    f"SELECT cost_category, {O.msum('abs(budget_eur)')} AS budget,"
    f" {O.msum('abs(committed_eur)')} AS committed, {O.msum('abs(actual_eur)')} AS actual"
    f" FROM b_fact_project_costs GROUP BY 1",
)
def _(t: Tables):
    amounts = ("budget", "committed", "actual")
    return (
        t.raw["fact_project_costs"]
        .groupBy("cost_category")
        .agg(*[money_sum(F.abs(f"{a}_eur")).alias(a) for a in amounts])
    )


@query(
    "cl_16_variance",
    f"SELECT cost_id, {O.variance('budget_eur', 'actual_eur')} AS variance_eur"
    f" FROM b_fact_project_costs",
)
def _(t: Tables):
    return t.raw["fact_project_costs"].select(
        "cost_id", N.variance(F.col("budget_eur"), F.col("actual_eur")).alias("variance_eur")
    )


@query(
    "cl_17_delay_days",
    "SELECT milestone_status, delay_days, count(*) AS n FROM s_fact_schedule_milestones"
    " GROUP BY 1, 2",
)
def _(t: Tables):
    return (
        t.silver["fact_schedule_milestones"]
        .groupBy("milestone_status", "delay_days")
        .agg(F.count("*").alias("n"))
    )


@query(
    "cl_18_actual_only_complete",
    "SELECT milestone_status, actual_date_dt, count(*) AS n FROM s_fact_schedule_milestones"
    " GROUP BY 1, 2",
)
def _(t: Tables):
    return (
        t.silver["fact_schedule_milestones"]
        .groupBy("milestone_status", "actual_date_dt")
        .agg(F.count("*").alias("n"))
    )


@query(
    "cl_19_end_not_before_start",
    f"SELECT project_id, CASE WHEN {O.parse_date('actual_end_date')} < {O.parse_date('start_date')}"
    f" THEN NULL ELSE {O.parse_date('actual_end_date')} END AS ended FROM b_dim_projects",
)
def _(t: Tables):
    ended, started = D.parse_date(F.col("actual_end_date")), D.parse_date(F.col("start_date"))
    return t.raw["dim_projects"].select(
        "project_id", N.null_if_before(ended, started).alias("ended")
    )


@query(
    "cl_20_no_end_while_running",
    "SELECT project_id, status, start_date_dt, actual_end_date_dt FROM s_dim_projects",
)
def _(t: Tables):
    return t.silver["dim_projects"].select(
        "project_id", "status", "start_date_dt", "actual_end_date_dt"
    )


@query(
    "cl_21_paid_date",
    "SELECT payment_status, paid_date_dt, count(*) AS n FROM s_fact_invoices GROUP BY 1, 2",
)
def _(t: Tables):
    return (
        t.silver["fact_invoices"]
        .groupBy("payment_status", "paid_date_dt")
        .agg(F.count("*").alias("n"))
    )


@query(
    "cl_22_days_overdue",
    "SELECT payment_status, days_overdue, count(*) AS n FROM s_fact_invoices GROUP BY 1, 2",
)
def _(t: Tables):
    return (
        t.silver["fact_invoices"]
        .groupBy("payment_status", "days_overdue")
        .agg(F.count("*").alias("n"))
    )


@query(
    "cl_23_weighted_score",
    f"SELECT perf_id, {O.score(*(f'({O.in_range(c)})' for c in V.SCORE_WEIGHTS))} AS overall_score"
    f" FROM b_fact_subcontractor_performance",
)
def _(t: Tables):
    scores = {c: N.null_outside(F.col(c)) for c in V.SCORE_WEIGHTS}
    return t.raw["fact_subcontractor_performance"].select(
        "perf_id", N.weighted_score(scores).alias("overall_score")
    )


@query(
    "cl_24_over_invoiced",
    "SELECT po_id, coalesce(abs(invoiced_eur) > abs(po_value_eur), FALSE) AS is_over_invoiced"
    " FROM b_fact_purchase_orders",
)
def _(t: Tables):
    return t.raw["fact_purchase_orders"].select(
        "po_id",
        N.over_invoiced(F.col("invoiced_eur"), F.col("po_value_eur")).alias("is_over_invoiced"),
    )


@query(
    "cl_26_fill_numeric",
    f"SELECT p.project_id, p.project_type, coalesce(p.contract_value_eur, 0) AS contract_value_eur,"
    f" coalesce(m.total_milestones, 0) AS total_milestones,"
    f" coalesce(m.avg_delay_days, 0) AS avg_delay_days, m.max_delay_days"
    f" FROM s_dim_projects p LEFT JOIN (SELECT project_id, count(*) AS total_milestones,"
    f" {O.half_up(O.avg('delay_days'), 2)} AS avg_delay_days, max(delay_days) AS max_delay_days"
    f" FROM s_fact_schedule_milestones GROUP BY 1) m ON p.project_id = m.project_id",
)
def _(t: Tables):
    schedule = schedule_features(t.silver["fact_schedule_milestones"])
    joined = project_features(t.silver["dim_projects"]).join(schedule, "project_id", "left")
    columns = (
        "project_id", "project_type", "contract_value_eur", "total_milestones", "avg_delay_days",
        "max_delay_days",
    )
    return N.fill_numeric(joined.select(*columns), exclude=["max_delay_days"])


@query(
    "cl_27_fill_unknown",
    "SELECT coalesce(project_type, 'unknown') AS project_type, count(*) AS \"count\""
    " FROM s_dim_projects GROUP BY 1",
)
def _(t: Tables):
    return frequencies(model.known_categories(t.silver["dim_projects"]), "project_type")


