"""Gold marts of the batch path.

Facts are aggregated to the grain of the mart before any dimension is joined, so a join moves one
row per group, and a hot project or vendor is reduced by partial aggregation before the shuffle.
Silver keys are unique, which makes this equal to joining first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.functions.dates import year_month
from projectmart.functions.values import aging_bucket, round_half_up
from projectmart.operators.aggregates import mean, money_sum, money_total, pct
from projectmart.operators.joins import enrich, join_on, star

Tables = Mapping[str, DataFrame]


def cost_variance_monthly(silver: Tables) -> DataFrame:
    monthly = (
        silver["fact_project_costs"]
        .withColumn("period_year_month", year_month(F.col("period_month_dt")))
        .groupBy("project_id", "cost_category", "period_year_month")
        .agg(
            money_sum(F.col("budget_eur")).alias("total_budget_eur"),
            money_sum(F.col("committed_eur")).alias("total_committed_eur"),
            money_sum(F.col("actual_eur")).alias("total_actual_eur"),
            money_sum(F.col("variance_eur")).alias("total_variance_eur"),
            F.count("*").alias("line_count"),
        )
        .withColumns(
            {
                "budget_utilization_pct": pct(F.col("total_actual_eur"), F.col("total_budget_eur")),
                "is_over_budget": F.coalesce(F.col("total_variance_eur") < 0, F.lit(False)),
            }
        )
    )
    columns = ("project_name", "project_type", "municipality")
    return enrich(monthly, silver["dim_projects"], "project_id", columns)


def schedule_kpi(silver: Tables) -> DataFrame:
    status, total = F.col("milestone_status"), F.col("total_milestones")
    zones = (
        silver["fact_schedule_milestones"]
        .groupBy("project_id", "takt_zone")
        .agg(
            F.count("*").alias("total_milestones"),
            F.count_if(status == "complete").alias("completed_milestones"),
            F.count_if(status == "delayed").alias("delayed_milestones"),
            F.count_if(status == "on_track").alias("on_track_milestones"),
            round_half_up(F.avg("delay_days"), 1).alias("avg_delay_days"),
            F.max("delay_days").alias("max_delay_days"),
        )
        .withColumns(
            {
                "completion_rate_pct": pct(F.col("completed_milestones"), total),
                "delay_rate_pct": pct(F.col("delayed_milestones"), total),
            }
        )
    )
    columns = ("project_name", "project_type", "municipality", "status")
    return enrich(zones, silver["dim_projects"], "project_id", columns)


def vendor_scorecard(silver: Tables) -> DataFrame:
    """Every vendor; measures are NULL where a vendor has no such facts."""
    scores = ("quality", "schedule", "safety", "communication", "overall")
    evaluations = (
        silver["fact_subcontractor_performance"]
        .groupBy("vendor_id")
        .agg(
            *[
                round_half_up(mean(F.col(f"{s}_score")), 2).alias(f"avg_{s}_score") for s in scores
            ],
            F.count("*").alias("evaluation_count"),
            F.count_if("would_rehire").alias("rehire_yes_count"),
        )
        .withColumn(
            "rehire_rate_pct", pct(F.col("rehire_yes_count"), F.col("evaluation_count"))
        )
    )
    invoices = (
        silver["fact_invoices"]
        .groupBy("vendor_id")
        .agg(
            F.count("*").alias("total_invoices"),
            money_sum(F.col("amount_eur")).alias("total_invoice_amount"),
            F.avg("days_overdue").alias("avg_days_overdue"),
            F.count_if(F.col("payment_status") == "disputed").alias("disputed_invoices"),
        )
    )
    orders = (
        silver["fact_purchase_orders"]
        .groupBy("vendor_id")
        .agg(
            F.count("*").alias("total_pos"),
            F.count_if("is_over_invoiced").alias("over_invoiced_pos"),
        )
    )
    parts = [(part, "vendor_id", "left") for part in (evaluations, invoices, orders)]
    return star(silver["dim_vendors"], parts)


def invoice_aging(silver: Tables) -> DataFrame:
    aged = (
        silver["fact_invoices"]
        .withColumn("aging_bucket", aging_bucket(F.col("days_overdue")))
        .groupBy("vendor_id", "payment_status", "aging_bucket")
        .agg(
            F.count("*").alias("invoice_count"),
            money_sum(F.col("amount_eur")).alias("total_amount_eur"),
            round_half_up(F.avg("days_overdue"), 1).alias("avg_days_overdue"),
            F.max("days_overdue").alias("max_days_overdue"),
        )
    )
    return enrich(aged, silver["dim_vendors"], "vendor_id", ("vendor_name", "vendor_type"))


def risk_score(utilization: Column, delayed: Column, over_invoiced: Column, delay: Column) -> Column:
    """Points for budget overrun, late milestones, over-invoiced orders and average delay.

    Unknown terms count as 0. Added in decimal, so two places are exact.
    """
    points = V.RISK_POINTS
    zero = F.lit(0).cast("decimal(18,3)")

    def beyond(value: Column, bound: int, factor: str) -> Column:
        excess = value.cast("decimal(18,2)") - F.lit(bound)
        weighted = (excess * F.lit(factor).cast("decimal(2,1)")).cast("decimal(18,3)")
        return F.when(value > bound, weighted).otherwise(zero)

    def each(count: Column, factor: int) -> Column:
        return F.coalesce((count * factor).cast("decimal(18,3)"), zero)

    total = (
        beyond(utilization, 100, points["over_pct"])
        + each(delayed, points["delayed"])
        + each(over_invoiced, points["over_invoiced"])
        + beyond(delay, 0, points["delay_day"])
    )
    return F.round(total, 2).cast("double")


def risk_level(score: Column) -> Column:
    (high_bound, high), (medium_bound, medium) = V.RISK_LEVELS
    return F.when(score > high_bound, high).when(score > medium_bound, medium).otherwise("low")


def project_summary(silver: Tables) -> DataFrame:
    """Every project with its cost, schedule and purchasing totals and the risk rule."""
    costs = (
        silver["fact_project_costs"]
        .groupBy("project_id")
        .agg(
            money_sum(F.col("budget_eur")).alias("total_budget_eur"),
            money_sum(F.col("actual_eur")).alias("total_actual_eur"),
            money_sum(F.col("variance_eur")).alias("total_variance_eur"),
        )
    )
    status = F.col("milestone_status")
    schedule = (
        silver["fact_schedule_milestones"]
        .groupBy("project_id")
        .agg(
            F.count("*").alias("total_milestones"),
            F.count_if(status == "complete").alias("completed_milestones"),
            F.count_if(status == "delayed").alias("delayed_milestones"),
            round_half_up(F.avg("delay_days"), 1).alias("avg_delay_days"),
        )
    )
    orders = (
        silver["fact_purchase_orders"]
        .groupBy("project_id")
        .agg(
            money_sum(F.col("po_value_eur")).alias("total_po_value_eur"),
            money_sum(F.col("invoiced_eur")).alias("total_invoiced_eur"),
            F.count_if("is_over_invoiced").alias("over_invoiced_pos"),
        )
    )
    parts = [(part, "project_id", "left") for part in (costs, schedule, orders)]
    summary = star(silver["dim_projects"], parts).withColumns(
        {
            "budget_utilization_pct": pct(F.col("total_actual_eur"), F.col("total_budget_eur")),
            "milestone_completion_pct": pct(
                F.col("completed_milestones"), F.col("total_milestones")
            ),
        }
    )
    scored = summary.withColumn(
        "risk_score",
        risk_score(
            F.col("budget_utilization_pct"),
            F.col("delayed_milestones"),
            F.col("over_invoiced_pos"),
            F.col("avg_delay_days"),
        ),
    )
    return scored.withColumn("risk_level", risk_level(F.col("risk_score")))


def purchases_by_manager(
    employees: DataFrame,
    projects: DataFrame,
    orders: DataFrame,
    *,
    attributes: tuple[str, ...],
    value: str,
    invoiced: str,
) -> DataFrame:
    """Order measures per employee who manages a project with orders.

    Orders are reduced to one row per project before the joins. Keys of all three tables are
    unique and a project has one manager, so counts of orders and projects add up and no distinct
    count is needed.
    """
    per_project = (
        orders.dropna(subset=["project_id"])
        .groupBy("project_id")
        .agg(
            F.count("po_id").alias("orders"),
            F.count_if("is_over_invoiced").alias("over"),
            money_total(F.col(value)).alias("value"),
            F.count(value).alias("values"),
            money_total(F.col(invoiced)).alias("invoiced"),
        )
    )
    managed = projects.select("project_id", "project_manager_id").dropna().join(
        per_project, "project_id"
    )
    per_manager = managed.groupBy("project_manager_id").agg(
        F.sum("orders").alias("total_po_count"),
        F.round(F.sum("value"), 2).cast("double").alias("total_po_value_eur"),
        F.round(F.sum("invoiced"), 2).cast("double").alias("total_invoiced_eur"),
        F.sum("over").alias("over_invoiced_count"),
        pct(F.sum("over"), F.sum("orders")).alias("over_invoiced_pct"),
        F.count("*").alias("project_count"),
        round_half_up(
            F.try_divide(F.sum("value").cast("double"), F.sum("values").cast("double")), 2
        ).alias("avg_po_value_eur"),
    )
    named = employees.select("employee_id", *attributes)
    return join_on(named, per_manager, "employee_id", "project_manager_id").drop(
        "project_manager_id"
    )


def employee_purchase_summary(silver: Tables) -> DataFrame:
    return purchases_by_manager(
        silver["dim_employee"],
        silver["dim_projects"],
        silver["fact_purchase_orders"],
        attributes=("full_name", "role", "department"),
        value="po_value_eur",
        invoiced="invoiced_eur",
    )


BUILDERS = {
    "gold_cost_variance_monthly": cost_variance_monthly,
    "gold_schedule_kpi": schedule_kpi,
    "gold_vendor_scorecard": vendor_scorecard,
    "gold_invoice_aging": invoice_aging,
    "gold_project_summary": project_summary,
    "gold_employee_purchase_summary": employee_purchase_summary,
}

# The silver columns that each mart reads.
READS: dict[str, dict[str, tuple[str, ...]]] = {
    "gold_cost_variance_monthly": {
        "fact_project_costs": (
            "project_id", "cost_category", "period_month_dt", "budget_eur", "committed_eur",
            "actual_eur", "variance_eur",
        ),
        "dim_projects": ("project_id", "project_name", "project_type", "municipality"),
    },
    "gold_schedule_kpi": {
        "fact_schedule_milestones": ("project_id", "takt_zone", "milestone_status", "delay_days"),
        "dim_projects": ("project_id", "project_name", "project_type", "municipality", "status"),
    },
    "gold_invoice_aging": {
        "fact_invoices": ("vendor_id", "payment_status", "days_overdue", "amount_eur"),
        "dim_vendors": ("vendor_id", "vendor_name", "vendor_type"),
    },
    "gold_employee_purchase_summary": {
        "dim_employee": ("employee_id", "full_name", "role", "department"),
        "dim_projects": ("project_id", "project_manager_id"),
        "fact_purchase_orders": (
            "po_id", "project_id", "po_value_eur", "invoiced_eur", "is_over_invoiced",
        ),
    },
}


def gold_marts(silver: Tables) -> dict[str, DataFrame]:
    return {mart: build(silver) for mart, build in BUILDERS.items()}
