"""Serving queries and key figures over the gold marts of the batch path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions.values import round_half_up
from projectmart.operators.aggregates import frequencies, mean, money_sum, pct
from projectmart.operators.joins import join_on
from projectmart.operators.topk import top_k

Tables = Mapping[str, DataFrame]


def kpis(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row of named aggregates over the whole table."""
    return df.agg(*[measure.alias(name) for name, measure in measures.items()])


def cost_trend(gold: Tables) -> DataFrame:
    return (
        gold["gold_cost_variance_monthly"]
        .filter(F.col("period_year_month").isNotNull())
        .groupBy("period_year_month", "project_type")
        .agg(
            money_sum(F.col("total_budget_eur")).alias("budget"),
            money_sum(F.col("total_actual_eur")).alias("actual"),
            money_sum(F.col("total_variance_eur")).alias("variance"),
        )
        .orderBy("period_year_month", "project_type")
    )


def schedule_overview(gold: Tables, k: int = 50) -> DataFrame:
    """The project zones with the lowest completion rate."""
    known = gold["gold_schedule_kpi"].filter(F.col("project_name").isNotNull())
    ties = ("project_id", "takt_zone")
    return top_k(known, "completion_rate_pct", k, ascending=True, tie_break=ties).select(
        "project_name",
        "takt_zone",
        "completion_rate_pct",
        "delay_rate_pct",
        "avg_delay_days",
        "status",
    )


def vendor_leaderboard(gold: Tables, k: int = 30) -> DataFrame:
    rated = gold["gold_vendor_scorecard"].dropna(subset=["vendor_name", "avg_overall_score"])
    return top_k(rated, "avg_overall_score", k, tie_break=("vendor_id",)).select(
        "vendor_name",
        "vendor_type",
        "trade_category",
        "avg_overall_score",
        "rehire_rate_pct",
        "evaluation_count",
        "total_invoices",
        "disputed_invoices",
    )


def aging_distribution(gold: Tables) -> DataFrame:
    return (
        gold["gold_invoice_aging"]
        .groupBy("aging_bucket", "payment_status")
        .agg(
            F.sum("invoice_count").alias("invoices"),
            money_sum(F.col("total_amount_eur")).alias("amount_eur"),
        )
        .orderBy("aging_bucket", "payment_status")
    )


def project_health(gold: Tables, k: int = 50) -> DataFrame:
    named = gold["gold_project_summary"].filter(F.col("project_name").isNotNull())
    return top_k(named, "risk_score", k, tie_break=("project_id",)).select(
        "project_name",
        "project_type",
        "municipality",
        "status",
        "budget_utilization_pct",
        "milestone_completion_pct",
        "avg_delay_days",
        "risk_score",
        "risk_level",
    )


def risk_predictions(scores: DataFrame, projects: DataFrame, k: int = 20) -> DataFrame:
    """High-risk projects by predicted probability.

    The join comes before the cut, since a scored project may be missing in the dimension.
    """
    high = scores.filter(F.col("risk_level") == "high").select(
        F.col("project_id").alias("scored_id"), "overrun_probability", "risk_level"
    )
    named = join_on(
        high,
        projects.select("project_id", "project_name", "project_type"),
        "scored_id",
        "project_id",
    ).drop("scored_id")
    return top_k(named, "overrun_probability", k, tie_break=("project_id",))


def employee_purchasing(gold: Tables, k: int = 30) -> DataFrame:
    named = gold["gold_employee_purchase_summary"].filter(F.col("full_name").isNotNull())
    return top_k(named, "total_po_value_eur", k, tie_break=("employee_id",)).drop("employee_id")


def cost_kpis(gold: Tables) -> DataFrame:
    return kpis(
        gold["gold_cost_variance_monthly"],
        {
            "total_budget": money_sum(F.col("total_budget_eur")),
            "total_actual": money_sum(F.col("total_actual_eur")),
            "total_variance": money_sum(F.col("total_variance_eur")),
            "avg_utilization": mean(F.col("budget_utilization_pct")),
            "overrun_lines": F.count_if("is_over_budget"),
            "total_lines": F.count("*"),
        },
    )


def schedule_kpis(gold: Tables) -> DataFrame:
    return kpis(
        gold["gold_schedule_kpi"],
        {
            "avg_completion_rate": mean(F.col("completion_rate_pct")),
            "avg_delay_rate": mean(F.col("delay_rate_pct")),
            "avg_delay_days": mean(F.col("avg_delay_days")),
            "total_milestones": F.sum("total_milestones"),
            "completed_milestones": F.sum("completed_milestones"),
            "delayed_milestones": F.sum("delayed_milestones"),
        },
    )


def vendor_kpis(gold: Tables) -> DataFrame:
    return kpis(
        gold["gold_vendor_scorecard"],
        {
            "total_vendors": F.count("*"),
            "avg_vendor_score": mean(F.col("avg_overall_score")),
            "total_invoices_reviewed": F.sum("total_invoices"),
            "total_disputed": F.sum("disputed_invoices"),
            "avg_rehire_rate": mean(F.col("rehire_rate_pct")),
        },
    )


def invoice_kpis(gold: Tables) -> DataFrame:
    """Totals and the 90+ days exposure in one pass."""
    old = F.col("aging_bucket") == "90+ days"
    return kpis(
        gold["gold_invoice_aging"],
        {
            "total_invoices": F.sum("invoice_count"),
            "total_invoice_value": money_sum(F.col("total_amount_eur")),
            "avg_days_overdue": mean(F.col("avg_days_overdue")),
            "count_90plus": F.sum(F.when(old, F.col("invoice_count"))),
            "amount_90plus": money_sum(F.when(old, F.col("total_amount_eur"))),
        },
    )


def risk_kpis(scores: DataFrame) -> DataFrame:
    level = F.col("risk_level")
    high, scored = F.count_if(level == "high"), F.count("*")
    return kpis(
        scores,
        {
            "high_risk": high,
            "medium_risk": F.count_if(level == "medium"),
            "low_risk": F.count_if(level == "low"),
            "total_scored": scored,
            "high_risk_pct": pct(high, scored, 1),
        },
    )


def portfolio_kpis(gold: Tables) -> DataFrame:
    level = F.col("risk_level")
    return kpis(
        gold["gold_project_summary"],
        {
            "total_projects": F.count("*"),
            "avg_budget_util": mean(F.col("budget_utilization_pct")),
            "avg_milestone_pct": mean(F.col("milestone_completion_pct")),
            "low_risk": F.count_if(level == "low"),
            "medium_risk": F.count_if(level == "medium"),
            "high_risk": F.count_if(level == "high"),
        },
    )


def over_budget_projects(gold: Tables, above_pct: float = 100.0) -> DataFrame:
    return (
        gold["gold_project_summary"]
        .filter(F.col("budget_utilization_pct") > above_pct)
        .select("project_id", "project_name", "budget_utilization_pct", "total_variance_eur")
    )


def vendors_below(gold: Tables, score: str = "avg_overall_score", below: float = 5.0) -> DataFrame:
    return (
        gold["gold_vendor_scorecard"]
        .filter(F.col(score) < below)
        .select("vendor_id", "vendor_name", "vendor_type", F.col(score).alias("score"))
    )


def average_delay(silver: Tables, project_type: str | None = None) -> DataFrame:
    """Average delay of the complete milestones per project type.

    Delays are added up per project first, so that the join moves one row per project.
    """
    per_project = (
        silver["fact_schedule_milestones"]
        .dropna(subset=["project_id", "delay_days"])
        .groupBy("project_id")
        .agg(F.sum("delay_days").alias("days"), F.count("*").alias("milestones"))
    )
    projects = silver["dim_projects"].select("project_id", "project_type")
    if project_type is not None:
        projects = projects.filter(F.col("project_type") == project_type)
    average = F.try_divide(F.sum("days").cast("double"), F.sum("milestones").cast("double"))
    return (
        per_project.join(projects, "project_id")
        .groupBy("project_type")
        .agg(
            F.sum("milestones").alias("complete_milestones"),
            round_half_up(average, 2).alias("avg_delay_days"),
        )
    )


def risk_distribution(scores: DataFrame) -> DataFrame:
    return frequencies(scores, "risk_level").orderBy("risk_level")
