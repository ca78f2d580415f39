"""Features per project and the overrun label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.functions.values import fill_numeric, round_half_up, stamp
from projectmart.operators.aggregates import (
    frequencies,
    mean,
    money_sum,
    money_total,
    n_values,
    pct,
    ratio,
)
from projectmart.operators.joins import star

LABEL = "is_over_budget"


def overrun_label(actual: Column, budget: Column, threshold: str = V.OVERRUN_RATIO) -> Column:
    """1 when actual exceeds budget times the threshold, compared in decimal."""
    bound = budget.cast("decimal(30,4)") * F.lit(threshold).cast("decimal(4,2)")
    return F.when(actual.cast("decimal(30,4)") > bound, 1).otherwise(0)


def cost_features(costs: DataFrame) -> DataFrame:
    totals = costs.groupBy("project_id").agg(
        money_total(F.col("budget_eur")).alias("_budget"),
        money_total(F.col("actual_eur")).alias("_actual"),
        money_sum(F.col("committed_eur")).alias("total_committed"),
        money_sum(F.col("variance_eur")).alias("total_variance"),
        F.count("*").alias("cost_line_count"),
        n_values(F.col("cost_category")).alias("distinct_cost_categories"),
        F.count_if(F.col("variance_eur") < 0).alias("overrun_line_count"),
    )
    return totals.select(
        "project_id",
        F.col("_budget").cast("double").alias("total_budget"),
        F.col("_actual").cast("double").alias("total_actual"),
        "total_committed",
        "total_variance",
        "cost_line_count",
        "distinct_cost_categories",
        "overrun_line_count",
        pct(F.col("_actual"), F.col("_budget")).alias("budget_utilization_pct"),
        ratio(F.col("total_committed"), F.col("_budget")).alias("committed_ratio"),
        pct(F.col("overrun_line_count"), F.col("cost_line_count")).alias("overrun_line_pct"),
        overrun_label(F.col("_actual"), F.col("_budget")).alias(LABEL),
    )


def schedule_features(milestones: DataFrame) -> DataFrame:
    status = F.col("milestone_status")
    return (
        milestones.groupBy("project_id")
        .agg(
            F.count("*").alias("total_milestones"),
            F.count_if(status == "complete").alias("completed_ms"),
            F.count_if(status == "delayed").alias("delayed_ms"),
            round_half_up(F.avg("delay_days"), 2).alias("avg_delay_days"),
            F.max("delay_days").alias("max_delay_days"),
            n_values(F.col("takt_zone")).alias("distinct_takt_zones"),
        )
        .withColumns(
            {
                "ms_completion_rate": ratio(F.col("completed_ms"), F.col("total_milestones")),
                "ms_delay_rate": ratio(F.col("delayed_ms"), F.col("total_milestones")),
            }
        )
    )


def vendor_features(evaluations: DataFrame) -> DataFrame:
    return evaluations.groupBy("project_id").agg(
        round_half_up(mean(F.col("overall_score")), 2).alias("avg_vendor_score"),
        round_half_up(F.min("overall_score"), 2).alias("min_vendor_score"),
        n_values(F.col("vendor_id")).alias("distinct_vendors"),
        F.count_if(~F.col("would_rehire")).alias("no_rehire_count"),
    )


def po_features(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("project_id")
        .agg(
            money_sum(F.col("po_value_eur")).alias("total_po_value"),
            money_sum(F.col("invoiced_eur")).alias("total_invoiced_from_po"),
            F.count("*").alias("total_pos"),
            F.count_if("is_over_invoiced").alias("over_invoiced_pos"),
            n_values(F.col("vendor_id")).alias("distinct_po_vendors"),
        )
        .withColumn("over_invoice_rate", ratio(F.col("over_invoiced_pos"), F.col("total_pos")))
    )


def project_features(projects: DataFrame) -> DataFrame:
    return projects.select(
        "project_id",
        "project_type",
        "municipality",
        "status",
        "contract_value_eur",
        "floor_area_m2",
        F.datediff("planned_end_date_dt", "start_date_dt").alias("planned_duration_days"),
    )


# The silver columns that the feature table reads.
READS = {
    "dim_projects": (
        "project_id", "project_type", "municipality", "status", "contract_value_eur", "floor_area_m2",
        "start_date_dt", "planned_end_date_dt",
    ),
    "fact_project_costs": (
        "project_id", "cost_category", "budget_eur", "committed_eur", "actual_eur", "variance_eur",
    ),
    "fact_schedule_milestones": ("project_id", "takt_zone", "milestone_status", "delay_days"),
    "fact_subcontractor_performance": ("project_id", "vendor_id", "overall_score", "would_rehire"),
    "fact_purchase_orders": (
        "project_id", "vendor_id", "po_value_eur", "invoiced_eur", "is_over_invoiced",
    ),
}


def feature_table(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Projects with cost lines, their features (NULL numbers as 0) and the label."""
    parts = [
        (cost_features(silver["fact_project_costs"]), "project_id", "inner"),
        (schedule_features(silver["fact_schedule_milestones"]), "project_id", "left"),
        (vendor_features(silver["fact_subcontractor_performance"]), "project_id", "left"),
        (po_features(silver["fact_purchase_orders"]), "project_id", "left"),
    ]
    joined = star(project_features(silver["dim_projects"]), parts)
    return stamp(fill_numeric(joined, exclude=[LABEL]))


def label_distribution(features: DataFrame) -> DataFrame:
    return frequencies(features, LABEL)
