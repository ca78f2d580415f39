"""Silver tables and gold marts of the declarative path.

Raw columns stay and cleaned ones are added; enumerations are only folded; rows that break an
expectation are dropped. The results differ from the batch path on purpose.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.functions.dates import parse_date, parse_dates, parse_month, year_month
from projectmart.functions.dates import strip_date_suffix
from projectmart.functions.values import (
    aging_bucket,
    as_of_date,
    fold,
    matches_flag,
    null_outside,
    over_invoiced,
    parse_bool,
    round_half_up,
    stamp,
    variance,
    weighted_score,
)
from projectmart.operators.aggregates import avg_if, hundredths, mean, money_sum
from projectmart.operators.expect import expect, expect_or_drop, violations
from projectmart.operators.joins import enrich
from projectmart.operators.keys import first_per_key, leading, least_per_key
from projectmart.plans.gold import purchases_by_manager
from projectmart.sources.schemas import PRIMARY_KEYS

Tables = Mapping[str, DataFrame]


def required_rules() -> dict[str, dict[str, Column]]:
    """Expectations whose violation drops the row."""

    def known(column: str) -> Column:
        return F.col(column).isNotNull()

    return {
        "dim_employee": {
            "valid_employee_id": known("employee_id"),
            "valid_full_name": known("full_name"),
            "no_empty_role": F.length(F.trim(F.col("role"))) > 0,
        },
        "dim_projects": {
            "valid_project_id": known("project_id"),
            "positive_contract_val": F.col("contract_value_eur") >= 0,
            "positive_floor_area": F.col("floor_area_m2") >= 0,
        },
        "dim_vendors": {"valid_vendor_id": known("vendor_id")},
        "fact_schedule_milestones": {"valid_milestone_id": known("milestone_id")},
        "fact_project_costs": {
            "valid_cost_id": known("cost_id"),
            "positive_budget": F.abs("budget_eur") >= 0,
        },
        "fact_purchase_orders": {
            "valid_po_id": known("po_id"),
            "positive_po_value": F.abs("po_value_eur") >= 0,
        },
        "fact_invoices": {
            "valid_invoice_id": known("invoice_id"),
            "positive_amount": F.abs("amount_eur") >= 0,
        },
        "fact_subcontractor_performance": {"valid_perf_id": known("perf_id")},
    }


# Raw columns that the expectations read beside the key.
CHECKED = {
    "dim_employee": ("full_name", "role"),
    "dim_projects": ("contract_value_eur", "floor_area_m2"),
    "dim_vendors": (),
    "fact_schedule_milestones": (),
    "fact_project_costs": ("budget_eur",),
    "fact_purchase_orders": ("po_value_eur",),
    "fact_invoices": ("amount_eur",),
    "fact_subcontractor_performance": (),
}
WARNED = {"fact_subcontractor_performance": ("quality_score", "safety_score")}


def warning_rules() -> dict[str, dict[str, Column]]:
    """Expectations that are only counted."""

    def in_range(column: str) -> Column:
        score = F.col(column)
        return score.between(V.SCORE_MIN, V.SCORE_MAX) | score.isNull()

    return {
        "fact_subcontractor_performance": {
            "quality_in_range": in_range("quality_score_clean"),
            "safety_in_range": in_range("safety_score_clean"),
        }
    }


def _dates(df: DataFrame, *columns: str) -> DataFrame:
    return parse_dates(df, *columns, formats=V.THREE_FORMATS, rename=strip_date_suffix)


def _folded(*columns: str) -> dict[str, Column]:
    return {f"{c}_clean": fold(F.col(c)) for c in columns}


def _dim_employee(df: DataFrame) -> DataFrame:
    return df.withColumns(_folded("role", "department"))


def _dim_projects(df: DataFrame) -> DataFrame:
    return _dates(df, "start_date", "planned_end_date", "actual_end_date").withColumns(
        {
            "contract_value_eur_clean": F.abs("contract_value_eur"),
            "floor_area_m2_clean": F.abs("floor_area_m2"),
            **_folded("project_type", "status"),
        }
    )


def _dim_vendors(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "rala_certified_bool": parse_bool(F.col("rala_certified")),
            "business_id_valid": matches_flag(F.col("business_id"), V.BUSINESS_ID),
            **_folded("vendor_type", "trade_category", "approved_status"),
        }
    )


def _fact_schedule_milestones(df: DataFrame) -> DataFrame:
    return _dates(df, "planned_date", "forecast_date", "actual_date").withColumn(
        "status_clean", fold(F.col("milestone_status"))
    )


def _fact_project_costs(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "budget_eur_clean": F.abs("budget_eur"),
            "actual_eur_clean": F.abs("actual_eur"),
            "variance_eur_corrected": variance(F.col("budget_eur"), F.col("actual_eur")),
            "period_month_dt": parse_month(F.col("period_month"), V.MONTH_FORMATS_SHORT),
            **_folded("cost_category"),
        }
    )


def _fact_purchase_orders(df: DataFrame) -> DataFrame:
    return _dates(df, "po_date").withColumns(
        {
            "po_value_eur_clean": F.abs("po_value_eur"),
            "invoiced_eur_clean": F.abs("invoiced_eur"),
            "is_over_invoiced": over_invoiced(F.col("invoiced_eur"), F.col("po_value_eur")),
            **_folded("po_category", "po_status"),
        }
    )


def _fact_invoices(df: DataFrame) -> DataFrame:
    return _dates(df, "invoice_date", "due_date", "paid_date").withColumns(
        {"amount_eur_clean": F.abs("amount_eur"), **_folded("payment_status")}
    )


def _fact_subcontractor_performance(df: DataFrame) -> DataFrame:
    cleaned = df.withColumns(
        {
            **{f"{c}_clean": null_outside(F.col(c)) for c in V.SCORE_WEIGHTS},
            "would_rehire_bool": parse_bool(F.col("would_rehire")),
            "evaluation_dt": parse_date(F.col("evaluation_date"), V.THREE_FORMATS),
        }
    )
    scores = {c: F.col(f"{c}_clean") for c in V.SCORE_WEIGHTS}
    return cleaned.withColumn("overall_score_corrected", weighted_score(scores))


_CLEANERS = {
    "dim_employee": _dim_employee,
    "dim_projects": _dim_projects,
    "dim_vendors": _dim_vendors,
    "fact_schedule_milestones": _fact_schedule_milestones,
    "fact_project_costs": _fact_project_costs,
    "fact_purchase_orders": _fact_purchase_orders,
    "fact_invoices": _fact_invoices,
    "fact_subcontractor_performance": _fact_subcontractor_performance,
}


def cleaned_table(
    table: str,
    raw: DataFrame,
    order_by: Sequence[str] | None = None,
    placed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per key with the cleaned columns, before the expectations.

    Of the rows without key one remains and breaks the key expectation; ``silver_table`` drops
    them all before. ``placed`` moves the rows to where they are written, before they get the columns
    that follow from others.
    """
    rows = first_per_key(raw, [PRIMARY_KEYS[table]], order_by)
    return stamp(_CLEANERS[table](placed(rows) if placed else rows))


def silver_table(
    table: str,
    raw: DataFrame,
    *,
    order_by: Sequence[str] | None = None,
    observed: Mapping[str, Observation] | None = None,
    placed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The cleaned table without the rows that break a required expectation.

    Rows without key are counted and dropped before the rows of a key are compared, so that they
    reach no shuffle; the other rules hold for the deduplicated rows. ``observed`` has the
    observations of ``observations``.
    """
    observed = observed or {}
    (key_rule, known), *others = required_rules()[table].items()
    keyed = expect_or_drop(raw, {key_rule: known}, observation=observed.get("keys"))
    cleaned = cleaned_table(table, keyed, order_by, placed)
    warned = expect(
        cleaned, warning_rules().get(table, {}), observation=observed.get("warnings")
    )
    return expect_or_drop(warned, dict(others), observation=observed.get("rules"))


def observations(table: str) -> dict[str, Observation]:
    """An observation for each kind of count that writing the table yields."""
    kinds = ["keys", "rules", *(["warnings"] if table in warning_rules() else [])]
    return {kind: Observation() for kind in kinds}


def observed_counts(observed: Mapping[str, Observation]) -> dict[str, int]:
    """Violations per rule, and the deduplicated rows that the rules were checked on."""
    keys, rules = observed["keys"].get, observed["rules"].get
    counts = {rule: n for rule, n in keys.items() if rule != "rows"} | rules
    if "warnings" in observed:
        counts |= {r: n for r, n in observed["warnings"].get.items() if r != "rows"}
    return counts


def silver_tables(raw: Tables) -> dict[str, DataFrame]:
    return {table: silver_table(table, raw[table]) for table in _CLEANERS}


def expectation_report(
    raw: Tables,
    rules: Mapping[str, Mapping[str, Column]],
    reads: Mapping[str, Collection[str]] | None = None,
) -> DataFrame:
    """Violations per table and rule, counted on the deduplicated rows, one pass per table.

    ``reads`` has the raw columns that the rules of a table read beside its key, where they are known.
    """
    reads = reads or {}

    def rows(table: str) -> DataFrame:
        key, read = PRIMARY_KEYS[table], reads.get(table)
        known = raw[table] if read is None else leading(raw[table], key, read)
        return _CLEANERS[table](least_per_key(known, key))

    parts = [
        violations(rows(table), rules[table]).select(
            F.lit(table).alias("table"), "*"
        )
        for table in rules
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def cost_variance_monthly(silver: Tables, *, as_of: str | None = None) -> DataFrame:
    monthly = (
        silver["fact_project_costs"]
        .groupBy(
            "project_id",
            F.col("cost_category_clean").alias("cost_category"),
            year_month(F.col("period_month_dt")).alias("period_year_month"),
        )
        .agg(
            money_sum(F.col("budget_eur_clean")).alias("total_budget_eur"),
            money_sum(F.col("actual_eur_clean")).alias("total_actual_eur"),
            money_sum(F.col("variance_eur_corrected")).alias("total_variance_eur"),
        )
        .withColumn(
            "budget_utilization_pct", hundredths(F.col("total_actual_eur"), F.col("total_budget_eur"))
        )
    )
    return enrich(
        monthly, silver["dim_projects"], "project_id", ("project_name", "project_type_clean")
    ).withColumnRenamed("project_type_clean", "project_type")


def schedule_kpi(silver: Tables, *, as_of: str | None = None) -> DataFrame:
    status = F.col("status_clean")
    delay = F.datediff(F.col("actual_dt"), F.col("planned_dt"))
    zones = (
        silver["fact_schedule_milestones"]
        .groupBy("project_id", "takt_zone")
        .agg(
            F.count("*").alias("total_milestones"),
            F.count_if(status == "complete").alias("completed_milestones"),
            F.count_if(status == "delayed").alias("delayed_milestones"),
            round_half_up(avg_if(status == "complete", delay), 1).alias("avg_delay_days"),
        )
        .withColumn(
            "completion_rate_pct",
            hundredths(F.col("completed_milestones"), F.col("total_milestones")),
        )
    )
    return enrich(zones, silver["dim_projects"], "project_id", ("project_name",))


def vendor_scorecard(silver: Tables, *, as_of: str | None = None) -> DataFrame:
    """Every vendor with its average scores; 0 evaluations when there are none."""
    scores = {
        "avg_overall_score": "overall_score_corrected",
        "avg_quality_score": "quality_score_clean",
        "avg_safety_score": "safety_score_clean",
    }
    evaluations = (
        silver["fact_subcontractor_performance"]
        .groupBy("vendor_id")
        .agg(
            *[round_half_up(mean(F.col(c)), 2).alias(name) for name, c in scores.items()],
            F.count("perf_id").alias("evaluation_count"),
            hundredths(F.count_if("would_rehire_bool"), F.count("perf_id")).alias("rehire_rate_pct"),
        )
    )
    named = silver["dim_vendors"].select(
        "vendor_id",
        "vendor_name",
        F.col("vendor_type_clean").alias("vendor_type"),
        F.col("trade_category_clean").alias("trade_category"),
    )
    return named.join(evaluations, "vendor_id", "left").withColumn(
        "evaluation_count", F.coalesce("evaluation_count", F.lit(0))
    )


def invoice_aging(silver: Tables, *, as_of: str | None = None) -> DataFrame:
    """All invoices by days past due, also paid ones; an unknown due date is in the last bucket."""
    late = F.datediff(as_of_date(as_of), F.col("due_dt"))
    aged = (
        silver["fact_invoices"]
        .groupBy(
            "vendor_id",
            F.col("payment_status_clean").alias("payment_status"),
            aging_bucket(late).alias("aging_bucket"),
        )
        .agg(
            F.count("*").alias("invoice_count"),
            money_sum(F.col("amount_eur_clean")).alias("total_amount_eur"),
        )
    )
    return enrich(aged, silver["dim_vendors"], "vendor_id", ("vendor_name",))


def employee_purchase_summary(silver: Tables, *, as_of: str | None = None) -> DataFrame:
    return purchases_by_manager(
        silver["dim_employee"],
        silver["dim_projects"],
        silver["fact_purchase_orders"],
        attributes=("full_name", "role_clean", "department_clean"),
        value="po_value_eur_clean",
        invoiced="invoiced_eur_clean",
    )


# Every mart: the silver tables it reads, and how it is built.
GOLD: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "gold_cost_variance_monthly": (("fact_project_costs", "dim_projects"), cost_variance_monthly),
    "gold_schedule_kpi": (("fact_schedule_milestones", "dim_projects"), schedule_kpi),
    "gold_vendor_scorecard": (
        ("dim_vendors", "fact_subcontractor_performance"), vendor_scorecard,
    ),
    "gold_invoice_aging": (("fact_invoices", "dim_vendors"), invoice_aging),
    "gold_employee_purchase_summary": (
        ("dim_employee", "dim_projects", "fact_purchase_orders"), employee_purchase_summary,
    ),
}


def gold_marts(silver: Tables, *, as_of: str | None = None) -> dict[str, DataFrame]:
    return {mart: build(silver, as_of=as_of) for mart, (_, build) in GOLD.items()}
