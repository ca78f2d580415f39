"""Silver tables of the batch path: strict cleansing, columns replaced in place.

Every function takes the raw table and returns the cleansed one. Keys are cleaned first, on the
raw columns, so that only surviving rows are parsed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.functions.dates import parse_date, parse_month
from projectmart.functions.values import (
    as_of_date,
    days_overdue,
    delay_days,
    map_enum,
    matches_flag,
    null_if_before,
    null_outside,
    null_unless_matches,
    over_invoiced,
    parse_bool,
    stamp,
    variance,
    weighted_score,
)
from projectmart.operators.aggregates import key_health
from projectmart.operators.keys import clean_keys, leading
from projectmart.sources.schemas import PRIMARY_KEYS

Order = Sequence[str] | None
Keys = Mapping[str, str]


def dim_employee(raw: DataFrame, *, order_by: Order = None, keys: Keys = V.WIDE_KEYS) -> DataFrame:
    df = clean_keys(raw, "employee_id", order_by)
    return stamp(
        df.select(
            "employee_id",
            "full_name",
            map_enum(F.col("role"), V.ROLES, V.ROLE_VARIANTS).alias("role"),
            map_enum(
                F.col("department"), (*V.DEPARTMENTS, V.UNASSIGNED), V.DEPARTMENT_VARIANTS
            ).alias("department"),
        )
    )


def dim_projects(raw: DataFrame, *, order_by: Order = None, keys: Keys = V.WIDE_KEYS) -> DataFrame:
    df = clean_keys(raw, "project_id", order_by)
    parsed = df.select(
        "project_id",
        "project_name",
        map_enum(F.col("project_type"), V.PROJECT_TYPES, V.PROJECT_TYPE_VARIANTS).alias(
            "project_type"
        ),
        map_enum(
            F.col("municipality"), (), V.MUNICIPALITY_VARIANTS, keep_unmapped=True
        ).alias("municipality"),
        "site_address",
        map_enum(F.col("status"), V.PROJECT_STATUSES, V.PROJECT_STATUS_VARIANTS).alias("status"),
        F.abs("contract_value_eur").alias("contract_value_eur"),
        F.abs("floor_area_m2").alias("floor_area_m2"),
        null_unless_matches(F.col("project_manager_id"), keys["employee_id"]).alias(
            "project_manager_id"
        ),
        null_unless_matches(F.col("client_id"), keys["client_id"]).alias("client_id"),
        parse_date(F.col("start_date")).alias("start_date_dt"),
        parse_date(F.col("planned_end_date")).alias("planned_end_date_dt"),
        parse_date(F.col("actual_end_date")).alias("actual_end_date_dt"),
    )
    running = F.col("status").isin("active", "tendering", "on_hold")
    ended = null_if_before(F.col("actual_end_date_dt"), F.col("start_date_dt"))
    return stamp(
        parsed.withColumn("actual_end_date_dt", F.when(running, F.lit(None)).otherwise(ended))
    )


def dim_vendors(raw: DataFrame, *, order_by: Order = None, keys: Keys = V.WIDE_KEYS) -> DataFrame:
    df = clean_keys(raw, "vendor_id", order_by)
    return stamp(
        df.select(
            "vendor_id",
            "vendor_name",
            map_enum(F.col("vendor_type"), V.VENDOR_TYPES, V.VENDOR_TYPE_VARIANTS).alias(
                "vendor_type"
            ),
            map_enum(F.col("trade_category"), V.TRADES, V.TRADE_VARIANTS).alias("trade_category"),
            "business_id",
            map_enum(F.col("dun_bradstreet_rating"), V.RATINGS).alias("dun_bradstreet_rating"),
            parse_bool(F.col("rala_certified")).alias("rala_certified"),
            map_enum(F.col("approved_status"), V.APPROVALS, V.APPROVAL_VARIANTS).alias(
                "approved_status"
            ),
            matches_flag(F.col("business_id"), V.BUSINESS_ID).alias("business_id_valid"),
        )
    )


def fact_schedule_milestones(
    raw: DataFrame, *, order_by: Order = None, keys: Keys = V.WIDE_KEYS
) -> DataFrame:
    df = clean_keys(raw, "milestone_id", order_by)
    parsed = df.select(
        "milestone_id",
        null_unless_matches(F.col("project_id"), keys["project_id"]).alias("project_id"),
        "milestone_name",
        "takt_zone",
        map_enum(
            F.col("milestone_status"), V.MILESTONE_STATUSES, V.MILESTONE_STATUS_VARIANTS
        ).alias("milestone_status"),
        parse_date(F.col("planned_date")).alias("planned_date_dt"),
        parse_date(F.col("forecast_date")).alias("forecast_date_dt"),
        parse_date(F.col("actual_date")).alias("actual_date_dt"),
    )
    status, actual = F.col("milestone_status"), F.col("actual_date_dt")
    return stamp(
        parsed.withColumns(
            {
                "actual_date_dt": F.when(status == "complete", actual),
                "delay_days": delay_days(status, actual, F.col("planned_date_dt")),
            }
        )
    )


def fact_project_costs(
    raw: DataFrame, *, order_by: Order = None, keys: Keys = V.WIDE_KEYS
) -> DataFrame:
    df = clean_keys(raw, "cost_id", order_by)
    return stamp(
        df.select(
            "cost_id",
            null_unless_matches(F.col("project_id"), keys["project_id"]).alias("project_id"),
            map_enum(F.col("cost_category"), V.COST_CATEGORIES, V.COST_CATEGORY_VARIANTS).alias(
                "cost_category"
            ),
            F.abs("budget_eur").alias("budget_eur"),
            F.abs("committed_eur").alias("committed_eur"),
            F.abs("actual_eur").alias("actual_eur"),
            parse_month(F.col("period_month")).alias("period_month_dt"),
            variance(F.col("budget_eur"), F.col("actual_eur")).alias("variance_eur"),
        )
    )


def fact_purchase_orders(
    raw: DataFrame, *, order_by: Order = None, keys: Keys = V.WIDE_KEYS
) -> DataFrame:
    df = clean_keys(raw, "po_id", order_by)
    return stamp(
        df.select(
            "po_id",
            null_unless_matches(F.col("project_id"), keys["project_id"]).alias("project_id"),
            null_unless_matches(F.col("vendor_id"), keys["vendor_id"]).alias("vendor_id"),
            map_enum(F.col("po_category"), V.PO_CATEGORIES, V.PO_CATEGORY_VARIANTS).alias(
                "po_category"
            ),
            F.abs("po_value_eur").alias("po_value_eur"),
            F.abs("invoiced_eur").alias("invoiced_eur"),
            map_enum(F.col("po_status"), V.PO_STATUSES, V.PO_STATUS_VARIANTS).alias("po_status"),
            parse_date(F.col("po_date")).alias("po_date_dt"),
            over_invoiced(F.col("invoiced_eur"), F.col("po_value_eur")).alias("is_over_invoiced"),
        )
    )


def fact_invoices(
    raw: DataFrame,
    *,
    as_of: str | None = None,
    order_by: Order = None,
    keys: Keys = V.WIDE_KEYS,
) -> DataFrame:
    df = clean_keys(raw, "invoice_id", order_by)
    parsed = df.select(
        "invoice_id",
        null_unless_matches(F.col("po_id"), keys["po_id"]).alias("po_id"),
        null_unless_matches(F.col("vendor_id"), keys["vendor_id"]).alias("vendor_id"),
        F.abs("amount_eur").alias("amount_eur"),
        map_enum(F.col("payment_status"), V.PAYMENT_STATUSES, V.PAYMENT_STATUS_VARIANTS).alias(
            "payment_status"
        ),
        parse_date(F.col("invoice_date")).alias("invoice_date_dt"),
        parse_date(F.col("due_date")).alias("due_date_dt"),
        parse_date(F.col("paid_date")).alias("paid_date_dt"),
    )
    status = F.col("payment_status")
    paid = F.when(status == "paid", F.col("paid_date_dt"))
    return stamp(
        parsed.withColumns(
            {
                "paid_date_dt": null_if_before(paid, F.col("invoice_date_dt")),
                "days_overdue": days_overdue(status, F.col("due_date_dt"), as_of_date(as_of)),
            }
        )
    )


def fact_subcontractor_performance(
    raw: DataFrame, *, order_by: Order = None, keys: Keys = V.WIDE_KEYS
) -> DataFrame:
    df = clean_keys(raw, "perf_id", order_by)
    repaired = df.select(
        "perf_id",
        null_unless_matches(F.col("vendor_id"), keys["vendor_id"]).alias("vendor_id"),
        null_unless_matches(F.col("project_id"), keys["project_id"]).alias("project_id"),
        *[null_outside(F.col(c)).alias(c) for c in V.SCORE_WEIGHTS],
        parse_bool(F.col("would_rehire")).alias("would_rehire"),
        parse_date(F.col("evaluation_date")).alias("evaluation_date_dt"),
    )
    scores = {c: F.col(c) for c in V.SCORE_WEIGHTS}
    return stamp(repaired.withColumn("overall_score", weighted_score(scores)))


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "dim_employee": dim_employee,
    "dim_projects": dim_projects,
    "dim_vendors": dim_vendors,
    "fact_schedule_milestones": fact_schedule_milestones,
    "fact_project_costs": fact_project_costs,
    "fact_purchase_orders": fact_purchase_orders,
    "fact_invoices": fact_invoices,
    "fact_subcontractor_performance": fact_subcontractor_performance,
}


# Raw columns that a silver column follows from, where it is not the one of its name.
ORIGINS: dict[str, dict[str, tuple[str, ...]]] = {
    "dim_projects": {
        "start_date_dt": ("start_date",),
        "planned_end_date_dt": ("planned_end_date",),
        "actual_end_date_dt": ("status", "start_date", "actual_end_date"),
    },
    "dim_vendors": {"business_id_valid": ("business_id",)},
    "fact_schedule_milestones": {
        "planned_date_dt": ("planned_date",),
        "forecast_date_dt": ("forecast_date",),
        "actual_date_dt": ("actual_date", "milestone_status"),
        "delay_days": ("planned_date", "actual_date", "milestone_status"),
    },
    "fact_project_costs": {
        "period_month_dt": ("period_month",),
        "variance_eur": ("budget_eur", "actual_eur"),
    },
    "fact_purchase_orders": {
        "po_date_dt": ("po_date",),
        "is_over_invoiced": ("po_value_eur", "invoiced_eur"),
    },
    "fact_invoices": {
        "invoice_date_dt": ("invoice_date",),
        "due_date_dt": ("due_date",),
        "paid_date_dt": ("invoice_date", "paid_date", "payment_status"),
        "days_overdue": ("due_date", "payment_status"),
    },
    "fact_subcontractor_performance": {
        "evaluation_date_dt": ("evaluation_date",),
        "overall_score": tuple(V.SCORE_WEIGHTS),
    },
}


def silver_table(
    table: str,
    raw: DataFrame,
    *,
    as_of: str | None = None,
    order_by: Order = None,
    keys: Keys = V.WIDE_KEYS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One cleansed table, or those ``columns`` of it that are read, of the same rows."""
    dated = {"as_of": as_of} if table == "fact_invoices" else {}
    if columns is not None and order_by is None:
        origins = ORIGINS.get(table, {})
        read = {name for column in columns for name in origins.get(column, (column,))}
        raw = leading(raw, PRIMARY_KEYS[table], read)
    clean = BUILDERS[table](raw, order_by=order_by, keys=keys, **dated)
    return clean if columns is None else clean.select(*columns)


def silver_tables(
    raw: Mapping[str, DataFrame],
    *,
    as_of: str | None = None,
    order_by: Order = None,
    keys: Keys = V.WIDE_KEYS,
) -> dict[str, DataFrame]:
    return {
        table: silver_table(table, raw[table], as_of=as_of, order_by=order_by, keys=keys)
        for table in BUILDERS
    }


def key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, rows without key and repeated keys of every table, as one plan."""
    parts = [
        key_health(df, PRIMARY_KEYS[table]).select(F.lit(table).alias("table"), "*")
        for table, df in tables.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
