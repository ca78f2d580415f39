"""Schemas of the raw tables, their keys, and the table registry."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType()}


def _schema(columns: str) -> T.StructType:
    fields = [column.split(":") for column in columns.split()]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


RAW_SCHEMAS = {
    "dim_employee": _schema("employee_id:s full_name:s role:s department:s"),
    "dim_projects": _schema(
        "project_id:s project_name:s project_type:s municipality:s site_address:s status:s"
        " start_date:s planned_end_date:s actual_end_date:s contract_value_eur:d floor_area_m2:d"
        " project_manager_id:s client_id:s"
    ),
    "dim_vendors": _schema(
        "vendor_id:s vendor_name:s vendor_type:s trade_category:s business_id:s"
        " dun_bradstreet_rating:s rala_certified:s approved_status:s"
    ),
    "fact_schedule_milestones": _schema(
        "milestone_id:s project_id:s milestone_name:s takt_zone:s planned_date:s forecast_date:s"
        " actual_date:s delay_days:i milestone_status:s"
    ),
    "fact_project_costs": _schema(
        "cost_id:s project_id:s cost_category:s budget_eur:d committed_eur:d actual_eur:d"
        " variance_eur:d period_month:s"
    ),
    "fact_purchase_orders": _schema(
        "po_id:s project_id:s vendor_id:s po_date:s po_category:s po_value_eur:d invoiced_eur:d"
        " po_status:s"
    ),
    "fact_invoices": _schema(
        "invoice_id:s po_id:s vendor_id:s invoice_date:s due_date:s paid_date:s amount_eur:d"
        " payment_status:s days_overdue:i"
    ),
    "fact_subcontractor_performance": _schema(
        "perf_id:s vendor_id:s project_id:s evaluation_date:s quality_score:i schedule_score:i"
        " safety_score:i communication_score:i overall_score:d would_rehire:s"
    ),
}

CORE_TABLES = tuple(RAW_SCHEMAS)
PRIMARY_KEYS = {table: schema.fieldNames()[0] for table, schema in RAW_SCHEMAS.items()}

MARTS = (
    "gold_cost_variance_monthly",
    "gold_schedule_kpi",
    "gold_vendor_scorecard",
    "gold_invoice_aging",
    "gold_project_summary",
    "gold_employee_purchase_summary",
)
ML_TABLES = ("ml_feature_table", "ml_project_risk_scores")
RUN_METADATA = "run_metadata"
# Tables that a run writes beside those of the registry.
REPORTS = (
    "audit_keys", "audit_nulls", "audit_enums", "audit_scorecard", "ml_test_predictions",
    "ml_classification_report", "ml_feature_importance", RUN_METADATA,
)

REGISTRY = {
    "bronze": CORE_TABLES,
    "silver": CORE_TABLES,
    "gold": (*MARTS, *ML_TABLES),
}

# Tables whose existence and content the validation suite checks.
VALIDATED = {
    "bronze": CORE_TABLES,
    "silver": CORE_TABLES,
    "gold": (*MARTS[:5], *ML_TABLES),
}
