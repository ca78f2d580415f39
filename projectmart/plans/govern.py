"""Comments and classification of the stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from projectmart.sources.tables import Layers

TABLE_COMMENTS = {
    "silver": {
        "dim_employee": "Employees with standard roles and departments; one row per key.",
        "dim_projects": "Projects with parsed dates, standard enums and checked references.",
        "dim_vendors": "Vendors with parsed flags, checked business ids and standard enums.",
        "fact_schedule_milestones": "Milestones with recalculated delays and standard status.",
        "fact_project_costs": "Cost lines with positive amounts and recalculated variance.",
        "fact_purchase_orders": "Purchase orders with the over-invoicing flag.",
        "fact_invoices": "Invoices with recalculated days overdue and repaired paid dates.",
        "fact_subcontractor_performance": "Evaluations with scores from 1 to 10, recalculated.",
    },
    "gold": {
        "gold_cost_variance_monthly": "Budget, actual and variance by project, category, month.",
        "gold_schedule_kpi": "Completion and delay of milestones by project and takt zone.",
        "gold_vendor_scorecard": "Scores, invoices and orders per vendor.",
        "gold_invoice_aging": "Invoices by vendor, payment status and days overdue.",
        "gold_project_summary": "Cost, schedule, purchasing and risk level per project.",
        "gold_employee_purchase_summary": "Orders of the projects that an employee manages.",
    },
}
COLUMN_COMMENTS = {
    "gold_project_summary": {
        "project_id": "Project key, FRA-year-number.",
        "budget_utilization_pct": "Actual over budget in percent; above 100 is an overrun.",
        "milestone_completion_pct": "Complete milestones in percent of all.",
        "risk_score": "Points for overrun, late milestones, over-invoiced orders and delay.",
        "risk_level": "low up to 20 points, medium up to 50, else high.",
    },
    "gold_vendor_scorecard": {
        "avg_overall_score": "Weighted mean of the four scores, 1 to 10.",
        "rehire_rate_pct": "Evaluations that recommend the vendor, in percent.",
    },
}
COLUMN_TAGS = {
    ("silver", "dim_employee"): {"full_name": {"pii": "name"}},
    ("silver", "dim_vendors"): {"business_id": {"pii": "business_id", "sensitivity": "high"}},
    ("silver", "dim_projects"): {
        "site_address": {"pii": "address"},
        "contract_value_eur": {"sensitivity": "high", "domain": "finance"},
    },
    ("silver", "fact_invoices"): {"amount_eur": {"sensitivity": "high", "domain": "finance"}},
    ("silver", "fact_project_costs"): {"budget_eur": {"sensitivity": "high", "domain": "finance"}},
}
TABLE_TAGS = {
    ("gold", "gold_project_summary"): {
        "domain": "construction", "layer": "gold", "refresh": "daily",
    },
    ("gold", "gold_vendor_scorecard"): {
        "domain": "procurement", "layer": "gold", "refresh": "daily",
    },
}


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def comment_table(spark: SparkSession, name: str, text: str) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(text)}")


def comment_columns(spark: SparkSession, name: str, comments: Mapping[str, str]) -> None:
    for column, text in comments.items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT {_quoted(text)}")


def classify(
    spark: SparkSession,
    name: str,
    columns: Mapping[str, Mapping[str, str]] | None = None,
    table: Mapping[str, str] | None = None,
) -> None:
    """Keep tags as table properties: ``tag.<tag>`` and ``tag.<column>.<tag>``."""
    tags = {f"tag.{tag}": value for tag, value in (table or {}).items()}
    for column, values in (columns or {}).items():
        tags.update({f"tag.{column}.{tag}": value for tag, value in values.items()})
    listed = ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in tags.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def apply_governance(spark: SparkSession, layers: Layers) -> None:
    """Comments and tags on every table that exists."""

    def present(layer: str, table: str) -> bool:
        return spark.catalog.tableExists(layers.name(layer, table))

    for layer, comments in TABLE_COMMENTS.items():
        for table, text in comments.items():
            if present(layer, table):
                comment_table(spark, layers.name(layer, table), text)
    for table, columns in COLUMN_COMMENTS.items():
        if present("gold", table):
            comment_columns(spark, layers.name("gold", table), columns)
    for (layer, table), columns in COLUMN_TAGS.items():
        if present(layer, table):
            classify(spark, layers.name(layer, table), columns)
    for (layer, table), tags in TABLE_TAGS.items():
        if present(layer, table):
            classify(spark, layers.name(layer, table), table=tags)


def _tables(spark: SparkSession, layers: Layers, layer: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(layers.schema(layer)) if not t.isTemporary)


def comment_report(spark: SparkSession, layers: Layers, layer: str) -> DataFrame:
    """Comment of every table of a layer. Reads the catalog only."""
    described = {t.name: t.description for t in spark.catalog.listTables(layers.schema(layer))}
    rows = [
        (layer, table, described[table] or "(no comment)")
        for table in _tables(spark, layers, layer)
    ]
    return spark.createDataFrame(rows, "layer string, table string, comment string")


def column_comment_report(spark: SparkSession, layers: Layers, layer: str) -> DataFrame:
    rows = [
        (table, column.name, column.description)
        for table in _tables(spark, layers, layer)
        for column in spark.catalog.listColumns(layers.name(layer, table))
        if column.description
    ]
    return spark.createDataFrame(rows, "table string, column string, comment string")


def tag_report(spark: SparkSession, layers: Layers, layer: str) -> DataFrame:
    """Tags of a layer's tables; ``column`` is NULL for a tag of the table itself."""
    parts = [
        spark.sql(f"SHOW TBLPROPERTIES {layers.name(layer, table)}").select(
            F.lit(table).alias("table"), "key", "value"
        )
        for table in _tables(spark, layers, layer)
    ]
    properties = parts[0]
    for part in parts[1:]:
        properties = properties.unionByName(part)
    pieces = F.split("key", r"\.")
    return properties.filter(F.col("key").startswith("tag.")).select(
        "table",
        F.when(F.size(pieces) == 3, F.get(pieces, 1)).alias("column"),
        F.element_at(pieces, -1).alias("tag"),
        "value",
    )
