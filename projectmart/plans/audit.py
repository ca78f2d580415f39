"""Data-quality reports: raw against cleansed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.operators.aggregates import pct
from projectmart.plans.silver import key_report

Tables = Mapping[str, DataFrame]

ENUM_RULES = (
    ("dim_employee", "role", V.ROLES),
    ("dim_projects", "project_type", V.PROJECT_TYPES),
    ("dim_projects", "status", V.PROJECT_STATUSES),
    ("dim_vendors", "vendor_type", V.VENDOR_TYPES),
    ("fact_invoices", "payment_status", V.PAYMENT_STATUSES),
)
NULL_TABLES = ("dim_projects", "fact_invoices", "fact_purchase_orders")


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def audit_keys(bronze: Tables, silver: Tables) -> DataFrame:
    """Rows and key defects of every table before and after cleansing."""
    before = key_report(bronze).withColumnsRenamed(
        {"rows": "bronze_rows", "null_pk": "bronze_null_pk", "dup_pk": "bronze_dup_pk"}
    )
    after = key_report(silver).withColumnsRenamed(
        {"rows": "silver_rows", "null_pk": "silver_null_pk", "dup_pk": "silver_dup_pk"}
    )
    return before.join(after, "table").withColumn(
        "rows_removed", F.col("bronze_rows") - F.col("silver_rows")
    )


def null_profile(df: DataFrame, max_columns: int | None = None) -> DataFrame:
    """Null count per column, or of the first columns, from one pass over the table."""
    columns = df.columns[:max_columns]
    counts = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select("total", F.explode(pairs).alias("p")).select(
        "p.column", "p.null_count", pct(F.col("p.null_count"), F.col("total")).alias("null_pct")
    )


def audit_nulls(layers: Mapping[str, Tables], max_columns: int | None = None) -> DataFrame:
    """Columns with NULL in some tables, per layer."""
    parts = [
        null_profile(tables[table], max_columns).select(
            F.lit(table).alias("table"), F.lit(layer).alias("layer"), "*"
        )
        for table in NULL_TABLES
        for layer, tables in layers.items()
    ]
    return union(parts).filter("null_count > 0").orderBy("table", "column", "layer")


def audit_enums(
    silver: Tables, rules: Sequence[tuple[str, str, Sequence[str]]] = ENUM_RULES
) -> DataFrame:
    """Values outside the valid set per checked column, from one pass over each table."""
    by_table: dict[str, list[tuple[str, Sequence[str]]]] = {}
    for table, column, valid in rules:
        by_table.setdefault(table, []).append((column, valid))
    parts = []
    for table, checks in by_table.items():
        counts = [
            F.struct(
                F.lit(column).alias("column"),
                F.count(column).alias("total_non_null"),
                F.count_if(~F.col(column).isin(*valid) & F.col(column).isNotNull()).alias(
                    "invalid_values"
                ),
            )
            for column, valid in checks
        ]
        parts.append(
            silver[table]
            .agg(F.array(*counts).alias("checks"))
            .select(F.explode("checks").alias("c"))
            .select(F.lit(table).alias("table"), "c.*")
            .withColumn(
                "status", F.when(F.col("invalid_values") == 0, "PASS").otherwise("FAIL")
            )
        )
    return union(parts)


def band(score: Column) -> Column:
    (green_from, green), (amber_from, amber) = V.SCORECARD_BANDS
    return F.when(score >= green_from, green).when(score >= amber_from, amber).otherwise("red")


def dq_scorecard(keys: DataFrame, enums: DataFrame) -> DataFrame:
    """Share of passed checks: two per table, one per checked enumeration."""
    checks = keys.select(
        F.explode(F.array(F.col("silver_null_pk") == 0, F.col("silver_dup_pk") == 0)).alias("ok")
    ).unionByName(enums.select((F.col("status") == "PASS").alias("ok")))
    return (
        checks.agg(F.count_if("ok").alias("passed_checks"), F.count("*").alias("total_checks"))
        .withColumn("score", pct(F.col("passed_checks"), F.col("total_checks"), 1))
        .withColumn("band", band(F.col("score")))
    )
