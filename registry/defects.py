"""Defects of the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import core as O
from projectmart.functions import fixed_values as V
from projectmart.functions.dates import parse_date
from projectmart.functions.values import map_enum, variance, weighted_score
from projectmart.operators.aggregates import money_sum
from projectmart.operators.keys import clean_keys
from projectmart.plans.silver import key_report
from projectmart.sources.schemas import PRIMARY_KEYS
from registry.base import Tables, query, union, values, values_sql
from registry.cleansing import DATES, ENUM_COLUMNS, FLAGS, MONTHS, REFERENCES, SCORES
from registry.layers import key_report_sql


def _raw_values(name: str, columns) -> None:
    @query(name, values_sql("b_", columns))
    def _(t: Tables):
        return values(t.raw, columns)


NULLED = {
    **{table: (pk,) for table, pk in PRIMARY_KEYS.items()},
    "dim_employee": ("employee_id", "full_name"),
    "dim_projects": ("project_id", "project_name", "site_address", "contract_value_eur"),
    "fact_schedule_milestones": ("milestone_id", "takt_zone"),
}


@query(
    "df_1_null_values",
    " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) AS n FROM b_{table}"
        f" WHERE {c} IS NULL"
        for table, columns in NULLED.items()
        for c in columns
    ),
)
def _(t: Tables):
    return union(
        [
            t.raw[table]
            .agg(F.count_if(F.col(c).isNull()).alias("n"))
            .select(F.lit(table).alias("table"), F.lit(c).alias("column"), "n")
            for table, columns in NULLED.items()
            for c in columns
        ]
    )


_raw_values("df_2_enum_variants", ENUM_COLUMNS)
_raw_values("df_3_date_formats", DATES)
_raw_values("df_4_month_formats", MONTHS)

AMOUNTS = {
    "dim_projects": ("contract_value_eur", "floor_area_m2"),
    "fact_project_costs": ("budget_eur", "committed_eur", "actual_eur"),
    "fact_purchase_orders": ("po_value_eur", "invoiced_eur"),
    "fact_invoices": ("amount_eur",),
}


@query(
    "df_5_negative_amounts",
    " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) AS n, {O.msum(c)} AS total"
        f" FROM b_{table} WHERE {c} < 0"
        for table, columns in AMOUNTS.items()
        for c in columns
    ),
)
def _(t: Tables):
    return union(
        [
            t.raw[table]
            .filter(F.col(c) < 0)
            .agg(F.count("*").alias("n"), money_sum(F.col(c)).alias("total"))
            .select(F.lit(table).alias("table"), F.lit(c).alias("column"), "n", "total")
            for table, columns in AMOUNTS.items()
            for c in columns
        ]
    )


@query(
    "df_6_invalid_references",
    " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", {c} AS raw, count(*) AS n"
        f" FROM b_{table} WHERE NOT coalesce(regexp_matches({c}, '{V.WIDE_KEYS[kind]}'), FALSE)"
        f" GROUP BY {c}"
        for (table, c), kind in REFERENCES.items()
    ),
)
def _(t: Tables):
    return union(
        [
            values(
                {
                    table: t.raw[table].filter(
                        ~F.coalesce(F.col(c).rlike(V.WIDE_KEYS[kind]), F.lit(False))
                    )
                },
                {table: (c,)},
            )
            for (table, c), kind in REFERENCES.items()
        ]
    )


DUPLICATED = ("dim_employee", "dim_projects", "dim_vendors", "fact_purchase_orders")


@query(
    "df_7_duplicates",
    f"SELECT * FROM ({key_report_sql('b_')}) WHERE \"table\" IN ({O.in_list(DUPLICATED)})",
)
def _(t: Tables):
    return key_report({table: t.raw[table] for table in DUPLICATED})


_raw_values("df_8_scores", SCORES)
_raw_values("df_9_flags", FLAGS)


@query(
    "df_10_wrong_derived",
    "SELECT 'variance' AS kind, count(*) AS n FROM b_fact_project_costs"
    f" WHERE variance_eur <> {O.variance('budget_eur', 'actual_eur')}"
    " UNION ALL SELECT 'overdue', count(*) FROM b_fact_invoices WHERE days_overdue = 999"
    " UNION ALL SELECT 'overall', count(*) FROM b_fact_subcontractor_performance"
    f" WHERE overall_score <> {O.score(*V.SCORE_WEIGHTS)}",
)
def _(t: Tables):
    expected = variance(F.col("budget_eur"), F.col("actual_eur"))
    overall = weighted_score({c: F.col(c) for c in V.SCORE_WEIGHTS})
    wrong = {
        "variance": t.raw["fact_project_costs"].filter(F.col("variance_eur") != expected),
        "overdue": t.raw["fact_invoices"].filter("days_overdue = 999"),
        "overall": t.raw["fact_subcontractor_performance"].filter(
            F.col("overall_score") != overall
        ),
    }
    return union(
        [
            df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
            for kind, df in wrong.items()
        ]
    )


@query(
    "df_11_illogical_dates",
    "SELECT 'ended before start' AS kind, count(*) AS n FROM s_projects_parsed"
    " WHERE ended < start_date_dt"
    " UNION ALL SELECT 'ended while running', count(*) FROM s_projects_parsed"
    " WHERE status IN ('active', 'tendering', 'on_hold') AND ended IS NOT NULL"
    " UNION ALL SELECT 'paid before invoice', count(*) FROM s_invoices_parsed"
    " WHERE paid < invoice_date_dt"
    " UNION ALL SELECT 'done but open', count(*) FROM s_milestones_parsed"
    " WHERE milestone_status <> 'complete' AND done IS NOT NULL",
)
def _(t: Tables):
    projects = clean_keys(t.raw["dim_projects"], "project_id")
    status = map_enum(F.col("status"), V.PROJECT_STATUSES, V.PROJECT_STATUS_VARIANTS)
    ended = parse_date(F.col("actual_end_date"))
    milestones = clean_keys(t.raw["fact_schedule_milestones"], "milestone_id")
    progress = map_enum(
        F.col("milestone_status"), V.MILESTONE_STATUSES, V.MILESTONE_STATUS_VARIANTS
    )
    invoices = clean_keys(t.raw["fact_invoices"], "invoice_id")
    paid, invoiced = parse_date(F.col("paid_date")), parse_date(F.col("invoice_date"))
    found = {
        "ended before start": projects.filter(ended < parse_date(F.col("start_date"))),
        "ended while running": projects.filter(
            status.isin("active", "tendering", "on_hold") & ended.isNotNull()
        ),
        "paid before invoice": invoices.filter(paid < invoiced),
        "done but open": milestones.filter(
            (progress != "complete") & parse_date(F.col("actual_date")).isNotNull()
        ),
    }
    return union(
        [
            df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
            for kind, df in found.items()
        ]
    )


_raw_values("df_12_business_ids", {"dim_vendors": ("business_id",)})
