"""Silver and gold tables of both paths."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from projectmart.plans import declarative
from projectmart.plans.silver import key_report
from projectmart.sources.fixtures import AS_OF
from projectmart.sources.schemas import CORE_TABLES, PRIMARY_KEYS
from projectmart.sources.tables import inventory
from registry.base import Tables, query

for i, table in enumerate(CORE_TABLES, start=1):

    @query(f"sv_{i}_{table}", f"SELECT * FROM s_{table}")
    def _(t: Tables, table=table):
        return t.silver[table]

# The order of the declarative tables is that of their names.
for i, table in enumerate(sorted(CORE_TABLES), start=1):

    @query(f"dv_{i}_{table}", f"SELECT * FROM d_{table}")
    def _(t: Tables, table=table):
        return t.declared[table]


def key_report_sql(prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", CAST(coalesce(sum(n), 0) AS BIGINT) AS \"rows\","
        f" CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_pk,"
        f" count(*) FILTER (WHERE n > 1) AS dup_pk"
        f" FROM (SELECT {pk} AS k, count(*) AS n FROM {prefix}{t} GROUP BY 1)"
        for t, pk in PRIMARY_KEYS.items()
    )


@query("sv_9_verification", key_report_sql("s_"))
def _(t: Tables):
    return key_report(t.silver)


BATCH = {
    "gd_1_cost_variance_monthly": "gold_cost_variance_monthly",
    "gd_2_schedule_kpi": "gold_schedule_kpi",
    "gd_3_vendor_scorecard": "gold_vendor_scorecard",
    "gd_4_invoice_aging": "gold_invoice_aging",
    "gd_5_project_summary": "gold_project_summary",
    "gd_6_employee_purchase_summary": "gold_employee_purchase_summary",
}
for name, mart in BATCH.items():

    @query(name, f"SELECT * FROM {mart.replace('gold_', 'g_')}")
    def _(t: Tables, mart=mart):
        return t.gold[mart]


COLUMNS = {
    "gold_cost_variance_monthly": 13,
    "gold_schedule_kpi": 14,
    "gold_vendor_scorecard": 23,
    "gold_invoice_aging": 9,
    "gold_project_summary": 27,
    "gold_employee_purchase_summary": 11,
}


@query(
    "gd_7_verification",
    " UNION ALL ".join(
        f"SELECT '{mart}' AS \"table\", count(*) AS \"rows\", {n} AS \"columns\""
        f" FROM {mart.replace('gold_', 'g_')}"
        for mart, n in COLUMNS.items()
    ),
)
def _(t: Tables):
    return inventory({"gold": t.gold}).select("table", "rows", F.col("columns"))


DECLARED = {
    "dg_1_cost_variance_monthly": declarative.cost_variance_monthly,
    "dg_2_schedule_kpi": declarative.schedule_kpi,
    "dg_3_vendor_scorecard": declarative.vendor_scorecard,
    "dg_4_invoice_aging": partial(declarative.invoice_aging, as_of=AS_OF),
    "dg_5_employee_purchase_summary": declarative.employee_purchase_summary,
}
for name, build in DECLARED.items():

    @query(name, f"SELECT * FROM dg_{name[5:]}")
    def _(t: Tables, build=build):
        return build(t.declared)


