"""Rules in which the batch and the declarative path differ, and rules of single marts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.plans import declarative, gold, silver
from projectmart.plans.features import cost_features
from projectmart.sources.schemas import RAW_SCHEMAS

AS_OF = "2025-06-30"


def raw(spark, table, *rows):
    names = RAW_SCHEMAS[table].fieldNames()
    return spark.createDataFrame(
        [tuple(row.get(n) for n in names) for row in rows], RAW_SCHEMAS[table]
    )


def invoice(**values):
    return {"invoice_id": "INV-00001", "vendor_id": "VND-0001", "po_id": "PO-00001",
            "invoice_date": "2025-01-01", "due_date": "2025-01-31", "amount_eur": 10.0,
            "payment_status": "pending", **values}


def test_enums_are_mapped_or_only_folded(spark):
    df = raw(spark, "fact_invoices", invoice(payment_status=" Payed"))
    assert silver.fact_invoices(df, as_of=AS_OF).collect()[0]["payment_status"] == "paid"
    declared = declarative.silver_table("fact_invoices", df).collect()[0]
    assert declared["payment_status_clean"] == "payed"


def test_five_or_three_formats(spark):
    df = raw(spark, "fact_invoices", invoice(due_date="31-Jan-2025"))
    assert silver.fact_invoices(df, as_of=AS_OF).collect()[0]["due_date_dt"] is not None
    assert declarative.silver_table("fact_invoices", df).collect()[0]["due_dt"] is None


def test_negative_contract_is_repaired_or_dropped(spark):
    df = raw(spark, "dim_projects",
             {"project_id": "FRA-2025-0001", "contract_value_eur": -5.0, "floor_area_m2": 1.0},
             {"project_id": "FRA-2025-0002", "contract_value_eur": None, "floor_area_m2": 1.0})
    batch = {r["project_id"]: r["contract_value_eur"] for r in silver.dim_projects(df).collect()}
    assert batch == {"FRA-2025-0001": 5.0, "FRA-2025-0002": None}
    assert declarative.silver_table("dim_projects", df).count() == 0


def test_entity_vanishes_when_the_surviving_duplicate_breaks_a_rule(spark):
    df = raw(spark, "dim_employee",
             {"employee_id": "EMP-0001", "full_name": None, "role": "planner"},
             {"employee_id": "EMP-0001", "full_name": "B", "role": "planner"})
    assert declarative.silver_table("dim_employee", df).count() == 0
    assert silver.dim_employee(df).collect()[0]["full_name"] is None


def test_blank_role_is_dropped_in_the_declarative_path_only(spark):
    df = raw(spark, "dim_employee", {"employee_id": "EMP-0001", "full_name": "A", "role": "  "})
    assert declarative.silver_table("dim_employee", df).count() == 0
    assert silver.dim_employee(df).count() == 1


def test_references_are_checked_in_the_batch_path_only(spark):
    df = raw(spark, "fact_project_costs",
             {"cost_id": "CST-00001", "project_id": "INVALID", "budget_eur": 1.0})
    assert silver.fact_project_costs(df).collect()[0]["project_id"] is None
    declared = declarative.silver_table("fact_project_costs", df).collect()[0]
    assert declared["project_id"] == "INVALID"


@pytest.mark.parametrize(
    ("values", "batch", "declared"),
    [
        ({"payment_status": "paid"}, "current", "90+ days"),
        ({"due_date": None}, "current", "90+ days"),
        ({"payment_status": "unknown"}, "current", "90+ days"),
        ({"due_date": "2025-06-29"}, "1-30 days", "1-30 days"),
        ({"due_date": "2025-07-01"}, "current", "current"),
    ],
)
def test_aging(spark, values, batch, declared):
    df = raw(spark, "fact_invoices", invoice(**values))
    vendors = raw(spark, "dim_vendors", {"vendor_id": "VND-0001", "vendor_name": "V"})
    tables = {"fact_invoices": silver.fact_invoices(df, as_of=AS_OF),
              "dim_vendors": silver.dim_vendors(vendors)}
    assert gold.invoice_aging(tables).collect()[0]["aging_bucket"] == batch
    tables = {"fact_invoices": declarative.silver_table("fact_invoices", df),
              "dim_vendors": declarative.silver_table("dim_vendors", vendors)}
    mart = declarative.invoice_aging(tables, as_of=AS_OF)
    assert mart.collect()[0]["aging_bucket"] == declared


def test_paid_date(spark):
    df = raw(
        spark, "fact_invoices",
        invoice(invoice_id="INV-1", payment_status="paid", paid_date="2025-01-01"),
        invoice(invoice_id="INV-2", payment_status="paid", paid_date="2024-12-31"),
        invoice(invoice_id="INV-3", payment_status="pending", paid_date="2025-01-05"),
    )
    found = {r["invoice_id"]: r["paid_date_dt"] for r in silver.fact_invoices(df, as_of=AS_OF).collect()}
    assert str(found["INV-1"]) == "2025-01-01"
    assert found["INV-2"] is None and found["INV-3"] is None


def test_milestone_delay(spark):
    df = raw(
        spark, "fact_schedule_milestones",
        {"milestone_id": "MS-1", "planned_date": "2025-01-01", "actual_date": "2025-01-11",
         "milestone_status": "COMPLETE", "delay_days": 99},
        {"milestone_id": "MS-2", "planned_date": "2025-01-01", "actual_date": "2025-01-11",
         "milestone_status": "delayed"},
    )
    rows = {r["milestone_id"]: r for r in silver.fact_schedule_milestones(df).collect()}
    assert rows["MS-1"]["delay_days"] == 10
    assert rows["MS-2"]["delay_days"] is None and rows["MS-2"]["actual_date_dt"] is None


def test_risk_score(spark):
    df = spark.createDataFrame(
        [(100.0, 0, 0, 0.0), (100.0, 4, 0, 0.0), (200.0, 0, 0, 0.0), (200.02, 0, 0, 0.0),
         (None, None, None, None), (90.0, 1, 2, -3.0), (110.0, 1, 1, 5.5)],
        "util double, late bigint, over bigint, delay double",
    )
    score = gold.risk_score(F.col("util"), F.col("late"), F.col("over"), F.col("delay"))
    rows = df.select(score.alias("s")).withColumn("level", gold.risk_level(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        (0.0, "low"), (20.0, "low"), (50.0, "medium"), (50.01, "high"), (0.0, "low"),
        (11.0, "low"), (15.75, "low"),
    ]


def test_label_is_strict_at_the_threshold(spark):
    costs = spark.createDataFrame(
        [("p", 100.0, 110.0), ("q", 100.0, 110.01), ("r", 0.1, 0.11)],
        "project_id string, budget_eur double, actual_eur double",
    ).select(
        "*", F.lit(0.0).alias("committed_eur"), F.lit(0.0).alias("variance_eur"),
        F.lit("labour").alias("cost_category"),
    )
    found = {r["project_id"]: r["is_over_budget"] for r in cost_features(costs).collect()}
    assert found == {"p": 0, "q": 1, "r": 0}


def test_wide_keys_are_the_default(spark):
    df = raw(spark, "fact_project_costs",
             {"cost_id": "CST-1", "project_id": "FRA-20250-0001", "budget_eur": 1.0})
    assert silver.fact_project_costs(df).collect()[0]["project_id"] == "FRA-20250-0001"
    narrow = silver.fact_project_costs(df, keys=V.NARROW_KEYS).collect()[0]
    assert narrow["project_id"] is None
