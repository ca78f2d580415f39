"""Readers of some columns get the rows of the whole table, and move no more than they read."""

from __future__ import annotations

import pytest

from projectmart.plans import declarative, features, gold, silver
from projectmart.sources import fixtures
from projectmart.sources.schemas import CORE_TABLES
from registry.base import QUERIES, Tables


@pytest.mark.parametrize("table", CORE_TABLES)
def test_any_silver_column_alone_is_that_of_the_whole_table(spark, small, table):
    raw = fixtures.raw_table(spark, small, table)
    # Two rows of a key that differ in all other columns, besides the duplicates of the table.
    key, *others = raw.columns
    shifted = raw.select(key, *[raw[c].alias(c) for c in others]).filter(f"{key} IS NOT NULL").limit(40)
    raw = raw.unionByName(shifted.selectExpr(key, *[f"CAST(NULL AS {raw.schema[c].dataType.simpleString()}) AS {c}" for c in others]))
    raw = raw.localCheckpoint()
    whole = silver.silver_table(table, raw, as_of=fixtures.AS_OF).drop("ingestion_timestamp").cache()
    for column in whole.columns[1:]:
        found = silver.silver_table(table, raw, as_of=fixtures.AS_OF, columns=(whole.columns[0], column))
        wanted = whole.select(whole.columns[0], column)
        assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty(), column


def test_what_readers_name_is_all_they_read(spark, small):
    t = Tables(spark, small)
    for mart, reads in gold.READS.items():
        read, whole = t.gold[mart], gold.BUILDERS[mart](t.silver)
        assert read.exceptAll(whole).isEmpty() and whole.exceptAll(read).isEmpty(), mart
    read, whole = (df.drop("ingestion_timestamp") for df in (t.features, features.feature_table(t.silver)))
    assert read.exceptAll(whole).isEmpty() and whole.exceptAll(read).isEmpty()


def test_a_report_on_expectations_moves_what_they_read(spark, small):
    t = Tables(spark, small)
    report = QUERIES["ex_1_expect_or_drop"](spark, small)
    whole = declarative.expectation_report(t.raw, declarative.required_rules())
    assert sorted(report.collect()) == sorted(whole.collect())
    text = report._jdf.queryExecution().optimizedPlan().toString()
    # The names and dates of milestones and the months of costs are behind what the rules read.
    assert "Step " not in text and "MMMM" not in text


def test_the_splits_are_worked_out_once(spark, small):
    found = QUERIES["ml_10_shapley_of_two_splits"](spark, small)
    assert found.inputFiles() and all("/splits/" in f for f in found.inputFiles())
