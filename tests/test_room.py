"""What writes leave on disk, and what queries write before they can start."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from projectmart.operators import aggregates as A
from projectmart.operators.keys import of_keys
from projectmart.plans import features
from projectmart.sources.tables import (
    Layers,
    _CLEANUP,
    ensure_namespaces,
    save,
    scan,
    shuffles_removed,
)
from projectmart.streaming.ingest import ingest_stream
from registry.base import Stored


@pytest.fixture()
def layers(spark, tmp_path):
    layers = Layers(f"room{tmp_path.name.replace('-', '_')}_", f"file://{tmp_path}")
    ensure_namespaces(spark, layers)
    return layers


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, layers):
    before = spark.conf.get(_CLEANUP, "false")
    held = shuffle_files(spark)
    sums = spark.range(0, 20_000, 1, 4).groupBy((F.col("id") % 7000).alias("k")).agg(F.sum("id").alias("n"))
    save(sums, layers, "gold", "gold_project_summary")
    for _ in range(50):
        left = shuffle_files(spark) - held
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert scan(spark, layers, "gold", "gold_project_summary").count() == 7000
    # The frame that was written can be read again.
    assert sums.agg(F.sum("n")).first()[0] == sum(range(20_000))
    assert spark.conf.get(_CLEANUP, "false") == before


def test_the_setting_of_the_session_comes_back_after_the_last_of_several_writes(spark):
    before = spark.conf.get(_CLEANUP, "false")
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(_CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(_CLEANUP, "false") == before


def test_stored_tables_and_sinks_are_compressed_alike(spark, layers, tmp_path):
    rows = spark.range(100).withColumn("name", F.lit("x"))
    save(rows, layers, "bronze", "dim_projects")
    save(rows, layers, "bronze", "dim_projects", mode="append")
    rows.write.insertInto(layers.name("bronze", "dim_projects"))
    folder = layers.folder("bronze", "dim_projects")
    sink = f"{tmp_path}/sink"
    found = ingest_stream(spark, folder, sink, f"{tmp_path}/checkpoint", rows.schema)
    assert found.count() == 300
    for place in (folder.removeprefix("file://"), sink):
        files = list(Path(place).rglob("*.parquet"))
        assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_streams_start_from_raw_tables_alone(spark, small, monkeypatch):
    monkeypatch.setattr(Stored, "_known", {})
    monkeypatch.setattr(Stored, "_complete", lambda s: pytest.fail("a table was written that is not read"))
    stored = Stored.bronze_of(spark, small)
    assert Stored.bronze_of(spark, small) is stored
    assert scan(spark, stored.layers, "bronze", "fact_invoices").count() > 0
    assert not spark.catalog.tableExists(stored.layers.name("silver", "fact_invoices"))
    # What the other queries ask for is more.
    done = []
    monkeypatch.setattr(Stored, "_complete", lambda s: (done.append(s), setattr(s, "_whole", True)))
    assert Stored.of(spark, small) is Stored.of(spark, small) is stored and done == [stored]


def test_distinct_values_beside_sums_take_one_shuffle(spark):
    rows = spark.range(300).select(
        (F.col("id") % 5).alias("k"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 11)).alias("v"),
    )
    both = rows.groupBy("k").agg(A.n_values(F.col("v")).alias("a"), A.n_distinct(F.col("v")).alias("b"))
    assert both.filter("a <> b").count() == 0 and dict(both.dtypes)["a"] == dict(both.dtypes)["b"]
    nothing = rows.filter("v IS NULL").groupBy("k").agg(A.n_values(F.col("v")).alias("a"))
    assert {r["a"] for r in nothing.collect()} == {0}

    costs = spark.createDataFrame(
        [("p", "labour", 1.0, 1.0, 1.0, 0.0)],
        "project_id string, cost_category string, budget_eur double, committed_eur double,"
        " actual_eur double, variance_eur double",
    )
    text = features.cost_features(costs)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_an_exact_sum_moves_one_number(spark):
    values = [0.1, 0.2, -0.3, 1e15, 1.23456789e20, -9.9e23, 0.00005, 214748.36475, None]
    rows = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k int, v double")
    sums = rows.groupBy("k").agg(A.money_total(F.col("v")).alias("s"), F.sum(F.col("v").cast(A.MONEY)).alias("c"))
    assert sums.filter("NOT s <=> c").count() == 0
    assert dict(sums.dtypes)["s"] == "decimal(38,4)"
    nothing = spark.createDataFrame([(1, None)], "k int, v double").agg(A.money_total(F.col("v")).alias("s"))
    assert nothing.first()["s"] is None
    # Beyond 10^30, where ten-thousandths have 35 digits.
    many = spark.range(3_000_000, numPartitions=4).agg(A.money_total(F.lit(9e23)).cast("string").alias("s"))
    exact = spark.range(1).select((F.lit(9e23).cast(A.MONEY) * 3_000_000).cast("decimal(38,4)").cast("string").alias("s"))
    assert many.first()["s"] == exact.first()["s"]
    plan = rows.groupBy("k").agg(A.money_total(F.col("v")))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("partial_sum(") == 1


def test_rows_that_cannot_have_a_key_are_dropped_before_rows_move(spark, tmp_path):
    spark.range(2000).select(F.col("id").alias("k"), F.lit("v").alias("v")).write.parquet(f"{tmp_path}/rows")
    spark.range(5).select((F.col("id") * 7).alias("k")).write.parquet(f"{tmp_path}/keys")
    df, keys = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("rows", "keys"))
    found = of_keys(df, "k", keys.union(keys))
    assert sorted(r["k"] for r in found.collect()) == [0, 7, 14, 21, 28]
    text = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {name: min(len(line) - len(line.lstrip(" :+-")) for line in text if name in line) for name in ("Join ", "getbit")}
    assert depth["Join "] < depth["getbit"]
