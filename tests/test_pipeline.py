"""Stored tables, streams, model and reports, end to end on the small tables."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import registry

from projectmart.functions import fixed_values as V
from projectmart.plans import declarative, features, gold, govern, model, pipeline, validate
from projectmart.sources import fixtures
from projectmart.sources.schemas import CORE_TABLES, RAW_SCHEMAS
from projectmart.sources.tables import (
    Layers,
    drop_layers,
    ensure_namespaces,
    exists,
    preview,
    put_metadata,
    save,
    scan,
    shared_folder,
    stored_inventory,
)
from projectmart.streaming.ingest import ingest_stream


@pytest.fixture(scope="module")
def stored(spark, small):
    root = shared_folder(spark)
    layers = Layers("test_", root)
    results = pipeline.run_batch(
        spark,
        fixtures.raw_tables(spark, small),
        layers,
        model_path=f"{root}/model",
        as_of=fixtures.AS_OF,
        keys=V.WIDE_KEYS,
        params={**V.BOOSTING, "maxIter": 3},
    )
    return layers, results


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_all_checks_are_reported(stored):
    _, results = stored
    summary = validate.summarize(results).collect()[0]
    assert summary["total"] == 73
    failed = [r["test"] for r in validate.failures(results).collect()]
    assert summary["failed"] == len(failed)
    # On the smallest tables a single broken reference can exceed the tolerated share.
    assert set(failed) <= {
        "costs.project_id references dim_projects", "PO.vendor_id references dim_vendors",
    }


def test_a_missing_table_fails_its_checks(spark, stored):
    layers, _ = stored
    elsewhere = Layers("nothing_", layers.root)
    rows = validate.check_existence(spark, elsewhere).collect()
    assert {r["status"] for r in rows} == {"FAIL"} and len(rows) == 23


def test_inventory(spark, stored):
    layers, _ = stored
    rows = {(r["layer"], r["table"]): r for r in stored_inventory(spark, layers).collect()}
    assert len(rows) == 24
    assert rows[("gold", "ml_feature_table")]["columns"] == 37
    assert rows[("gold", "gold_project_summary")]["columns"] == 28
    assert all(r["state"] == "OK" for r in rows.values())
    nothing = stored_inventory(spark, Layers("nothing_", layers.root)).collect()
    assert {r["state"] for r in nothing} == {"NOT FOUND"} and len(nothing) == 24


def test_batch_rows_are_the_distinct_known_keys(spark, stored):
    layers, _ = stored
    for table in ("dim_employee", "fact_invoices"):
        key = RAW_SCHEMAS[table].fieldNames()[0]
        bronze = scan(spark, layers, "bronze", table)
        expected = bronze.select(key).dropna().distinct().count()
        assert scan(spark, layers, "silver", table).count() == expected


def test_scores_match_their_level(spark, stored):
    layers, _ = stored
    scores = scan(spark, layers, "gold", "ml_project_risk_scores")
    assert scores.columns == ["project_id", "overrun_probability", "risk_level", "scored_at"]
    bad = scores.filter("overrun_probability < 0 OR overrun_probability > 1 OR risk_level IS NULL")
    assert bad.count() == 0
    assert scores.count() == scan(spark, layers, "gold", "ml_feature_table").count()


def test_split_keeps_the_share_of_every_class(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("project_id"),
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("is_over_budget"),
    )
    training, test = model.stratified_split(df)
    counts = {r[0]: r[1] for r in test.groupBy("is_over_budget").count().collect()}
    assert abs(counts[0] - 900) <= 2 and abs(counts[1] - 100) <= 2
    assert training.count() + test.count() == 5000
    again = model.stratified_split(df)[1]
    assert again.exceptAll(test).count() == 0


def test_model_separates_and_survives_a_reload(spark, stored):
    layers, _ = stored
    features = scan(spark, layers, "gold", "ml_feature_table")
    loaded = model.load_model(f"{layers.root}/model")
    predictions = model.predict(loaded, features)
    assert model.evaluate(predictions)["auc_roc"] > 0.9
    report = {r["class"]: r for r in model.classification_report(predictions).collect()}
    assert report[0]["support"] + report[1]["support"] == features.count()
    importance = model.feature_importance(loaded, features).collect()
    assert len(importance) == 34
    assert importance[0]["loss_increase"] > 0


def test_run_metadata(spark, stored):
    layers, _ = stored
    rows = {r["key"]: r["value"] for r in spark.table(layers.name("gold", "run_metadata")).collect()}
    assert rows["param.maxDepth"] == "6" and float(rows["metric.auc_roc"]) > 0.5


def test_governance(spark, stored):
    layers, _ = stored
    comments = {r["table"]: r["comment"] for r in govern.comment_report(spark, layers, "gold").collect()}
    assert comments["gold_project_summary"] != "(no comment)"
    assert comments["ml_feature_table"] == "(no comment)"
    columns = {(r["table"], r["column"]) for r in govern.column_comment_report(spark, layers, "gold").collect()}
    assert ("gold_vendor_scorecard", "rehire_rate_pct") in columns
    tags = {(r["table"], r["column"], r["tag"]): r["value"] for r in govern.tag_report(spark, layers, "silver").collect()}
    assert tags[("dim_employee", "full_name", "pii")] == "name"


def test_preview(spark, stored):
    rows, columns, first = preview(scan(spark, stored[0], "silver", "dim_employee"), 2)
    assert rows > 2 and columns == 5 and first.count() == 2


def test_stream_restarts_where_it_stopped(spark, small):
    root, schema = shared_folder(spark), RAW_SCHEMAS["dim_vendors"]
    source = f"{root}/source"
    raw = fixtures.raw_table(spark, small, "dim_vendors")
    arguments = (source, f"{root}/sink", f"{root}/checkpoint", schema)
    raw.coalesce(1).write.parquet(source)
    first = ingest_stream(spark, *arguments).count()
    assert first == raw.count()
    assert ingest_stream(spark, *arguments).count() == first
    raw.limit(3).coalesce(1).write.mode("append").parquet(source)
    assert ingest_stream(spark, *arguments, max_files=1).count() == first + 3


def test_stream_then_recompute_equals_batch_read(spark, stored, small):
    layers, _ = stored
    sources = {table: layers.folder("bronze", table) for table in CORE_TABLES}
    root = shared_folder(spark)
    marts = pipeline.run_declarative(
        spark, sources, Layers("declared_", root), stream_root=f"{root}/stream", as_of=fixtures.AS_OF
    )
    direct = declarative.gold_marts(
        declarative.silver_tables(fixtures.raw_tables(spark, small)), as_of=fixtures.AS_OF
    )
    for mart, df in direct.items():
        assert df.exceptAll(marts[mart]).count() == 0
        assert df.count() == marts[mart].count()
    raw = fixtures.raw_tables(spark, small)
    report = declarative.expectation_report(raw, declarative.required_rules())
    expected = {
        f"expectation.{r['table']}.{r['rule']}": str(r["violations"]) for r in report.collect()
    }
    warned = declarative.expectation_report(raw, declarative.warning_rules())
    expected |= {
        f"expectation.{r['table']}.{r['rule']}": str(r["violations"]) for r in warned.collect()
    }
    # Rows without key are counted one by one, not as the row that would stay of them.
    for table, rules in declarative.required_rules().items():
        key, rule = RAW_SCHEMAS[table].fieldNames()[0], next(iter(rules))
        without = raw[table].filter(F.col(key).isNull()).count()
        expected[f"expectation.{table}.{rule}"] = str(without)
    declared = Layers("declared_", root)
    kept = spark.table(declared.name("gold", "run_metadata")).collect()
    assert len(kept) == 25 and len({r["run_id"] for r in kept}) == 1
    assert expected.items() <= {r["key"]: r["value"] for r in kept}.items()
    for layer in ("bronze", "silver", "gold"):
        comments = govern.comment_report(spark, declared, layer).filter("comment = '(no comment)'")
        assert {r["table"] for r in comments.collect()} <= {"run_metadata"}
    # The sinks are tables, so that single tables can be refreshed afterwards.
    for table in CORE_TABLES:
        assert scan(spark, declared, "bronze", table).count() == raw[table].count()
    pipeline.refresh(spark, declared, "silver", "fact_invoices")
    pipeline.refresh(spark, declared, "gold", "gold_invoice_aging", as_of=fixtures.AS_OF)
    again = scan(spark, declared, "gold", "gold_invoice_aging")
    assert again.exceptAll(direct["gold_invoice_aging"]).count() == 0


def test_rows_without_key_reach_no_shuffle(spark, stored):
    raw = scan(spark, stored[0], "bronze", "fact_invoices")
    for observed in (None, declarative.observations("fact_invoices")):
        df = declarative.silver_table("fact_invoices", raw, observed=observed)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        window, below = plan.split("Window [", 1)
        assert "isnotnull(invoice_id" in below


def test_audit_and_model_reports_are_stored(spark, stored):
    layers, _ = stored
    score = scan(spark, layers, "gold", "audit_scorecard").collect()[0]
    assert score["total_checks"] == 21 and score["band"] in ("green", "amber", "red")
    assert scan(spark, layers, "gold", "audit_keys").count() == 8
    assert scan(spark, layers, "gold", "audit_enums").count() == 5
    nulls = scan(spark, layers, "gold", "audit_nulls")
    assert nulls.filter("column = 'actual_end_date_dt'").count() == 1
    report = scan(spark, layers, "gold", "ml_classification_report").collect()
    predictions = scan(spark, layers, "gold", "ml_test_predictions").count()
    assert sum(r["support"] for r in report) == predictions
    assert scan(spark, layers, "gold", "ml_feature_importance").count() == 34


def test_metadata_tells_runs_apart(spark):
    layers = Layers("runs_", shared_folder(spark))
    ensure_namespaces(spark, layers)
    entries = spark.createDataFrame([("k", "v")], "key string, value string")
    for _ in range(2):
        kept = put_metadata(spark, layers, entries)
    assert kept.count() == 2 and kept.select("run_id").distinct().count() == 2


def test_partitions_prune_and_comments_are_declared(spark):
    layers = Layers("parts_", shared_folder(spark))
    ensure_namespaces(spark, layers)
    df = spark.range(20).withColumn("month", (F.col("id") % 4).cast("string"))
    save(df, layers, "gold", "monthly", partition_by=["month"], comment="it's \\ by month")
    read = scan(spark, layers, "gold", "monthly").filter("month = '2'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and read.count() == 5
    name = layers.name("gold", "monthly")
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert rows["Comment"] == "it's \\ by month"


def test_drop_keeps_bronze_unless_asked(spark, small):
    layers = Layers("dropped_", shared_folder(spark))
    pipeline.build_bronze(
        spark, layers, {"dim_employee": fixtures.raw_table(spark, small, "dim_employee")}
    )
    drop_layers(spark, layers)
    assert exists(spark, layers, "bronze", "dim_employee")
    report = drop_layers(spark, layers, drop_bronze=True)
    assert report.filter("present").count() == 0


def test_drop_refuses_a_schema_with_tables_of_others(spark):
    layers = Layers("shared_", shared_folder(spark))
    ensure_namespaces(spark, layers)
    entries = spark.createDataFrame([("k", "v")], "key string, value string")
    put_metadata(spark, layers, entries)
    save(entries, layers, "gold", "somebody_elses")
    with pytest.raises(AnalysisException):
        drop_layers(spark, layers)
    assert exists(spark, layers, "gold", "somebody_elses")
    assert not exists(spark, layers, "gold", "run_metadata")
    spark.sql(f"DROP TABLE {layers.name('gold', 'somebody_elses')}")
    drop_layers(spark, layers)
    assert not spark.catalog.databaseExists(layers.schema("gold"))


def test_tables_bucketed_by_project_are_joined_in_place(spark, stored, small):
    layers, _ = stored
    root = shared_folder(spark)
    placed = Layers("placed_", root)
    pipeline.build_bronze(spark, placed, fixtures.raw_tables(spark, small))
    pipeline.build_silver(spark, placed, as_of=fixtures.AS_OF, n_buckets=4)
    tables = pipeline.core(spark, placed, "silver")
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        for build in (gold.project_summary, features.feature_table):
            df = build(tables)
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
            assert df.count() > 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # The same marts as from tables that are not bucketed.
    plain = Layers("unplaced_", root)
    pipeline.build_bronze(spark, plain, fixtures.raw_tables(spark, small))
    pipeline.build_silver(spark, plain, as_of=fixtures.AS_OF)
    want = gold.project_summary(pipeline.core(spark, plain, "silver")).drop("ingestion_timestamp")
    got = gold.project_summary(tables).drop("ingestion_timestamp")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_declared_tables_carry_their_comments(spark, small):
    rows = {r["table"]: r["comment"] for r in registry.QUERIES["gv_5_declared_comment"](spark, small).collect()}
    assert rows == {
        "dim_vendors": govern.TABLE_COMMENTS["silver"]["dim_vendors"],
        "fact_subcontractor_performance": govern.TABLE_COMMENTS["silver"]["fact_subcontractor_performance"],
        "gold_vendor_scorecard": govern.TABLE_COMMENTS["gold"]["gold_vendor_scorecard"],
    }
