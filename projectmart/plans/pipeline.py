"""Run order of both paths. Every stage reads what the stage before it has written."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.plans import declarative, features, gold, model, silver, validate
from projectmart.plans.audit import audit_enums, audit_keys, audit_nulls, dq_scorecard
from projectmart.plans.explain import shapley_ranking
from projectmart.plans.govern import TABLE_COMMENTS, apply_governance
from projectmart.sources.arrival import ARRIVAL, with_arrival
from projectmart.sources.schemas import CORE_TABLES, RAW_SCHEMAS
from projectmart.sources.tables import (
    Layers,
    ensure_namespaces,
    new_run,
    put_metadata,
    register,
    save,
    scan,
)
from projectmart.streaming.ingest import ingest_tables

Tables = Mapping[str, DataFrame]
# Silver tables that are grouped and joined by project.
BY_PROJECT = (
    "dim_projects", "fact_project_costs", "fact_schedule_milestones", "fact_purchase_orders",
    "fact_subcontractor_performance",
)


def save_all(
    frames: Tables,
    layers: Layers,
    layer: str,
    at_once: int = 2,
    *,
    comments: Mapping[str, str] | None = None,
    buckets: Mapping[str, tuple[int, str]] | None = None,
) -> None:
    """Write independent tables; a few at once keep the executors busy between stages."""
    def one(item: tuple[str, DataFrame]) -> None:
        table, df = item
        comment, bucket = (comments or {}).get(table), (buckets or {}).get(table)
        save(df, layers, layer, table, bucket_by=bucket, comment=comment)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(one, frames.items()))


def core(spark: SparkSession, layers: Layers, layer: str) -> dict[str, DataFrame]:
    return {table: scan(spark, layers, layer, table) for table in CORE_TABLES}


def build_bronze(spark: SparkSession, layers: Layers, raw: Tables) -> None:
    ensure_namespaces(spark, layers)
    save_all(raw, layers, "bronze")


def build_silver(
    spark: SparkSession,
    layers: Layers,
    *,
    as_of: str | None = None,
    keys: Mapping[str, str] = V.WIDE_KEYS,
    by_arrival: bool = False,
    n_buckets: int | None = None,
) -> None:
    """Of rows of one key the first in the order of all columns stays, or the first that arrived.

    With ``n_buckets``, projects and the facts about them are bucketed by project, so that what
    groups and joins them by project reads them in place. A project with a large share of a fact then
    makes a large bucket; where that matters, leave it out.
    """
    bronze = core(spark, layers, "bronze")
    if by_arrival:
        bronze = {table: with_arrival(df) for table, df in bronze.items()}
    order = [ARRIVAL] if by_arrival else None
    clean = silver.silver_tables(bronze, as_of=as_of, order_by=order, keys=keys)
    buckets = {table: (n_buckets, "project_id") for table in BY_PROJECT} if n_buckets else None
    save_all(clean, layers, "silver", buckets=buckets)


def build_gold(spark: SparkSession, layers: Layers) -> None:
    save_all(gold.gold_marts(core(spark, layers, "silver")), layers, "gold")


def build_features(spark: SparkSession, layers: Layers) -> None:
    table = features.feature_table(core(spark, layers, "silver"))
    save(table, layers, "gold", "ml_feature_table")


def build_scores(
    spark: SparkSession,
    layers: Layers,
    model_path: str,
    params: Mapping[str, float] = V.BOOSTING,
    run_id: str | None = None,
) -> dict[str, float]:
    """Train on 80 percent, measure on the rest, store model, report and importance, score every
    project. The predictions of the test rows are written once and read for each measure."""
    table = scan(spark, layers, "gold", "ml_feature_table")
    training, test = model.stratified_split(table)
    fitted = model.train(training, params)
    save(model.predict(fitted, test), layers, "gold", "ml_test_predictions")
    predictions = scan(spark, layers, "gold", "ml_test_predictions")
    metrics = model.evaluate(predictions)
    report = model.classification_report(predictions)
    save(report, layers, "gold", "ml_classification_report")
    measured = model.feature_importance(fitted, test).join(shapley_ranking(fitted, test), "feature")
    ranked = measured.orderBy(F.desc("mean_abs_shapley"), "feature")
    save(ranked, layers, "gold", "ml_feature_importance")
    model.save_model(fitted, model_path)
    model.log_run(spark, layers, params, metrics, run_id)
    scores = model.score_projects(model.load_model(model_path), table)
    save(scores, layers, "gold", "ml_project_risk_scores")
    return metrics


def build_audit(spark: SparkSession, layers: Layers) -> None:
    """Key, null and enumeration reports and the scorecard over them, as stored tables."""
    bronze, clean = core(spark, layers, "bronze"), core(spark, layers, "silver")
    reports = {
        "audit_keys": audit_keys(bronze, clean),
        "audit_nulls": audit_nulls({"bronze": bronze, "silver": clean}),
        "audit_enums": audit_enums(clean),
    }
    save_all(reports, layers, "gold")
    keys, enums = (scan(spark, layers, "gold", t) for t in ("audit_keys", "audit_enums"))
    save(dq_scorecard(keys, enums), layers, "gold", "audit_scorecard")


def run_batch(
    spark: SparkSession,
    raw: Tables,
    layers: Layers,
    *,
    model_path: str,
    as_of: str | None = None,
    keys: Mapping[str, str] = V.WIDE_KEYS,
    params: Mapping[str, float] = V.BOOSTING,
    by_arrival: bool = True,
) -> DataFrame:
    """The daily workflow; returns the validation results.

    Of duplicates the row that arrived first stays, by the files of the bronze tables. After the marts, three branches run at once: features and model, audit, and governance. The
    table comments come first within theirs, the model's tables have none.
    """
    run_id = new_run()
    build_bronze(spark, layers, raw)
    build_silver(spark, layers, as_of=as_of, keys=keys, by_arrival=by_arrival)
    build_gold(spark, layers)

    def learn() -> None:
        build_features(spark, layers)
        build_scores(spark, layers, model_path, params, run_id)

    branches = (
        learn,
        lambda: build_audit(spark, layers),
        lambda: apply_governance(spark, layers),
    )
    with ThreadPoolExecutor(len(branches)) as pool:
        for branch in [pool.submit(b) for b in branches]:
            branch.result()
    return validate.validate(spark, layers)


def refresh(
    spark: SparkSession, layers: Layers, layer: str, table: str, *, as_of: str | None = None
) -> None:
    """Recompute one derived table of the declarative path from the stored tables before it."""
    if layer == "silver":
        df = declarative.silver_table(table, scan(spark, layers, "bronze", table))
    else:
        sources, build = declarative.GOLD[table]
        silver_tables = {source: scan(spark, layers, "silver", source) for source in sources}
        df = build(silver_tables, as_of=as_of)
    save(df, layers, layer, table, comment=TABLE_COMMENTS[layer].get(table))


def run_declarative(
    spark: SparkSession,
    sources: Mapping[str, str],
    layers: Layers,
    *,
    stream_root: str,
    as_of: str | None = None,
) -> dict[str, DataFrame]:
    """Drain the streams, then recompute silver and gold in order; returns the gold marts.

    The sinks are registered as the bronze tables. Violations of the expectations, warnings
    included, are counted while silver is written, and kept as metadata.
    """
    ensure_namespaces(spark, layers)
    ingest_tables(spark, dict(sources), stream_root)
    for table in CORE_TABLES:
        path = f"{stream_root}/tables/{table}"
        comment = f"Raw rows of {table} as the stream appended them."
        register(spark, layers, "bronze", table, RAW_SCHEMAS[table], path, comment=comment)
    bronze = core(spark, layers, "bronze")
    observed = {table: declarative.observations(table) for table in CORE_TABLES}
    save_all(
        {
            table: declarative.silver_table(table, bronze[table], observed=of_table)
            for table, of_table in observed.items()
        },
        layers,
        "silver",
        comments=TABLE_COMMENTS["silver"],
    )
    counted = [
        (f"expectation.{table}.{rule}", str(count))
        for table, of_table in observed.items()
        for rule, count in declarative.observed_counts(of_table).items()
    ]
    put_metadata(spark, layers, spark.createDataFrame(counted, "key string, value string"))
    clean = core(spark, layers, "silver")
    marts = declarative.gold_marts(clean, as_of=as_of)
    save_all(marts, layers, "gold", comments=TABLE_COMMENTS["gold"])
    return {mart: scan(spark, layers, "gold", mart) for mart in marts}
