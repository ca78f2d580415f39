"""Overrun model: encoding, split, training, metrics, importance and batch scoring, all in Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V
from projectmart.functions.values import risk_bucket, stamp
from projectmart.operators.aggregates import ratio
from projectmart.plans.features import LABEL
from projectmart.sources.tables import Layers, ensure_checkpoints, put_metadata

ID = "project_id"
CATEGORIES = ("project_type", "municipality", "status")
NOT_FEATURES = (ID, "ingestion_timestamp", LABEL)
CLASSES = (0, 1)
ROWS_PER_BUCKET = 1000
FEW_CODES = 10_000


def known_categories(features: DataFrame) -> DataFrame:
    return features.fillna("unknown", subset=list(CATEGORIES))


@dataclass(frozen=True)
class Overrun:
    """A fitted model: the codes of the categories, and vectors and trees on coded rows."""

    codes: DataFrame
    pipeline: PipelineModel


def category_codes(features: DataFrame) -> DataFrame:
    """(column, value, code): the place of every category in alphabetical order, from 0.

    The distinct values are sorted in ranges, numbered inside each range, and moved on by the counts
    of the ranges before: neither a task nor the driver sees all values of an open column. The
    sorted values are checkpointed, since ranges drawn anew could differ.
    """
    ensure_checkpoints(features.sparkSession)
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in CATEGORIES
    ]
    values = known_categories(features).select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    ranges = (
        values.distinct()
        .repartitionByRange("column", "value")
        .sortWithinPartitions("column", "value")
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("n"))
        .checkpoint()
    )
    sizes = ranges.groupBy("column", "part").agg(
        F.count("*").alias("size"), F.min("n").alias("first")
    )
    before = Window.partitionBy("column").orderBy("part")
    moved = sizes.select(
        "column", "part", (F.sum("size").over(before) - F.col("size") - F.col("first")).alias("by")
    )
    return ranges.join(moved, ["column", "part"]).select(
        "column", "value", (F.col("n") + F.col("by")).alias("code")
    )


def with_codes(features: DataFrame, codes: DataFrame, suffix: str = "code") -> DataFrame:
    """Codes of the categories as numbers; a category without code gets the number of codes.

    The values of a category may be few and each in a large share of the rows, so the codes are
    broadcast, unless they are counted and found to be more than ``FEW_CODES``.
    """
    coded = known_categories(features)
    few = codes.limit(FEW_CODES + 1).count() <= FEW_CODES
    for c in CATEGORIES:
        of_column = codes.filter(F.col("column") == c)
        if few:
            of_column = F.broadcast(of_column)
        number = of_column.agg(F.count("*").alias("n")).scalar()
        coded = coded.join(
            of_column.select(F.col("value").alias(c), F.col("code").alias("_code")), c, "left"
        ).withColumn(f"{c}_{suffix}", F.coalesce("_code", number).cast("double"))
        coded = coded.drop("_code")
    return coded


def encode(features: DataFrame) -> DataFrame:
    """Categories as codes in alphabetical order; an unknown category is ``unknown``."""
    return with_codes(features.drop("ingestion_timestamp"), category_codes(features))


def with_split(
    df: DataFrame, label: str = LABEL, fraction: float = V.TEST_FRACTION, seed: int = 42
) -> DataFrame:
    """Add ``_test``: about the given share of every class, chosen by a hash of the id.

    The cut per class is a quantile of the hashes, found by mergeable sketches, so no class is
    sorted or collected in one task. There are two classes, so the cuts are two rows.
    """
    hashed = df.filter(F.col(label).isin(*CLASSES)).withColumn(
        "_hash", F.xxhash64(F.col(ID), F.lit(seed))
    )
    cuts = hashed.groupBy(label).agg(
        F.percentile_approx("_hash", fraction, F.lit(10000)).alias("_cut")
    )
    return (
        hashed.join(F.broadcast(cuts), label)
        .withColumn("_test", F.col("_hash") <= F.col("_cut"))
        .drop("_hash", "_cut")
    )


def stratified_split(
    df: DataFrame, label: str = LABEL, fraction: float = V.TEST_FRACTION, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, label, fraction, seed)
    return marked.filter(~F.col("_test")).drop("_test"), marked.filter("_test").drop("_test")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    rows, classes = totals.select("rows").scalar(), totals.select("classes").scalar()
    return counts.select(
        label, (rows.cast("double") / (classes * F.col("n")).cast("double")).alias("weight")
    )


def with_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    labelled = df.filter(F.col(label).isin(*CLASSES))
    return labelled.join(F.broadcast(class_weights(labelled, label)), label)


def model_features(features: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    left_out = {*NOT_FEATURES, *CATEGORIES, *exclude}
    numbers = [c for c in features.columns if c not in left_out]
    return [*(f"{c}_number" for c in CATEGORIES if c not in exclude), *numbers]


def train(
    features: DataFrame,
    params: Mapping[str, float] = V.BOOSTING,
    exclude: Sequence[str] = (),
) -> Overrun:
    """Boosted trees on balanced classes.

    Category codes enter as plain numbers, so the number of categories is not limited by the number
    of bins. Boosting runs a job per tree level,
    so the rows are first dealt out anew; adaptive execution makes as many parts of them as their
    size calls for. Every tenth round is checkpointed, which keeps the lineage short and a lost executor cheap.
    """
    inputs = model_features(features, exclude)
    stages = [
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"),
        GBTClassifier(labelCol=LABEL, weightCol="weight", **params),
    ]
    codes = category_codes(features).checkpoint()
    weighted = with_weights(with_codes(features, codes, "number"))
    return Overrun(codes, Pipeline(stages=stages).fit(weighted.repartition(ID)))


def predict(model: Overrun, features: DataFrame) -> DataFrame:
    """Probability of an overrun and the hard label per project."""
    scored = model.pipeline.transform(with_codes(features, model.codes, "number"))
    kept = [c for c in (ID, LABEL) if c in features.columns]
    return scored.select(
        *kept,
        vector_to_array("probability")[1].alias("overrun_probability"),
        F.col("prediction").cast("int").alias("predicted"),
    )


def evaluate(predictions: DataFrame) -> dict[str, float]:
    """Area under the ROC curve and F1 of class 1."""
    typed = predictions.select(
        F.col(LABEL).cast("double").alias("label"),
        F.col("overrun_probability"),
        F.col("predicted").cast("double").alias("prediction"),
    )
    area = BinaryClassificationEvaluator(rawPredictionCol="overrun_probability", numBins=0)
    f1 = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0)
    return {"auc_roc": area.evaluate(typed), "f1_score": f1.evaluate(typed)}


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class from one pass."""
    label, predicted = F.col(LABEL), F.col("predicted")
    counts = predictions.agg(
        *[F.count_if((label == c) & (predicted == c)).alias(f"hit{c}") for c in CLASSES],
        *[F.count_if(predicted == c).alias(f"pred{c}") for c in CLASSES],
        *[F.count_if(label == c).alias(f"true{c}") for c in CLASSES],
    )
    per_class = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                F.col(f"hit{c}").alias("hit"),
                F.col(f"pred{c}").alias("pred"),
                F.col(f"true{c}").alias("support"),
            )
            for c in CLASSES
        ]
    )
    return (
        counts.select(F.explode(per_class).alias("c"))
        .select("c.*")
        .select(
            "class",
            ratio(F.col("hit"), F.col("pred")).alias("precision"),
            ratio(F.col("hit"), F.col("support")).alias("recall"),
            ratio(F.col("hit") * 2, F.col("pred") + F.col("support")).alias("f1"),
            "support",
        )
    )


def log_run(
    spark: SparkSession,
    layers: Layers,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    run_id: str | None = None,
) -> DataFrame:
    rows = [(f"param.{k}", str(v)) for k, v in params.items()]
    rows += [(f"metric.{k}", str(v)) for k, v in metrics.items()]
    entries = spark.createDataFrame(rows, "key string, value string")
    return put_metadata(spark, layers, entries, run_id)


def save_model(model: Overrun, path: str) -> None:
    model.codes.write.mode("overwrite").parquet(f"{path}/codes")
    model.pipeline.write().overwrite().save(f"{path}/trees")


def load_model(path: str) -> Overrun:
    codes = SparkSession.active().read.parquet(f"{path}/codes")
    return Overrun(codes, PipelineModel.load(f"{path}/trees"))


def _log_loss(label: Column, probability: Column) -> Column:
    bounded = F.least(F.greatest(probability, F.lit(1e-15)), F.lit(1 - 1e-15))
    return -F.log(F.when(label == 1, bounded).otherwise(1 - bounded))


def feature_importance(model: Overrun, rows: DataFrame, seed: int = 42) -> DataFrame:
    """Split-gain importance, and the rise of the log loss when a feature is permuted.

    Rows are put into buckets of about a thousand by a hash of their id, and every row borrows
    values from the next row of its bucket. That one shuffle serves all features: each row is then
    scored once per feature with that feature borrowed, and once unchanged.
    """
    assembler, trees = model.pipeline.stages
    names = assembler.getInputCols()
    prepared = assembler.transform(with_codes(rows, model.codes, "number"))
    vectors = prepared.select(ID, LABEL, vector_to_array("features").alias("x"))
    buckets = vectors.agg(
        F.ceil(F.count("*") / ROWS_PER_BUCKET).alias("n")
    ).scalar()
    bucketed = vectors.withColumn("_bucket", F.pmod(F.xxhash64(ID, F.lit(seed)), buckets))
    window = Window.partitionBy("_bucket").orderBy(F.xxhash64(ID, F.lit(seed + 1)), ID)
    paired = bucketed.withColumn(
        "other", F.coalesce(F.lead("x").over(window), F.first("x").over(window))
    )
    variants = paired.withColumn("j", F.explode(F.sequence(F.lit(-1), F.lit(len(names) - 1))))
    borrowed = F.transform(
        "x", lambda value, i: F.when(i == F.col("j"), F.get("other", i)).otherwise(value)
    )
    scored = trees.transform(
        variants.select(LABEL, "j", array_to_vector(borrowed).alias("features"))
    )
    loss = _log_loss(F.col(LABEL), vector_to_array("probability")[1])
    losses = scored.groupBy("j").agg(F.avg(loss).alias("loss"))
    # The loss of the unchanged rows, over the few aggregated rows instead of a second pass.
    everything = Window.partitionBy(F.lit(0))
    base = F.max(F.when(F.col("j") == -1, F.col("loss"))).over(everything)
    gains = trees.featureImportances.toArray().tolist()
    names_column, gains_column = F.array(*map(F.lit, names)), F.array(*map(F.lit, gains))
    return (
        losses.withColumn("base", base)
        .filter("j >= 0")
        .select(
            F.get(names_column, F.col("j")).alias("feature"),
            F.get(gains_column, F.col("j")).alias("gain"),
            (F.col("loss") - F.col("base")).alias("loss_increase"),
        )
        .orderBy(F.desc("loss_increase"), F.desc("gain"), "feature")
    )


def with_risk_level(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("risk_level", risk_bucket(F.col("overrun_probability")))


def score_projects(model: Overrun, features: DataFrame) -> DataFrame:
    """Probability and level of every project."""
    scored = with_risk_level(predict(model, features))
    return stamp(scored.select(ID, "overrun_probability", "risk_level"), "scored_at")
