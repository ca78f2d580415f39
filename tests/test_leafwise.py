"""Best-first trees against plain sums, a walk down the nodes, and the level-wise trees."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from projectmart.plans import explain, leafwise

INPUTS = ("a", "b", "c")


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(4)
    out = []
    for i in range(1500):
        a, b, c = draw.random(), draw.random(), draw.choice([None, draw.random(), float("nan")])
        y = int(0.5 * a + b * b + (0.2 if c is None else 0) + draw.gauss(0, 0.1) > 0.7)
        out.append((f"r{i}", a, b, c, y, 0.7 if y else 1.4, i % 5 == 0))
    return spark.createDataFrame(
        out, "id string, a double, b double, c double, y int, w double, test boolean"
    ).repartition(4)


@pytest.fixture(scope="module")
def fitted(rows):
    training = rows.filter("NOT test")
    return leafwise.fit(training, INPUTS, "y", "w", rounds=12, rate=0.3, leaves=8, depth=4)


def loss(scored):
    p = F.least(F.greatest("p", F.lit(1e-12)), F.lit(1 - 1e-12))
    return scored.agg(F.avg(-F.log(F.when(F.col("y") == 1, p).otherwise(1 - p)))).first()[0]


def test_histogram_and_best_split_equal_plain_sums(rows):
    edges = leafwise.bin_edges(rows, INPUTS, 8)
    assert all(e == sorted(set(e)) and 1 <= len(e) <= 7 for e in edges)
    state = rows.select("*", leafwise.binned(rows, INPUTS, edges).alias("bins"))
    plain = state.collect()
    for r in plain:
        for name, of, b in zip(INPUTS, edges, r["bins"]):
            v = r[name]
            assert b == (len(of) if v is None or math.isnan(v) else sum(e < v for e in of))
    g, h = F.col("y") - F.lit(0.25), F.col("w")
    sums = leafwise.histogram(state, F.lit(0), g, h)
    assert sums.agg(F.sum("n")).first()[0] == 3 * len(plain)
    best = None
    for f, of in enumerate(edges):
        for b in range(len(of)):
            side = [r for r in plain if r["bins"][f] <= b]
            other = [r for r in plain if r["bins"][f] > b]
            if min(len(side), len(other)) < leafwise.LEAST_ROWS:
                continue

            def worth(part):
                return sum(r["y"] - 0.25 for r in part) ** 2 / (sum(r["w"] for r in part) + leafwise.RIDGE)

            gain = worth(side) + worth(other) - worth(plain)
            best = max(best or (gain, f, b, len(side)), (gain, f, b, len(side)))
    split = leafwise.best_splits(sums)[0]
    assert split.gain == pytest.approx(best[0])
    assert (split.feature, split.bin, split.sides[0][2]) == best[1:]


def test_a_split_at_a_whole_number(spark):
    rows = spark.range(400).select(
        F.col("id").alias("n"), (F.col("id") > 150).cast("int").alias("y"), F.lit(1.0).alias("w")
    )
    edges = leafwise.bin_edges(rows, ["n"], 8)
    assert all(type(e) is float for e in edges[0])
    model = leafwise.fit(rows, ["n"], "y", "w", rounds=1, leaves=2)
    root = model.nodes(spark).filter("id = 0").first()
    assert root["feature"] == 0 and root["threshold"] in edges[0] and root["cover"] == 400


def test_the_best_splits_come_first():
    def split(gain):
        return leafwise.Split(gain, 0, 0, ((0, 1, 5), (0, 1, 5)))

    splits = {0: split(5), 1: split(1), 2: split(4), 5: split(3), 6: split(0.5), 11: split(9), 3: split(2)}
    assert set(leafwise.chosen(splits, 5)) == {0, 2, 5, 11}
    assert set(leafwise.chosen(splits, 2)) == {0}
    assert set(leafwise.chosen(splits, 99)) == set(splits)
    assert leafwise.chosen({}, 5) == {}


def test_trees_have_few_leaves_and_scores_equal_a_walk(spark, rows, fitted):
    assert len(fitted.trees) == 12
    for tree in fitted.trees:
        leaves = [n for n in tree if n[2] < 0]
        assert 2 <= len(leaves) <= 8 and len(tree) == 2 * len(leaves) - 1
        assert sum(n[7] for n in leaves) == tree[0][7] == rows.filter("NOT test").count()
    for r in rows.select("*", leafwise.raw_score(fitted).alias("score")).limit(200).collect():
        x = [float("nan") if r[c] is None else r[c] for c in INPUTS]
        total = fitted.base
        for tree in fitted.trees:
            at = tree[0]
            while at[2] >= 0:
                at = tree[at[2] if x[at[4]] <= at[5] else at[3]]
            total += at[6]
        assert r["score"] == pytest.approx(total)


def test_loss_is_not_above_that_of_level_wise_trees(rows, fitted):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    known = rows.fillna(2.0)
    level_wise = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(INPUTS), outputCol="features", handleInvalid="keep"),
            GBTClassifier(labelCol="y", weightCol="w", maxIter=12, maxDepth=4, stepSize=0.3, seed=1),
        ]
    ).fit(known.filter("NOT test"))
    other = level_wise.transform(known.filter("test")).withColumn("p", vector_to_array("probability")[1])
    ours = rows.filter("test").withColumn("p", leafwise.probability(fitted))
    assert loss(ours) <= loss(other)
    assert loss(ours) < 0.9 * loss(ours.withColumn("p", F.lit(0.5)))


def test_values_of_best_first_trees_add_up(spark, rows, fitted):
    leaves = explain.tree_leaves(fitted.nodes(spark))
    some = rows.limit(50)
    x = F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in INPUTS]).alias("x")
    found = {r["id"]: r["shapley"] for r in explain.explain(some.select("id", x), leaves, 3).collect()}
    base = fitted.base + explain.base_value(leaves)
    for r in some.select("id", leafwise.raw_score(fitted).alias("score")).collect():
        assert base + sum(found[r["id"]]) == pytest.approx(r["score"])


def test_one_class_is_refused(rows):
    with pytest.raises(ValueError):
        leafwise.fit(rows.filter("y = 1"), INPUTS, "y", "w", rounds=1)
