"""Boosted trees that grow best first: at most 31 leaves a tree, whichever way they are deep.

Numbers are put into bins once. For a level of a tree, one job adds up gradients by node, feature and
bin, takes running sums over the bins, and leaves the best split of every node; nothing but those splits
comes to the driver, at most one row per node. A split's gain does not depend on the order of splits, so the
best-first choice among all of a tree's splits is made afterwards. Scores grow with the rows and are
checkpointed every ten trees.

Nodes have the form of ``explain.tree_nodes``, so both kinds of trees are explained alike.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from projectmart.sources.tables import ensure_checkpoints

BINS = 32
LEAVES, DEPTH = 31, 6
LEAST_ROWS = 20
RIDGE = 1.0
CHECKPOINT_EVERY = 10
NODES = (
    "tree int, id int, left int, right int, feature int, threshold double, value double,"
    " cover double, weight double"
)
TREE = (
    "array<struct<left:array<int>,right:array<int>,feature:array<int>,"
    "threshold:array<double>,value:array<double>>>"
)


@dataclass(frozen=True)
class Split:
    """The best split of a node: gain, where it goes, and (gradient, curvature, rows) of both sides."""

    gain: float
    feature: int
    bin: int
    sides: tuple[tuple[float, float, int], tuple[float, float, int]]


@dataclass(frozen=True)
class BestFirst:
    """Names of the inputs, the score without any tree, and the nodes of all trees."""

    inputs: tuple[str, ...]
    base: float
    trees: list[list[tuple]] = field(default_factory=list)

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([n for tree in self.trees for n in tree], NODES)


def bin_edges(rows: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of the bins of every input, from mergeable quantile sketches in one pass."""
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    # As doubles, which thresholds are: the quantiles of whole numbers would be whole numbers.
    numbers = [F.col(c).cast("double") for c in inputs]
    known = [F.percentile_approx(F.when(~F.isnan(x), x), shares, F.lit(10_000)) for x in numbers]
    found = rows.agg(*[k.alias(f"e{i}") for i, k in enumerate(known)]).first()
    return [sorted(set(edges or [])) for edges in found]


def binned(rows: DataFrame, inputs: Sequence[str], edges: Sequence[Sequence[float]]) -> Column:
    """Bins of all inputs: how many edges lie below each; an unknown number is in the last bin."""

    def one(name: str, of: Sequence[float]) -> Column:
        value = F.coalesce(F.col(name).cast("double"), F.lit(float("nan")))
        return F.size(F.filter(F.array(*map(F.lit, of)).cast("array<double>"), lambda e: value > e))

    return F.array(*[one(n, e) for n, e in zip(inputs, edges)])


def histogram(rows: DataFrame, node: Column, gradient: Column, curvature: Column) -> DataFrame:
    """(node, feature, bin, g, h, n): sums over the rows (bins array<int>) of every node."""
    each = rows.select(
        node.alias("node"), gradient.alias("g"), curvature.alias("h"),
        F.posexplode("bins").alias("feature", "bin"),
    )
    return each.groupBy("node", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")
    )


def best_splits(sums: DataFrame) -> dict[int, Split]:
    """The split of largest gain of every node of a histogram that has one."""
    upto = Window.partitionBy("node", "feature").orderBy("bin")
    whole = Window.partitionBy("node", "feature")
    left = {c: F.sum(c).over(upto).alias(f"l{c}") for c in ("g", "h", "n")}
    total = {c: F.sum(c).over(whole).alias(f"t{c}") for c in ("g", "h", "n")}
    at = sums.select("node", "feature", "bin", *left.values(), *total.values())

    def worth(g: Column, h: Column) -> Column:
        return g * g / (h + RIDGE)

    right = {c: F.col(f"t{c}") - F.col(f"l{c}") for c in ("g", "h", "n")}
    gain = worth(F.col("lg"), F.col("lh")) + worth(right["g"], right["h"]) - worth(F.col("tg"), F.col("th"))
    fits = (F.col("ln") >= LEAST_ROWS) & (right["n"] >= LEAST_ROWS)
    order = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))
    best = (
        at.filter(fits)
        .groupBy("node")
        .agg(F.max(F.struct(order.alias("o"), "lg", "lh", "ln", "tg", "th", "tn")).alias("s"))
        .select("node", "s.o.*", "s.*")
    )
    return {
        r["node"]: Split(
            r["gain"], -r["f"], -r["b"],
            ((r["lg"], r["lh"], r["ln"]), (r["tg"] - r["lg"], r["th"] - r["lh"], r["tn"] - r["ln"])),
        )
        for r in best.collect()
        if r["gain"] > 1e-9
    }


def _placed(splits: Mapping[int, Split], at: int = 0) -> Column:
    """The node of a row; children of node k are 2k + 1 and 2k + 2."""
    if at not in splits:
        return F.lit(at)
    split = splits[at]
    goes_left = F.get("bins", F.lit(split.feature)) <= split.bin
    return F.when(goes_left, _placed(splits, 2 * at + 1)).otherwise(_placed(splits, 2 * at + 2))


def chosen(splits: Mapping[int, Split], leaves: int) -> dict[int, Split]:
    """The splits that best-first growth makes before it has ``leaves`` leaves."""
    kept: dict[int, Split] = {}
    heap = [(-splits[0].gain, 0)] if 0 in splits else []
    while heap and len(kept) + 1 < leaves:
        _, at = heapq.heappop(heap)
        kept[at] = splits[at]
        for child in (2 * at + 1, 2 * at + 2):
            if child in splits:
                heapq.heappush(heap, (-splits[child].gain, child))
    return kept


def _tree(tree: int, splits: Mapping[int, Split], edges, rate: float, whole) -> list[tuple]:
    """Nodes of a tree, numbered from 0, parents before children."""
    nodes: list[tuple | None] = []

    def add(at: int, sums: tuple[float, float, int]) -> int:
        number = len(nodes)
        nodes.append(None)
        g, h, n = sums
        if at in splits:
            s = splits[at]
            left, right = (add(2 * at + 1 + k, s.sides[k]) for k in (0, 1))
            threshold = edges[s.feature][s.bin]
            nodes[number] = (tree, number, left, right, s.feature, threshold, 0.0, float(n), 1.0)
        else:
            value = -rate * g / (h + RIDGE)
            nodes[number] = (tree, number, -1, -1, -1, None, value, float(n), 1.0)
        return number

    add(0, whole)
    return nodes


def _value(splits: Mapping[int, Split], sums, rate: float, at: int = 0) -> Column:
    if at not in splits:
        return F.lit(-rate * sums[0] / (sums[1] + RIDGE))
    s = splits[at]
    left, right = (_value(splits, s.sides[k], rate, 2 * at + 1 + k) for k in (0, 1))
    return F.when(F.get("bins", F.lit(s.feature)) <= s.bin, left).otherwise(right)


def fit(
    rows: DataFrame,
    inputs: Sequence[str],
    label: str,
    weight: str,
    *,
    rounds: int = 300,
    rate: float = 0.05,
    leaves: int = LEAVES,
    depth: int = DEPTH,
) -> BestFirst:
    """Trees on the logistic loss of ``label`` (0 or 1) with weighted rows."""
    ensure_checkpoints(rows.sparkSession)
    edges = bin_edges(rows, inputs)
    y, w = F.col(label).cast("double"), F.col(weight).cast("double")
    share = rows.agg((F.sum(y * w) / F.sum(w)).alias("p")).first()["p"]
    if share is None or share in (0.0, 1.0):
        raise ValueError("both classes are needed")
    model = BestFirst(tuple(inputs), math.log(share / (1 - share)))
    state = rows.select(
        binned(rows, inputs, edges).alias("bins"), y.alias("y"), w.alias("w"), F.lit(model.base).alias("score")
    ).checkpoint()
    p = 1 / (1 + F.exp(-F.col("score")))
    gradient, curvature = F.col("w") * (p - F.col("y")), F.col("w") * p * (1 - p)
    for tree in range(rounds):
        splits: dict[int, Split] = {}
        active, whole = [0], None
        for level in range(depth):
            here = state.withColumn("node", _placed(splits)).filter(F.col("node").isin(active))
            found = best_splits(histogram(here, F.col("node"), gradient, curvature))
            splits |= found
            if level == 0 and 0 in found:
                whole = tuple(a + b for a, b in zip(*found[0].sides))
            active = [c for at in found for c in (2 * at + 1, 2 * at + 2)]
            if not active:
                break
        if whole is None:
            break
        kept = chosen(splits, leaves)
        model.trees.append(_tree(tree, kept, edges, rate, whole))
        state = state.withColumn("score", F.col("score") + _value(kept, whole, rate))
        if (tree + 1) % CHECKPOINT_EVERY == 0:
            state = state.checkpoint()
    return model


def raw_score(model: BestFirst, depth: int = DEPTH) -> Column:
    """The score of a row, a walk down every tree as one expression over arrays."""
    columns = [
        {c: [n[i] for n in tree] for c, i in (("left", 2), ("right", 3), ("feature", 4), ("threshold", 5), ("value", 6))}
        for tree in model.trees
    ]
    trees = F.from_json(F.lit(json.dumps(columns)), TREE)
    nan = F.lit(float("nan"))
    x = F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in model.inputs])

    def walked(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            below = F.get(x, F.get(tree.feature, at)) <= F.get(tree.threshold, at)
            child = F.when(below, F.get(tree.left, at)).otherwise(F.get(tree.right, at))
            return F.when(F.get(tree.left, at) < 0, at).otherwise(child)

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)

    return F.aggregate(trees, F.lit(model.base), lambda total, t: total + F.get(t.value, walked(t)))


def probability(model: BestFirst) -> Column:
    return 1 / (1 + F.exp(-raw_score(model)))
