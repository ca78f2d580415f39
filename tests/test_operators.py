"""DataFrame operators on small frames."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from projectmart.operators import aggregates as A
from projectmart.operators.expect import expect, expect_or_drop, violations
from projectmart.operators.joins import enrich, orphan_rate, orphans
from projectmart.operators.keys import clean_keys, first_per_key, leading, of_keys, without_keys
from projectmart.operators.topk import top_k

ROWS = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, None), (None, 5, "z"), (None, 4, "z"), ("b", 3, "w")]


@pytest.fixture()
def keyed(spark):
    return spark.createDataFrame(ROWS, "k string, n int, t string")


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_clean_keys(keyed):
    assert {tuple(r) for r in clean_keys(keyed, "k").collect()} == {("a", 1, None), ("b", 3, "w")}


def test_first_per_key_keeps_one_row_without_key(keyed):
    found = {tuple(r) for r in first_per_key(keyed, ["k"]).collect()}
    assert found == {("a", 1, None), ("b", 3, "w"), (None, 4, "z")}


def test_explicit_order(keyed):
    found = {tuple(r) for r in clean_keys(keyed, "k", ["t"]).collect()}
    assert found == {("a", 1, None), ("b", 3, "w")}


def test_dedup_is_idempotent_and_independent_of_row_order(spark, keyed):
    once = clean_keys(keyed, "k")
    assert sorted(once.collect(), key=str) == sorted(clean_keys(once, "k").collect(), key=str)
    backwards = spark.createDataFrame(list(reversed(ROWS)), keyed.schema).repartition(3)
    assert sorted(once.collect(), key=str) == sorted(clean_keys(backwards, "k").collect(), key=str)


def test_hot_key_is_cut_before_the_shuffle(keyed):
    text = plan(first_per_key(keyed, ["k"]))
    partial = text.rindex("WindowGroupLimit")
    assert "Partial" in text[partial : partial + 200]
    assert text.rindex("Exchange hashpartitioning") < partial


def test_key_filter_after_the_dedup_moves_below_it(keyed):
    optimized = first_per_key(keyed, ["k"]).filter("k IS NOT NULL")
    text = optimized._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Window ") < text.index("isnotnull(k")


def test_clean_keys_keeps_the_rows_of_the_window(spark):
    draw = random.Random(8)
    cells = [None, "", "a", "B", "\u00e4"]
    rows = [(draw.choice("pqrst"), draw.choice([None, -1.5, 0.0, 2.0, float("nan")]), draw.choice(cells)) for _ in range(200)]
    df = spark.createDataFrame([*rows, (None, 1.0, "a")], "k string, n double, `t.x` string")
    kept, window = clean_keys(df, "k"), first_per_key(df.dropna(subset=["k"]).withColumnRenamed("t.x", "t"), ["k"])
    assert kept.columns == df.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, map(tuple, window.collect())))
    assert clean_keys(df.select("k"), "k").count() == 5


def test_health_of_clean_keys_moves_the_keys_alone(keyed):
    report = A.key_health(clean_keys(keyed, "k"), "k")
    assert tuple(report.first()) == (2, 0, 0)
    text = report._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text and "_row" not in text


def test_what_follows_the_last_column_read_decides_nothing(spark):
    draw = random.Random(3)
    pool = (None, 0, 1)
    rows = [(draw.choice("pqr"), draw.choice(pool), draw.choice(pool), draw.choice(pool), draw.choice("xy")) for _ in range(60)]
    df = spark.createDataFrame(rows, "k string, a int, b int, c int, d string")
    whole = clean_keys(df, "k")
    for read in ((), ("a",), ("b",), ("b", "a"), ("c",), ("d",)):
        found = clean_keys(leading(df, "k", read), "k").select("k", *read)
        assert sorted(found.collect(), key=str) == sorted(whole.select("k", *read).collect(), key=str)


def test_dedup_on_a_hot_key(spark):
    hot = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    kept = clean_keys(hot, "k")
    assert kept.count() == 20001
    assert kept.filter("k = 0").collect()[0]["v"] == 0


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = {"positive": F.col("x") > 0, "known": F.col("x").isNotNull()}
    report = {r["rule"]: (r["rows"], r["violations"]) for r in violations(df, rules).collect()}
    assert report == {"positive": (3, 2), "known": (3, 1)}
    assert [r[0] for r in expect_or_drop(df, rules).collect()] == [1]
    assert expect(df, rules).count() == 3
    lenient = violations(df, rules, null_passes=True).collect()
    assert {r["rule"]: r["violations"] for r in lenient} == {"positive": 1, "known": 1}


def test_expectations_are_observed_in_the_same_pass(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    seen = Observation()
    kept = expect_or_drop(df, {"positive": F.col("x") > 0}, observation=seen)
    assert kept.count() == 1
    assert seen.get == {"rows": 3, "positive": 2}


def test_unknown_keys_do_not_join(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    dim = spark.createDataFrame([("a", "A"), (None, "N")], "k string, name string")
    assert {tuple(r) for r in enrich(fact, dim, "k", ["name"]).collect()} == {
        ("a", 1, "A"), (None, 2, None),
    }


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r["k"] for r in orphans(child, parent, "k").collect()] == ["x", "x"]
    row = orphan_rate(child, parent, "k").collect()[0]
    assert (row["rows"], row["orphans"], row["orphan_pct"]) == (3, 2, 66.67)
    empty = orphan_rate(child.filter("k = 'none'"), parent, "k").collect()[0]
    assert (empty["rows"], empty["orphans"], empty["orphan_pct"]) == (0, 0, 0.0)


def test_no_broadcast_hint_on_dimensions(spark):
    fact = spark.createDataFrame([("a", 1)], "k string, v int")
    dim = spark.createDataFrame([("a", "A")], "k string, name string")
    assert "hint" not in plan(enrich(fact, dim, "k", ["name"])).lower()


def test_key_health(keyed):
    assert tuple(A.key_health(keyed, "k").collect()[0]) == (6, 2, 2)
    assert {r["k"]: r["n"] for r in A.duplicate_key_groups(keyed, "k").collect()} == {
        "a": 3, None: 2,
    }


def test_key_health_of_an_empty_table(keyed):
    assert tuple(A.key_health(keyed.filter("n > 100"), "k").collect()[0]) == (0, 0, 0)


def test_money_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9] * 50
    one = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    many = spark.createDataFrame([(v,) for v in sorted(values)], "x double").repartition(7)
    sums = {df.agg(A.money_sum(F.col("x"))).collect()[0][0] for df in (one, many)}
    assert sums == {30.0}


def test_top_k(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", 3)], "k string, v int")
    assert [r["k"] for r in top_k(df, "v", 2, tie_break=("k",)).collect()] == ["d", "a"]
    assert [r["k"] for r in top_k(df, "v", 2, ascending=True, tie_break=("k",)).collect()] == [
        "c", "a",
    ]
    assert "TakeOrderedAndProject" in plan(top_k(df, "v", 2))


def test_money_total_equals_a_sum_of_casts(spark):
    draw, values = random.Random(1), []
    for _ in range(6000):
        v = draw.choice(
            [
                draw.random() * 10 ** draw.randint(-8, 18), round(draw.random() * 1e5, draw.randint(0, 6)),
                1.00005, 0.00005, 2.5e-5, 123456.78905, 1e13 + 0.5, 0.0, round(draw.random() * 100, 4) + 0.00005,
            ]
        )
        values.append((draw.choice([1, -1]) * v if draw.random() > 0.1 else None, draw.randrange(2000)))
    df = spark.createDataFrame([*values, (None, 5000)], "v double, k int").repartition(3)
    fast = df.groupBy("k").agg(A.money_total(F.col("v")).alias("s"))
    cast = df.groupBy("k").agg(F.sum(F.col("v").cast("decimal(28,4)")).cast("decimal(38,4)").alias("s"))
    assert fast.exceptAll(cast).count() == 0 and fast.count() == cast.count()
    assert fast.filter("s IS NULL").count() >= 1
    # Far beyond what one whole number holds.
    large = spark.range(200_000).select(F.lit(9.9e10).alias("v"), F.lit(1).alias("k"))
    total = large.groupBy("k").agg(A.money_total(F.col("v")).cast("string").alias("s")).first()["s"]
    assert total == "19800000000000000.0000"


def test_a_summary_of_keys_loses_no_row_and_leaves_the_others_in_place(spark):
    rows = [(f"k{i % 300}", i) for i in range(900)] + [(None, -1)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    for wanted in ([], ["k1", "k7", "k299", "other"], [f"k{i}" for i in range(300)]):
        keys = spark.createDataFrame([(k,) for k in wanted], "k string")
        kept, looked_up = without_keys(df, "k", keys)
        left = sorted((r[1], r[0]) for r in kept.unionByName(looked_up).collect())
        assert left == sorted((v, k) for k, v in rows if k not in wanted)
        assert {tuple(r) for r in of_keys(df, "k", keys).collect()} == {r for r in rows if r[0] in wanted}
        assert "Exchange hashpartitioning(k#" not in plan(kept)
