"""Arrival order, refresh of what changed, streams with state and counts, and counts that add up."""

from __future__ import annotations

import datetime
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from projectmart.operators import distinct as D
from projectmart.operators.joins import enrich, enrich_hot, hot_keys, orphans
from projectmart.operators.keys import clean_keys
from projectmart.plans import declarative, incremental, pipeline
from projectmart.sources.arrival import ARRIVAL, with_arrival
from projectmart.sources.schemas import RAW_SCHEMAS
from projectmart.sources.tables import Layers, ensure_namespaces, save, scan, shared_folder
from projectmart.streaming.ingest import ingest_checked, ingest_unique


def fresh(spark, prefix):
    layers = Layers(prefix, shared_folder(spark))
    ensure_namespaces(spark, layers)
    return layers


def written_at(folder, seconds):
    """Pretend that the files of a folder were written then."""
    for file in Path(folder).glob("*.parquet"):
        os.utime(file, (seconds, seconds))


def test_the_first_arrived_row_survives_across_files(spark, tmp_path):
    deliveries = {
        "c": [("k1", 9), ("k2", 1), ("k2", 0)],
        "a": [("k1", 1), ("k3", 5)],
        "b": [("k3", 0), (None, 1), ("k4", 2), ("k4", 2)],
    }
    # The delivery that is last by name and largest by value came first.
    for nth, (name, rows) in enumerate(deliveries.items()):
        spark.createDataFrame(rows, "k string, n int").coalesce(1).write.parquet(f"{tmp_path}/{name}")
        written_at(f"{tmp_path}/{name}", 1_000_000 + 60 * nth)
    raw = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path))
    found = clean_keys(with_arrival(raw), "k", [ARRIVAL]).drop(ARRIVAL)
    assert sorted(map(tuple, found.collect())) == [("k1", 9), ("k2", 1), ("k3", 5), ("k4", 2)]


def test_arrival_decides_in_the_silver_table(spark):
    layers = fresh(spark, "arrival_")
    schema = RAW_SCHEMAS["dim_employee"]
    for rows in ([("E-1", "Zoe", "foreman", "design")], [("E-1", "Adam", "foreman", "design"), ("E-2", "Bo", "mgr", "")]):
        save(spark.createDataFrame(rows, schema).coalesce(1), layers, "bronze", "dim_employee", mode="append")
    # Both were written within a moment: let a minute pass between them.
    files = sorted(Path(layers.folder("bronze", "dim_employee")).glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    for nth, file in enumerate(files):
        os.utime(file, (1_000_000 + 60 * nth,) * 2)
    spark.catalog.refreshTable(layers.name("bronze", "dim_employee"))
    others = {t: spark.createDataFrame([], s) for t, s in RAW_SCHEMAS.items() if t != "dim_employee"}
    for table, df in others.items():
        save(df, layers, "bronze", table)
    names = {}
    for by_arrival in (True, False):
        pipeline.build_silver(spark, layers, by_arrival=by_arrival)
        clean = scan(spark, layers, "silver", "dim_employee")
        assert ARRIVAL not in clean.columns
        names[by_arrival] = {r["employee_id"]: r["full_name"] for r in clean.collect()}
    assert names == {True: {"E-1": "Zoe", "E-2": "Bo"}, False: {"E-1": "Adam", "E-2": "Bo"}}


def cost(key, project, month, budget, category="labour"):
    return (key, project, category, budget, budget, budget / 2 if budget else None, 0.0, month)


def files_of(layers, layer, table):
    root = Path(layers.folder(layer, table))
    return {f: f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


def partition_of(file):
    return file.parent.name.split("=")[1]


@pytest.fixture()
def costs(spark):
    """A mart of three months and of lines without a month."""
    layers = fresh(spark, f"inc{random.randrange(10**9)}_")
    projects = spark.createDataFrame(
        [("P-1", "one", "road"), ("P-2", "two", "house")],
        "project_id string, project_name string, project_type_clean string",
    )
    save(projects, layers, "silver", "dim_projects")
    rows = [cost(f"C-{m}-{i}", f"P-{i % 3}", f"2024-0{m}-01", 10.0 * i) for m in (1, 2, 3) for i in range(9)]
    rows += [cost("C-x", "P-1", "no month", 5.0), cost(None, "P-1", "2024-01-01", 1.0), cost("C-y", "P-1", "2024-01", None)]
    table = "fact_project_costs"
    save(spark.createDataFrame(rows, RAW_SCHEMAS[table]), layers, "bronze", table)
    incremental.build_partitioned(spark, layers, "gold_cost_variance_monthly")

    def append(more):
        new = spark.createDataFrame(more, RAW_SCHEMAS[table])
        save(new, layers, "bronze", table, mode="append")
        before = files_of(layers, "gold", "gold_cost_variance_monthly")
        changed = incremental.refresh_changed(spark, layers, "gold_cost_variance_monthly", new)
        after = files_of(layers, "gold", "gold_cost_variance_monthly")
        touched = {partition_of(f) for f in before.keys() ^ after.keys()}
        raw = scan(spark, layers, "bronze", table)
        clean = declarative.silver_table(table, raw)
        full = declarative.cost_variance_monthly(
            {table: clean, "dim_projects": scan(spark, layers, "silver", "dim_projects")}
        )
        stored = scan(spark, layers, "gold", "gold_cost_variance_monthly").select(full.columns)
        assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0
        silver = scan(spark, layers, "silver", table)
        assert silver.count() == clean.count()
        return changed, touched

    return append


def test_an_append_to_one_month_rewrites_one_month(costs):
    assert costs([cost("C-new", "P-2", "2024-02-01", 7.0)]) == (["2024-02"], {"2024-02"})
    assert costs([cost("C-may", "P-1", "2024-05-01", 7.0)]) == (["2024-05"], {"2024-05"})


def test_a_row_that_wins_an_old_key_moves_its_month(costs):
    # The smaller budget comes first in the order of all columns, so the new row stays.
    changed, touched = costs([cost("C-3-8", "P-2", "2024-01-01", -99.0)])
    assert changed == ["2024-01", "2024-03"] and touched == {"2024-01", "2024-03"}
    # This one loses, so nothing but its month is written again, to the same rows.
    changed, _ = costs([cost("C-3-7", "P-9", "2024-09-01", 10.0**6)])
    assert changed == ["2024-03"]


def test_a_month_that_loses_its_last_row_goes(costs):
    costs([cost("D-1", "P-1", "2024-07-01", 50.0)])
    changed, touched = costs([cost("D-1", "P-0", "2024-08-01", 40.0)])
    assert changed == ["2024-07", "2024-08"] and touched == {"2024-07", "2024-08"}
    # An unknown budget comes first and breaks an expectation: the key is gone.
    changed, _ = costs([cost("D-1", "P-0", "2024-08-01", None)])
    assert changed == ["2024-08"]
    # Lines without a month have a partition too.
    changed, _ = costs([cost("C-x", "P-0", "2024-01-01", 1.0)])
    assert changed == ["2024-01", None]


def test_a_refresh_that_fails_half_way_can_run_again(costs, monkeypatch):
    replace, calls = incremental._replace, []

    def failing(df, layers, layer, *rest):
        calls.append(layer)
        if layer == "silver" and calls.count("silver") == 1:
            raise RuntimeError("lost")
        replace(df, layers, layer, *rest)

    monkeypatch.setattr(incremental, "_replace", failing)
    row = cost("C-2-3", "P-0", "2024-01-01", -99.0)
    with pytest.raises(RuntimeError):
        costs([row])
    # The row is in the raw table twice now; the second try moves it all the same.
    assert costs([row])[0] == ["2024-01", "2024-02"]
    assert calls == ["gold", "silver", "gold", "silver"]


def test_nothing_new_rewrites_nothing(costs):
    assert costs([]) == ([], set())
    assert costs([cost(None, "P-1", "2024-01-01", 1.0)]) == ([], set())


def test_refresh_from_a_stream_reads_each_file_once(spark):
    layers = fresh(spark, "streamed_refresh_")
    projects = spark.createDataFrame(
        [("P-1", "one")], "project_id string, project_name string"
    )
    save(projects, layers, "silver", "dim_projects")
    table, mart = "fact_schedule_milestones", "gold_schedule_kpi"
    checkpoint = f"{shared_folder(spark)}/checkpoint"

    def deliver(rows):
        full = [(k, p, "m", z, "2024-01-01", None, "2024-01-05", 0, s) for k, p, z, s in rows]
        save(spark.createDataFrame(full, RAW_SCHEMAS[table]), layers, "bronze", table, mode="append")
        source = layers.folder("bronze", table)
        return incremental.refresh_from_stream(spark, layers, mart, source, checkpoint)

    assert deliver([(f"M-{i}", f"P-{i}", "z1", "complete") for i in range(40)]) == []
    assert deliver([("N-1", "P-1", "z2", "complete"), ("N-2", "P-1", "z2", "delayed")])[0] != []
    source = layers.folder("bronze", table)
    assert incremental.refresh_from_stream(spark, layers, mart, source, checkpoint) == []
    clean = declarative.silver_table(table, scan(spark, layers, "bronze", table))
    full = declarative.schedule_kpi({table: clean, "dim_projects": projects})
    stored = scan(spark, layers, "gold", mart).select(full.columns)
    assert stored.exceptAll(full).count() == 0 and stored.count() == full.count() == 41


EVENT = "k string, at timestamp, n int"


def event(key, minute, n):
    return (key, datetime.datetime(2024, 1, 1, minute // 60, minute % 60), n)


def test_duplicates_over_batches_and_restarts_leave_one_row(spark, tmp_path):
    source, schema = f"{tmp_path}/source", spark.createDataFrame([], EVENT).schema
    arguments = (source, f"{tmp_path}/sink", f"{tmp_path}/checkpoint", schema, "k")
    options = {"event_time": "at", "delay": "30 minutes", "max_files": 1}

    def deliver(*rows):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(source)

    deliver(event("a", 0, 1), event("b", 1, 1), event("a", 2, 2))
    deliver(event("b", 3, 2), event("c", 4, 1))
    found, late = ingest_unique(spark, *arguments, **options)
    assert sorted(r["k"] for r in found.collect()) == ["a", "b", "c"] and late == 0
    # The state outlives the query: a restart still knows the keys.
    deliver(event("a", 10, 3), event("d", 120, 1))
    found, late = ingest_unique(spark, *arguments, **options)
    assert sorted(r["k"] for r in found.collect()) == ["a", "b", "c", "d"] and late == 0
    # Two hours on, what is older than the watermark is late and dropped, known or not.
    deliver(event("e", 5, 1), event("a", 6, 4), event("f", 121, 1))
    found, late = ingest_unique(spark, *arguments, **options)
    assert sorted(r["k"] for r in found.collect()) == ["a", "b", "c", "d", "f"] and late == 2


def test_without_event_time_the_file_time_counts(spark, tmp_path):
    source, schema = f"{tmp_path}/source", spark.createDataFrame([], EVENT).schema
    arguments = (source, f"{tmp_path}/sink", f"{tmp_path}/checkpoint", schema, "k")
    for n in (1, 2):
        spark.createDataFrame([event("a", 0, n), event(None, 0, n)], EVENT).write.mode("append").parquet(source)
        found, _ = ingest_unique(spark, *arguments, delay="1 hour")
    assert sorted(str(r["k"]) for r in found.collect()) == ["None", "a"]
    assert found.columns == ["k", "at", "n"]


def test_counts_of_every_batch_add_up_to_the_batch_count(spark, tmp_path):
    schema = RAW_SCHEMAS["fact_subcontractor_performance"]
    draw, rows = random.Random(3), []
    for i in range(60):
        scores = [draw.choice([None, -1, 0, 5, 11]) for _ in range(4)]
        rows.append((draw.choice([None, f"E-{i}"]), "V", "P", "2024-01-01", *scores, 1.0, "yes"))
    whole = spark.createDataFrame(rows, schema)
    rules = declarative.required_rules()["fact_subcontractor_performance"] | {
        f"{c}_in_range": F.col(f"{c}_raw").between(1, 10) | F.col(f"{c}_raw").isNull()
        for c in ("quality", "safety")
    }

    def clean(df):
        return df.withColumns({f"{c}_raw": F.col(f"{c}_score") for c in ("quality", "safety")})

    arguments = (f"{tmp_path}/source", f"{tmp_path}/sink", f"{tmp_path}/checkpoint", schema, rules)
    seen, batches = {}, []
    for low in range(0, 60, 20):
        part = spark.createDataFrame(rows[low : low + 20], schema)
        part.coalesce(2).write.mode("append").parquet(f"{tmp_path}/source")
        sink, report = ingest_checked(spark, *arguments, clean=clean, max_files=1)
        for r in report.collect():
            seen[r["rule"]] = seen.get(r["rule"], 0) + r["violations"]
            batches.append((r["batch"], r["rule"]))
    assert sink.columns == schema.fieldNames() and sink.exceptAll(whole).count() == 0 and sink.count() == 60
    want = clean(whole).agg(*[F.count_if(~F.coalesce(p, F.lit(False))).alias(n) for n, p in rules.items()])
    assert seen == want.first().asDict() and min(seen.values()) > 0
    # A batch has its own numbers; none is reported twice.
    assert len(batches) == len(set(batches)) and len({b for b, _ in batches}) >= 3


def test_months_add_up_to_years_without_expand(spark):
    draw = random.Random(5)
    rows = [
        (draw.choice(["a", "b", None]), f"2024-0{draw.randint(1, 9)}", draw.choice([None, draw.randrange(200_000)]), draw.randrange(50))
        for _ in range(4000)
    ]
    df = spark.createDataFrame(rows, "g string, month string, big int, few int").repartition(5)
    ids = {"big": F.col("big"), "few": F.col("few")}
    exact = {
        g: tuple(len({r[c] for r in rows if r[0] == g and r[c] is not None}) for c in (2, 3))
        for g in ("a", "b", None)
    }
    mart = D.bitmap_mart(df, ["g", "month"], ids)
    counts = D.bitmap_counts(mart, ["g"], ["big", "few"])
    assert {r["g"]: (r["big"], r["few"]) for r in counts.collect()} == exact
    assert "Expand" not in counts._jdf.queryExecution().toString()
    direct = df.groupBy("g").agg(F.count_distinct("big"), F.count_distinct("few"))
    assert "Expand" in direct._jdf.queryExecution().toString()
    sketches = D.sketch_mart(df, ["g", "month"], ids)
    for r in D.sketch_counts(sketches, ["g"], ["big", "few"]).collect():
        for near, n in zip((r["big"], r["few"]), exact[r["g"]]):
            assert abs(near - n) <= 0.08 * n
    assert D.bitmap_counts(D.bitmap_mart(df.limit(0), ["g"], ids), ["g"], ["big"]).count() == 0


def test_dense_ids_have_no_gaps(spark):
    values = [f"v{i:03}" for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values * 3] + [(None,)], "v string").repartition(7)
    numbered = {r["value"]: r["id"] for r in D.dense_ids(df, "v").collect()}
    assert numbered == {v: i for i, v in enumerate(values)}
    named = D.with_id(df, "v", D.dense_ids(df, "v"))
    assert named.count() == 901 and named.filter("v_number IS NULL").count() == 1


@pytest.fixture()
def plain_shuffles(spark):
    """Partitions as they are dealt, without repairs at run time."""
    changed = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_hot_key_is_dealt_over_the_tasks(spark, plain_shuffles):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 9 == 1, None).otherwise(F.col("id") % 5003)
    fact = spark.range(0, n, 1, 8).select(key.cast("string").alias("k"), "id")
    dim = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("twice"))
    hot = hot_keys(fact, "k", 16).collect()
    assert [r["k"] for r in hot] == ["7"]
    joined = enrich_hot(fact, dim, "k", ["twice"])
    plain = enrich(fact, dim, "k", ["twice"])
    assert joined.exceptAll(plain.select(joined.columns)).count() == 0 and joined.count() == n

    def largest(df):
        sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return sizes[-1], sizes[len(sizes) // 2]

    most, median = largest(joined)
    assert most <= 2 * median
    most, median = largest(plain)
    assert most > 3 * median
    missing = orphans(fact, dim, "k")
    assert missing.columns == ["k", "id"]
    want = fact.filter("k >= 5000 AND k IS NOT NULL").filter(F.col("k").cast("int") >= 5000)
    assert missing.count() == want.count() > 0 and missing.exceptAll(want).count() == 0
    assert enrich_hot(fact.limit(0), dim, "k", ["twice"]).count() == 0
