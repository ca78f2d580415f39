"""The sample that the trees of the URL filter are fitted on."""

from __future__ import annotations

from pyspark.sql import functions as F

from projectmart.llm import queries, url_filter


def test_sample_of_repeated_urls(spark):
    n = F.col("id")
    good = spark.range(30_000).select(F.concat(F.lit("https://www.example.com/en/"), n).alias("url"), F.lit(0).alias("label"))
    hot = spark.range(20_000).select(F.lit("https://hot.example.com/").alias("url"), F.lit(0).alias("label"))
    bad = spark.range(50_000).select(F.concat(F.lit("http://cheap-pills.example.biz/?x="), n % 20).alias("url"), F.lit(1).alias("label"))
    unknown = spark.range(100).select(F.concat(F.lit("http://unknown.org/"), n).alias("url"), F.lit(None).cast("int").alias("label"))
    rows = good.union(hot).union(bad).union(unknown)
    sample = url_filter.bounded_sample(rows, 200).collect()
    assert len(sample) == len(set(sample)) == 120
    assert sum(r["label"] for r in sample) == 20
    assert not any("unknown" in r["url"] for r in sample)
    trained = url_filter.train(rows, max_rows=200, rounds=3)
    judged = url_filter.judge(bad.union(good.limit(500)), [], trained)
    wrong = judged.filter((F.col("_row.label") == 1) != (F.col("verdict") == "block"))
    assert wrong.count() == 0


def test_no_model_without_both_labels(spark):
    rows = spark.createDataFrame([("http://a.b/", 0), ("http://c.d/", None)], "url string, label int")
    assert url_filter.train(rows) is None


def test_what_has_no_host_has_no_label(spark):
    urls = [(None,), ("",), ("no scheme",), ("http:///path",), ("http://a.example/",), ("https://www.spam-farm.example/x",)]
    labels = {r["url"]: r["label"] for r in queries.seeded(spark.createDataFrame(urls, "url string")).collect()}
    assert labels == {
        None: None, "": None, "no scheme": None, "http:///path": None, "http://a.example/": 0,
        "https://www.spam-farm.example/x": 1,
    }


def test_held_out_pages(spark):
    """Trees that saw two thirds of the labelled pages, judged by the rest."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    labelled = queries.seeded(pages)
    third = F.pmod(F.xxhash64("url", F.lit(7)), F.lit(3)) == 0
    judged = url_filter.judge(labelled.filter(third), [], url_filter.train(labelled.filter(~third)))
    rows = judged.select(F.col("_row.label").alias("label"), (F.col("verdict") == "block").alias("blocked")).collect()
    clean = [r["blocked"] for r in rows if r["label"] == 0]
    bad = [r["blocked"] for r in rows if r["label"] == 1]
    assert len(bad) >= 5 and len(clean) >= 500
    assert sum(clean) <= 0.1 * len(clean) and sum(bad) >= 0.7 * len(bad)
