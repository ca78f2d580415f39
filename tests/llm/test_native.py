"""Quality rules, line dedup and URL filter."""

from __future__ import annotations

import brute
from pyspark.sql import functions as F

from projectmart.llm import line_dedup, quality, url_filter

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def test_quality_counts(frame, corpus, odd):
    rows = corpus + [(100_000 + d, t) for d, t in odd]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in quality.judge(frame(rows)).collect()}
    assert got == {doc: brute.quality_base(text) for doc, text in rows}


def test_quality_filter_keeps_columns_and_clean_texts(spark, small, frame, odd):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    judged = quality.judge(docs).join(labels, "doc_id")
    clean = judged.filter("quality = 1 AND NOT base_failed")
    assert clean.filter("NOT kept").count() == 0
    junk = judged.filter("quality = 0")
    assert junk.filter("kept").count() <= 0.05 * junk.count()
    kept = quality.filter_documents(frame(odd))
    assert kept.columns == frame(odd).columns
    assert kept.filter("key <> 'key' OR kept IS NOT NULL OR n_words <> 7").count() == 0
    assert quality.filter_documents(frame(odd).limit(0)).count() == 0


def test_quality_filter_stays_above_the_metrics(frame, odd):
    plan = quality.filter_documents(frame(odd))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") <= 2


def test_line_dedup(frame, corpus, odd):
    for rows in (corpus, odd):
        out = line_dedup.dedup_lines(frame(rows))
        got = {
            r["doc_id"]: (r["n_lines"], r["n_dropped"], r["sha"])
            for r in out.withColumn("sha", F.sha2("kept_text", 256)).collect()
        }
        assert got == brute.line_dedup(rows)
    assert sum(dropped for _, dropped, _ in got.values()) == 11


def test_line_dedup_odd_rows(frame):
    line = "a line of more than forty characters, in many rows"
    # Copies of a row count once; a null id is a document, the smallest.
    rows = [(1, line)] * 6 + [(2, line), (3, line), (None, line)]
    out = line_dedup.dedup_lines(frame(rows)).collect()
    assert len(out) == 9 and all(r["n_dropped"] == 0 for r in out)
    rows.append((4, f"{line}\nb"))
    out = {(r["doc_id"], r["kept_text"]) for r in line_dedup.dedup_lines(frame(rows)).collect()}
    assert out == {(None, ""), (1, ""), (2, ""), (3, ""), (4, f"{line}\nb")}
    assert line_dedup.dedup_lines(frame([])).count() == 0


def test_keep_bitmap_is_run_lengths(frame, tmp_path):
    line = "a line of more than forty characters, in many rows"
    rows = [(i, f"x\n{line}\n{line}\ny\nz") for i in range(5)]
    bitmaps = line_dedup.keep_bitmaps(frame(rows), str(tmp_path)).collect()
    assert len(bitmaps) == 4
    assert all([tuple(x) for x in r["keep_runs"]] == [(0, 1), (3, 2)] for r in bitmaps)


def url_rows(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url")
    odd = [
        None, "", "example.net/en/", "http://", "http://NET/x", "http://a.Example.NET/en/y?q#f",
        "http://example.net", "http://xnet/", "http://a.net?x=/en/", "ftp://b.org/fr/?a=1&b=2",
        "http://example.com/de/://example.net/en/", "http://ÉA.com/de/#", "x://a\nb.net/c\nd",
    ]
    odd = spark.createDataFrame([(-i - 1, u) for i, u in enumerate(odd)], "page_id bigint, url string")
    return pages.union(odd)


def test_url_rules(spark, small):
    pages = url_rows(spark, small)
    rules = [url_filter.HostRule(*r) for r in RULES]
    rows = url_filter.judge(pages, rules, None).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path = brute.url_parts(r["url"])
        assert (r["host"], r["path"]) == (host, path)
        rule, verdict = brute.url_rule(host, path, RULES)
        assert r["rule"] == rule and r["verdict"] == (verdict or "allow")


def test_url_trees_on_held_out_urls(spark):
    clean = [(f"https://www.{w}{i}.example.com/en/{i}", 0) for i in range(300) for w in ("thon", "re")]
    bad = [(f"http://best-cheap-{i}-pills-4u.example.biz/x/{i}?a=1&b=2&c={i}", 1) for i in range(150)]
    rows = spark.createDataFrame(clean + bad, "url string, label int")
    train = rows.filter(F.pmod(F.xxhash64("url"), F.lit(2)) == 0)
    held = rows.filter(F.pmod(F.xxhash64("url"), F.lit(2)) == 1)
    trained = url_filter.train(train, max_rows=200, rounds=5)
    judged = url_filter.judge(held, [], trained).select(F.col("_row.label").alias("label"), "verdict")
    right = judged.filter((F.col("label") == 1) == (F.col("verdict") == "block")).count()
    assert right >= 0.95 * judged.count()
    assert url_filter.train(rows.filter("label = 0")) is None
    assert url_filter.judge(held.limit(0), [], trained).count() == 0
