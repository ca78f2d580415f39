"""The operators as queries on the given tables, and their results as SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from projectmart.llm import (
    best_fit,
    decontamination,
    line_dedup,
    packing,
    pii,
    quality,
    ranked_search,
    recompression,
    simhash,
    spelling,
    suffix_dedup,
    token_counts,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

URL_RULES = [
    url_filter.HostRule("net", "/", "block"),
    url_filter.HostRule("example.net", "/en/", "allow"),
    url_filter.HostRule("example.com", "/de/", "block"),
    url_filter.HostRule("org", "/fr/", "allow"),
]
# Host labels of known link farms: the seeds that label URLs for training.
SEED_LABELS = ("cheap-pills", "spam-farm")


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def removed_units() -> Column:
    lengths = F.transform("removed", lambda r: r["length"])
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n)


def seeded(pages: DataFrame) -> DataFrame:
    """(url, label): 1 for hosts of the seeds, 0 for all other hosts, none for what has no host."""
    host = url_filter.url_parts(F.col("url"))["host"]
    seed = F.arrays_overlap(F.split(host, "\\."), F.array(*map(F.lit, SEED_LABELS)))
    return pages.select("url", F.when(host != "", seed.cast("int")).alias("label"))


@query("op1_url_filter")
def _(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    trained = url_filter.train(seeded(pages))
    judged = url_filter.judge(pages, URL_RULES, trained)
    return judged.select("_row.page_id", "host", "path", "rule", "verdict", "score")


LINE_SQL = """
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, i, lines[i] AS line,
    translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
), k AS (
  SELECT key, max(doc_id) AS holder FROM l WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT l.*, k.key IS NOT NULL AND l.doc_id <> k.holder AS gone FROM l LEFT JOIN k USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@query("op2_line_dedup", LINE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query("op3_packing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), "byte_bpe_50k.json")


@query("op4_suffix_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(table(spark, folder, "documents")).select(
        "doc_id",
        F.col("n_units").alias("n_bytes"),
        removed_units().alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op5_token_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, folder, "documents"), "word_bpe_49k.json")
    return counts.withColumn("over_limit", F.col("n_tokens") > token_counts.LIMIT)


@query("op6_personal_data")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(f"n_{k}" for k in pii.KINDS),
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


@query("op7_simhash")
def _(spark: SparkSession, folder: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return near.select("doc_id", digits.alias("fingerprint"), "component_id")


def _quality_sql() -> str:
    stop = sorted({*quality.STOP_WORDS, *(w.capitalize() for w in quality.STOP_WORDS)})
    listed = ", ".join(f"'{w}'" for w in stop)
    white = "[ \\t\\n\\x0B\\f\\r]+"

    def rule(r: quality.Rule) -> str:
        bounds = [f"{r.metric} < {r.least}"] * (r.least is not None)
        bounds += [f"{r.metric} > {r.most}"] * (r.most is not None)
        return f"(({' OR '.join(bounds)}) AND n_words >= {r.from_words})"

    ratios = ", ".join(
        f"CASE WHEN n_words = 0 THEN 0.0::double ELSE {c}::double / n_words END AS {name}"
        for c, name in (
            ("word_chars", "mean_word_chars"),
            ("n_symbols", "symbol_ratio"),
            ("n_stop", "stop_word_ratio"),
            ("n_shout", "shout_ratio"),
        )
    )
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{white}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: NOT regexp_full_match(x, '[ \\t\\n\\x0B\\f\\r]*')) AS l
  FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t)
), s AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), r AS (
  SELECT doc_id, sum(least(5, coalesce(following - i, 5)))::bigint AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM s)
  GROUP BY doc_id
), c AS (
  SELECT doc_id, len(w) AS n_words,
    length(array_to_string(w, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
    len(list_filter(w, lambda x: x IN ({listed}))) AS n_stop,
    len(list_filter(w, lambda x: x[-2:] = '!!')) AS n_shout,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN r USING (doc_id)
), m AS (
  SELECT *, {ratios},
    CASE WHEN n_lines = 0 THEN 0.0::double ELSE n_dup_lines::double / n_lines END AS dup_line_ratio,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {' OR '.join(map(rule, quality.METHOD_RULES))}) AS kept
FROM m
"""


@query("op8_quality_rules", _quality_sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


WINDOW_SQL = """
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'),
    lambda x: x <> '') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t)
), f AS (
  SELECT words, min(doc_id) AS first_doc FROM g GROUP BY words
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM g JOIN f USING (words) WHERE first_doc < doc_id
), k AS (
  SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) FILTER (c.i IS NULL) AS kept,
    count(c.i) AS n_removed
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM t) AS u
  LEFT JOIN c ON u.doc_id = c.doc_id AND u.i = c.i
  GROUP BY u.doc_id
)
SELECT t.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)
"""


@query("op9_recompression", WINDOW_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.dedup_windows(table(spark, folder, "documents")).select(
        "doc_id",
        F.col("n_units").alias("n_words"),
        removed_units().alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


DECONTAMINATION_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(lower_text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM documents)
), b AS (
  SELECT item_id, regexp_extract_all(lower_text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM benchmark)
), s AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), p AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS words
  FROM (SELECT w.*, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM w, (SELECT DISTINCT m FROM s) WHERE len(w) >= m)
), f AS (
  SELECT DISTINCT doc_id, item_id, i, p.m FROM p JOIN s ON p.m = s.m AND p.words = s.words
), h AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM f) GROUP BY doc_id
), n AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::varchar AS id FROM f) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op10_decontamination", DECONTAMINATION_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"]
    )
    n_hit = F.size("hit_words").cast("long")
    return found.select(
        F.col("c_doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        # Items without an id count as one, as in SQL.
        (F.size("items") + F.col("no_id").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query("op11_best_fit")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit.pack(table(spark, folder, "documents"), "byte_bpe_50k.json")


SEARCH_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM benchmark
), a AS (
  SELECT count(*) AS n_docs, sum(len(t))::bigint AS n_terms FROM d WHERE len(t) > 0
), m AS (
  SELECT doc_id, 100 - 75 + 75 * len(t) * n_docs // n_terms AS m FROM d, a WHERE len(t) > 0
), p AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d)
  GROUP BY doc_id, term
), q AS (
  SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest(t) AS term FROM b)
  GROUP BY item_id, term
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint AS w
  FROM p, a GROUP BY term, n_docs
), s AS (
  SELECT item_id, doc_id, sum(n * w * (1000000000 * tf // (1000 * tf + 8 * m)))::bigint AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, doc_id, score,
  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::int AS rank
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


@query("op12_ranked_search", SEARCH_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_spelling")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))
