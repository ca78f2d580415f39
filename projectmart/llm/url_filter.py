"""URL filter: a rule list first, then gradient-boosted trees on lexical features.

The trees are fitted on labelled URLs, of which at most ``max_rows`` different ones are taken, half
of either label, by the hash of the URL; copies of a URL count once. Suffix statistics (share of blocked URLs per last host label) come
from the same rows, so their table is bounded too and may be broadcast.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and is
allowed. Without labelled URLs of both kinds there is no model, and what no rule decides is allowed.
Repeated rows get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.llm.line_dedup import ascii_lower

FEATURES = (
    "url_length",
    "host_length",
    "path_depth",
    "host_labels",
    "host_hyphens",
    "digit_ratio",
    "entropy",
    "n_parameters",
    "suffix_blocked",
    "suffix_count",
)


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> dict[str, Column]:
    """Host (lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return {"host": ascii_lower(host), "path": path}


def fits(rule: HostRule) -> Column:
    host, path = F.col("host"), F.col("path")
    inside = (host == rule.host) | host.endswith(f".{rule.host}")
    return inside & path.startswith(rule.path)


def decided(rules: list[HostRule]) -> dict[str, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        rule = F.when(fits(r), F.lit(r.text)).otherwise(rule)
        verdict = F.when(fits(r), F.lit(r.verdict)).otherwise(verdict)
    return {"rule": rule, "rule_verdict": verdict}


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the lexical features and the suffix."""
    url, host = F.coalesce(F.col("url"), F.lit("")), F.col("host")
    length, size = F.length(url), F.length(host)

    def count(text: Column, character: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(character)))

    characters = F.array_distinct(F.filter(F.split(host, ""), lambda x: x != ""))
    shares = F.transform(
        characters, lambda x: (F.length(F.col("host")) - F.length(F.replace(F.col("host"), x))) / F.length(F.col("host"))
    )
    entropy = F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    digits = length - F.length(F.regexp_replace(url, "[0-9]", ""))
    columns = {
        "url_length": length,
        "host_length": size,
        "path_depth": count(F.col("path"), "/"),
        "host_labels": count(host, ".") + 1,
        "host_hyphens": count(host, "-"),
        "digit_ratio": F.coalesce(F.try_divide(digits, length), F.lit(0.0)),
        "entropy": F.coalesce(entropy, F.lit(0.0)),
        "n_parameters": count(url, "="),
    }
    return urls.withColumns({k: c.cast("double") for k, c in columns.items()}).withColumn(
        "suffix", F.substring_index(host, ".", -1)
    )


def bounded_sample(labelled: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` different URLs, half of either label: those of the lowest hashes.

    URLs without a label are left out.
    """
    known = labelled.filter(F.col("label").isin(0, 1))
    counts = {
        r["label"]: r["n"]
        for r in known.groupBy("label").agg(F.approx_count_distinct("url").alias("n")).collect()
    }
    half, scale = max_rows // 2, 1 << 30
    hashed = known.withColumn("_hash", F.pmod(F.xxhash64("url"), F.lit(scale)))
    halves = []
    for label in (0, 1):
        # More than are taken, so that an error of the estimate leaves enough to choose from; what
        # is left is few different URLs, so that a top-k over them is small at any input size.
        rate = min(scale, scale * (2 * half + 64) // max(1, counts.get(label, 0)))
        drawn = hashed.filter((F.col("label") == label) & (F.col("_hash") < rate)).distinct()
        halves.append(drawn.orderBy("_hash", "url").limit(half).drop("_hash"))
    return halves[0].union(halves[1])


def suffix_table(sample: DataFrame, smooth: float = 10.0) -> DataFrame:
    """Smoothed share of blocked URLs and number of URLs of each suffix in the sample."""
    return sample.groupBy("suffix").agg(
        ((F.sum("label") + smooth / 2) / (F.count("*") + smooth)).alias("suffix_blocked"),
        F.count("*").cast("double").alias("suffix_count"),
    )


def with_suffixes(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    # At most one row per row of the bounded sample: small enough to broadcast at any input size.
    return urls.join(F.broadcast(suffixes), "suffix", "left").fillna(
        {"suffix_blocked": 0.5, "suffix_count": 0.0}
    )


def train(
    labelled: DataFrame, max_rows: int = 4_000, rounds: int = 12, depth: int = 4
) -> tuple[GBTClassificationModel, DataFrame] | None:
    """Model and suffix table from ``labelled`` (url, label 0/1), or None without both labels."""
    sample = bounded_sample(labelled.select("url", "label"), max_rows)
    sample = lexical(sample.coalesce(4).withColumns(url_parts(F.col("url")))).persist()
    if sample.select("label").distinct().count() < 2:
        sample.unpersist()
        return None
    suffixes = suffix_table(sample).persist()
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        with_suffixes(sample, suffixes)
    )
    model = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, seed=11
    ).fit(rows.select("features", F.col("label").cast("double").alias("label")))
    return model, suffixes


def judge(pages: DataFrame, rules: list[HostRule], trained) -> DataFrame:
    """(_row, url, host, path, rule, verdict, score) of every row of ``pages``."""
    packed = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("_row"), "url")
    urls = packed.withColumns(url_parts(F.col("url"))).withColumns(decided(rules))
    allow = F.lit("allow")
    if trained is None:
        scored = urls.withColumn("score", F.lit(None).cast("double"))
        by_method = allow
    else:
        model, suffixes = trained
        assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
            with_suffixes(lexical(urls), suffixes)
        )
        scored = model.transform(assembled).withColumn(
            "score", vector_to_array("probability").getItem(1)
        )
        by_method = F.when((F.col("score") > 0.5) & (F.col("host") != ""), "block").otherwise(allow)
    return scored.select(
        "_row", "url", "host", "path", "rule", F.coalesce("rule_verdict", by_method).alias("verdict"), "score"
    )
