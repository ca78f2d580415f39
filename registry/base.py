"""Registration of queries, and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle.core import compose
from projectmart.functions import fixed_values as V
from projectmart.plans import declarative, gold, model, pipeline, silver
from projectmart.plans.features import READS as FEATURE_READS
from projectmart.plans.features import feature_table
from projectmart.sources import fixtures
from projectmart.sources.schemas import CORE_TABLES
from projectmart.sources.tables import Layers, save, scan, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Built(Mapping):
    """Tables that are planned when they are asked for."""

    def __init__(self, names, build: Callable[[str], DataFrame]):
        self._names, self._build, self._done = tuple(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._done:
            if name not in self._names:
                raise KeyError(name)
            self._done[name] = self._build(name)
        return self._done[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Tables:
    """The layers over one folder of Parquet files, as lazy plans."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.raw = Built(CORE_TABLES, lambda t: fixtures.raw_table(spark, folder, t))
        self.silver = Built(
            CORE_TABLES,
            lambda t: silver.silver_table(
                t, self.raw[t], as_of=fixtures.AS_OF, keys=V.WIDE_KEYS
            ).drop("ingestion_timestamp"),
        )
        self.gold = Built(
            gold.BUILDERS,
            lambda m: gold.BUILDERS[m](self.reading(gold.READS[m]) if m in gold.READS else self.silver),
        )
        self.declared = Built(
            CORE_TABLES,
            lambda t: declarative.silver_table(t, self.raw[t]).drop("ingestion_timestamp"),
        )

    def file(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def reading(self, columns: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
        """Silver tables with the columns that are read, for which less has to move."""
        return {
            t: silver.silver_table(
                t, self.raw[t], as_of=fixtures.AS_OF, keys=V.WIDE_KEYS, columns=names
            )
            for t, names in columns.items()
        }

    @property
    def features(self) -> DataFrame:
        return feature_table(self.reading(FEATURE_READS))

    @property
    def labelled_predictions(self) -> DataFrame:
        """The fixed predictions of the projects with cost lines, with label and level."""
        predictions = fixtures.fixed_predictions(self.spark, self.folder)
        labels = self.features.select("project_id", "is_over_budget")
        joined = predictions.join(labels, "project_id").withColumn(
            "predicted", F.when(F.col("overrun_probability") > 0.5, 1).otherwise(0)
        )
        return model.with_risk_level(joined)

    @property
    def fixed_scores(self) -> DataFrame:
        return model.with_risk_level(fixtures.fixed_predictions(self.spark, self.folder))


class Stored:
    """The tables of the batch path, written once per session and folder.

    Queries that start from the raw tables, as streams do, have only those written; what follows from
    them is written when a query reads it.
    """

    _known: dict[tuple[str, str], Stored] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.root = shared_folder(spark)
        self.layers = Layers(f"pm{len(self._known)}_", self.root)
        self.model_path = f"{self.root}/model"
        self._whole = False
        pipeline.build_bronze(spark, self.layers, fixtures.raw_tables(spark, folder))

    def _complete(self) -> None:
        spark = self.spark
        pipeline.build_silver(spark, self.layers, as_of=fixtures.AS_OF, keys=V.WIDE_KEYS)
        pipeline.build_gold(spark, self.layers)
        pipeline.build_features(spark, self.layers)
        self.features = scan(spark, self.layers, "gold", "ml_feature_table")
        self.training, self.test = model.stratified_split(self.features)
        self.model = model.train(self.training)
        model.save_model(self.model, self.model_path)
        scores = model.score_projects(self.model, self.features)
        save(scores, self.layers, "gold", "ml_project_risk_scores")
        self._whole = True

    @classmethod
    def bronze_of(cls, spark: SparkSession, folder: str) -> Stored:
        """The raw tables, and whatever else has been written before."""
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._known:
            cls._known[key] = cls(spark, folder)
        return cls._known[key]

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Stored:
        stored = cls.bronze_of(spark, folder)
        if not stored._whole:
            stored._complete()
        return stored


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` as a query, with the SQL of its result when there is one."""

    def add(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = compose(sql)
        return build

    return add


def stored_query(name: str, sql: str | None = None):
    """Register ``build(stored)`` as a query on the written tables."""

    def add(build: Callable[[Stored], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Stored.of(spark, folder))
        if sql is not None:
            SQL[name] = compose(sql)
        return build

    return add


def union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def values(tables: Mapping[str, DataFrame], columns: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Every distinct value of some columns with its frequency: (table, column, raw, n)."""
    return union(
        [
            tables[table]
            .groupBy(F.col(c).alias("raw"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(table).alias("table"), F.lit(c).alias("column"), "raw", "n")
            for table, names in columns.items()
            for c in names
        ]
    )


def values_sql(prefix: str, columns: Mapping[str, tuple[str, ...]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", {c} AS raw, count(*) AS n"
        f" FROM {prefix}{table} GROUP BY {c}"
        for table, names in columns.items()
        for c in names
    )


def mapped(
    name: str,
    columns: Mapping[str, tuple[str, ...]],
    result: Callable[[Column], Column],
    sql: str,
) -> None:
    """Register an operator on single values, applied to all distinct values of some columns."""

    @query(name, f"SELECT *, {sql} AS result FROM ({values_sql('b_', columns)})")
    def _(t: Tables) -> DataFrame:
        return values(t.raw, columns).withColumn("result", result(F.col("raw")))
