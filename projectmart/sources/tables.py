"""Named tables in three layers."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from projectmart.sources.schemas import REGISTRY, REPORTS, RUN_METADATA

# Stored tables take about a quarter less room than with the default, in about the same time.
COMPRESSION = "zstd"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes: WeakKeyDictionary[SparkSession, tuple[int, str]] = WeakKeyDictionary()
_lock = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach.

    On a cluster it lies below ``spark.checkpoint.dir``. Only a local session, whose executors
    share the machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/projectmart-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="projectmart-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give the session a checkpoint folder unless it has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


@dataclass(frozen=True)
class Layers:
    """Where the tables of one deployment are: schema prefix, folder and file format."""

    prefix: str = ""
    root: str | None = None
    format: str = "parquet"

    def schema(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def folder(self, layer: str, table: str) -> str:
        """The files of a table, for readers that take a path (layers with a root only)."""
        return f"{self.root}/{self.schema(layer)}/{table}"


def ensure_namespaces(spark: SparkSession, layers: Layers) -> None:
    for layer in REGISTRY:
        location = f" LOCATION '{layers.root}/{layers.schema(layer)}'" if layers.root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layers.schema(layer)}{location}")


def scan(spark: SparkSession, layers: Layers, layer: str, table: str) -> DataFrame:
    return spark.table(layers.name(layer, table))


def scan_layer(spark: SparkSession, layers: Layers, layer: str) -> dict[str, DataFrame]:
    return {table: scan(spark, layers, layer, table) for table in REGISTRY[layer]}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends, not when the driver happens to collect its
    garbage: a run of many writes then needs room for the shuffles of those at work, not for all.

    The setting is the session's, so it is given back when the last of several writes has ended.
    """
    with _lock:
        running, before = _writes.get(spark) or (0, spark.conf.get(_CLEANUP, "false"))
        _writes[spark] = running + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            running, before = _writes.pop(spark)
            if running > 1:
                _writes[spark] = running - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def save(
    df: DataFrame,
    layers: Layers,
    layer: str,
    table: str,
    mode: str = "overwrite",
    *,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    comment: str | None = None,
) -> None:
    """Write a table, if asked in partitions by some columns, so that dated scans read theirs only.

    ``bucket_by`` (number, column) puts equal values of the column into the same files: grouping and
    joining such tables by that column needs no shuffle. A comment is declared with the table.
    """
    if bucket_by:
        # One task per bucket, so that a bucket is one file and not one per task.
        df = df.repartition(*bucket_by)
    writer = df.write.format(layers.format).mode(mode)
    if layers.format == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    name = layers.name(layer, table)
    with shuffles_removed(df.sparkSession):
        writer.saveAsTable(name)
    if comment is not None:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{text}'")


def register(
    spark: SparkSession,
    layers: Layers,
    layer: str,
    table: str,
    schema: T.StructType,
    path: str,
    *,
    comment: str | None = None,
) -> None:
    """Name the files of a folder, such as the sink of a stream, as a table."""
    name = layers.name(layer, table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(
        name, path=path, source=layers.format, schema=schema, description=comment
    )


def exists(spark: SparkSession, layers: Layers, layer: str, table: str) -> bool:
    return spark.catalog.tableExists(layers.name(layer, table))


def new_run() -> str:
    return uuid.uuid4().hex


def put_metadata(
    spark: SparkSession, layers: Layers, entries: DataFrame, run_id: str | None = None
) -> DataFrame:
    """Append ``key, value`` rows of a run to the run metadata and return the table.

    Without a run id, the rows are those of a run of their own.
    """
    name = layers.name("gold", RUN_METADATA)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name}"
        f" (run_id STRING, logged_at TIMESTAMP, key STRING, value STRING) USING {layers.format}"
    )
    entries.select(
        F.lit(run_id or new_run()),
        F.current_timestamp(),
        F.col("key").cast("string"),
        F.col("value").cast("string"),
    ).write.mode("append").insertInto(name)
    return spark.table(name)


def drop_layers(spark: SparkSession, layers: Layers, drop_bronze: bool = False) -> DataFrame:
    """Drop gold, silver and, if asked, bronze with their schemas; report what remains.

    Only tables of this library are dropped. A schema that holds others is refused with an error,
    after its own tables are gone.
    """
    targets = [layer for layer in ("gold", "silver", "bronze") if layer != "bronze" or drop_bronze]
    for layer in targets:
        for table in (*reversed(REGISTRY[layer]), *(REPORTS if layer == "gold" else ())):
            spark.sql(f"DROP TABLE IF EXISTS {layers.name(layer, table)}")
        spark.sql(f"DROP SCHEMA IF EXISTS {layers.schema(layer)} RESTRICT")
    remaining = [
        (layer, table, exists(spark, layers, layer, table))
        for layer, tables in REGISTRY.items()
        for table in tables
    ]
    return spark.createDataFrame(remaining, "layer string, table string, present boolean")


def inventory(frames: dict[str, dict[str, DataFrame | None]]) -> DataFrame:
    """Rows and columns of every table as one plan; a missing table has the state NOT FOUND."""
    parts = []
    missing = []
    for layer, tables in frames.items():
        for table, df in tables.items():
            if df is None:
                missing.append((layer, table))
                continue
            parts.append(
                df.agg(F.count("*").alias("rows")).select(
                    F.lit(layer).alias("layer"),
                    F.lit(table).alias("table"),
                    "rows",
                    F.lit(len(df.columns)).alias("columns"),
                    F.lit("OK").alias("state"),
                )
            )
    spark = SparkSession.active()
    if missing:
        names = spark.createDataFrame(missing, "layer string, table string")
        parts.append(
            names.select(
                "layer",
                "table",
                F.lit(None).cast("bigint").alias("rows"),
                F.lit(None).cast("int").alias("columns"),
                F.lit("NOT FOUND").alias("state"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def stored_inventory(spark: SparkSession, layers: Layers) -> DataFrame:
    """Inventory of the registered tables."""
    return inventory(
        {
            layer: {
                table: scan(spark, layers, layer, table)
                if exists(spark, layers, layer, table)
                else None
                for table in tables
            }
            for layer, tables in REGISTRY.items()
        }
    )


def preview(df: DataFrame, n: int = 5) -> tuple[int, int, DataFrame]:
    """Row count, column count and the first rows."""
    return df.count(), len(df.columns), df.limit(n)
