"""Refresh of what changed: new raw rows rewrite the partitions they touch, and no others.

The silver fact and its mart are partitioned alike, by a value that follows from the group of the
mart, so a mart partition needs one silver partition only. New rows may repeat old keys, and an older
row may still be the one that stays; hence the keys of the new rows, and no others, are cleansed once more from
all raw rows of these keys. Keys that only new rows have are known by counting keys; of old raw rows and of
silver rows, those of new keys move, and others stay in place. The partitions in which these keys were and are make up what changed.
Raw files and silver partitions are skipped by the range of the new keys.

What goes through the driver: the smallest and largest new key, and the changed partitions (months,
or at most ``BUCKETS`` numbers). A repeated call with the same rows gives the same tables, so a batch
that failed half-way can run again. Marts also hold columns of dimensions; when a dimension changes, the whole
table has to be refreshed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from projectmart.functions.dates import year_month
from projectmart.operators.keys import of_keys, without_keys
from projectmart.plans import declarative
from projectmart.plans.audit import union
from projectmart.sources.schemas import PRIMARY_KEYS, RAW_SCHEMAS
from projectmart.sources.tables import Layers, exists, save, scan, shared_folder

BUCKETS = 64


@dataclass(frozen=True)
class Partitioned:
    """The fact behind a mart, and the partition column that both have."""

    fact: str
    column: str
    by_month_of: str | None = None
    by_key: str | None = None

    def value(self) -> Column:
        """The partition of a silver row."""
        if self.by_month_of:
            return year_month(F.col(self.by_month_of))
        return F.pmod(F.xxhash64(self.by_key), F.lit(BUCKETS)).cast("int")

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the partition column, unless it has it."""
        return df if self.column in df.columns else df.withColumn(self.column, self.value())


MARTS = {
    "gold_cost_variance_monthly": Partitioned(
        "fact_project_costs", "period_year_month", by_month_of="period_month_dt"
    ),
    "gold_schedule_kpi": Partitioned(
        "fact_schedule_milestones", "project_bucket", by_key="project_id"
    ),
}


def _spread(df: DataFrame, column: str) -> DataFrame:
    """Rows of a partition together, but large partitions in several tasks."""
    return df.hint("rebalance", column)


def _within(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    known = [v for v in values if v is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    return df.filter(wanted | F.col(column).isNull() if None in values else wanted)


def _build_mart(spark: SparkSession, layers: Layers, mart: str, fact: DataFrame) -> DataFrame:
    spec = MARTS[mart]
    sources, build = declarative.GOLD[mart]
    tables = {s: fact if s == spec.fact else scan(spark, layers, "silver", s) for s in sources}
    return spec.placed(build(tables))


def build_partitioned(spark: SparkSession, layers: Layers, mart: str) -> None:
    """Write the silver fact of a mart and the mart anew, in partitions."""
    spec = MARTS[mart]
    raw = scan(spark, layers, "bronze", spec.fact)
    if spec.by_key:
        # The partition is known before cleansing, so that raw columns move alone.
        place = lambda rows: _spread(spec.placed(rows), spec.column)
        clean = declarative.silver_table(spec.fact, raw, placed=place)
        clean = clean.select(*[c for c in clean.columns if c != spec.column], spec.column)
    else:
        clean = _spread(spec.placed(declarative.silver_table(spec.fact, raw)), spec.column)
    save(clean, layers, "silver", spec.fact, partition_by=[spec.column])
    built = _build_mart(spark, layers, mart, scan(spark, layers, "silver", spec.fact))
    save(_spread(built, spec.column), layers, "gold", mart, partition_by=[spec.column])


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Only partitions that are written are replaced. Tables take this from the session alone."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _replace(df: DataFrame, layers: Layers, layer: str, table: str, column: str, changed: list) -> None:
    """Overwrite the partitions that ``df`` has rows of, and drop those of ``changed`` that it has
    none of."""
    spark, name = df.sparkSession, layers.name(layer, table)
    seen = Observation()
    observed = df.select(scan(spark, layers, layer, table).columns).observe(
        seen, F.collect_set(column).alias("filled"), F.count_if(F.col(column).isNull()).alias("unknown")
    )
    with _dynamic_overwrite(spark):
        observed.write.mode("overwrite").insertInto(name)
    filled = {*seen.get["filled"], *([None] if seen.get["unknown"] else [])}
    kind = dict(scan(spark, layers, layer, table).dtypes)[column]
    for value in set(changed) - filled:
        text = "null" if value is None else f"'{value}'" if kind == "string" else str(value)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {text})")


def refresh_changed(spark: SparkSession, layers: Layers, mart: str, new: DataFrame) -> list:
    """Bring the silver fact and the mart up to date with ``new`` rows, which the raw table already
    holds; returns the partitions that were rewritten."""
    spec = MARTS[mart]
    key, names = PRIMARY_KEYS[spec.fact], RAW_SCHEMAS[spec.fact].fieldNames()
    work = shared_folder(spark)
    # Read several times below.
    new.select(names).dropna(subset=[key]).write.parquet(f"{work}/new")
    new = spark.read.parquet(f"{work}/new")
    new.groupBy(key).agg(F.count("*").alias("_new")).write.parquet(f"{work}/keys")
    keys = spark.read.parquet(f"{work}/keys")
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    in_range = F.col(key).between(low, high)
    stored = scan(spark, layers, "bronze", spec.fact).filter(in_range)
    # Keys that raw rows before had, too; alone they move, and of the raw rows theirs only.
    counts = stored.groupBy(key).agg(F.count("*").alias("_all")).join(keys, key)
    counts.filter("_all > _new").select(key).write.parquet(f"{work}/again")
    again = spark.read.parquet(f"{work}/again")
    fresh = union(without_keys(new, key, again))
    raw = fresh.unionByName(of_keys(stored.select(names), key, again))
    spec.placed(declarative.silver_table(spec.fact, raw)).write.parquet(f"{work}/clean")
    clean = spark.read.parquet(f"{work}/clean")

    before = scan(spark, layers, "silver", spec.fact)
    old = before.filter(in_range).select(key, spec.column).join(keys.select(key), key, "left_semi")
    old.write.parquet(f"{work}/old")
    old = spark.read.parquet(f"{work}/old")
    touched = old.select(spec.column).union(clean.select(spec.column)).distinct()
    changed = [r[0] for r in touched.collect()]
    if not changed:
        return []
    kept, looked_up = without_keys(_within(before, spec.column, changed), key, old.select(key))
    moved = looked_up.unionByName(clean)
    # The mart first: what changed is seen by where silver still has the keys, also in a second try.
    built = _build_mart(spark, layers, mart, kept.unionByName(moved))
    _replace(_spread(built, spec.column), layers, "gold", mart, spec.column, changed)
    # Rows that stay are read by partition and written as they come.
    after = kept.unionByName(_spread(moved.select(kept.columns), spec.column))
    _replace(after, layers, "silver", spec.fact, spec.column, changed)
    return sorted(changed, key=str)


def refresh_from_stream(
    spark: SparkSession, layers: Layers, mart: str, source: str, checkpoint: str
) -> list[list]:
    """Refresh a mart with the raw files of ``source`` that are new since the last call.

    The checkpoint remembers the files, so each is taken once; a batch that failed is taken again.
    Returns the partitions that each micro-batch rewrote. The first call builds the tables.
    """
    rewritten: list[list] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        if exists(spark, layers, "gold", mart):
            rewritten.append(refresh_changed(spark, layers, mart, batch))
        else:
            build_partitioned(spark, layers, mart)

    stream = spark.readStream.schema(RAW_SCHEMAS[MARTS[mart].fact]).parquet(source)
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return rewritten
