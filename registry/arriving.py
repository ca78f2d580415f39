"""Queries on data that arrives bit by bit: order of arrival, refresh of what changed, streams with
state and with counts, and distinct counts that are added up later."""

from __future__ import annotations

from pyspark.sql import functions as F

from projectmart.functions.dates import year_month
from projectmart.operators import distinct as D
from projectmart.operators.keys import clean_keys
from projectmart.plans import declarative, incremental
from projectmart.sources.arrival import ARRIVAL, with_arrival
from projectmart.sources.schemas import PRIMARY_KEYS, RAW_SCHEMAS
from projectmart.sources.tables import COMPRESSION, save, scan, shared_folder
from projectmart.streaming.ingest import ingest_checked, ingest_unique, record_counts
from registry.base import Tables, query
from registry.storage import fresh_layers


@query(
    "wn_1_first_arrival",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER"
    " (PARTITION BY o_custkey ORDER BY o_orderkey % 5, o_orderkey) = 1",
)
def _(t: Tables):
    """The first order of every customer, delivered in five folders; nothing in the rows says when."""
    path = f"{shared_folder(t.spark)}/deliveries"
    delivered = t.file("orders").withColumn("delivery", F.col("o_orderkey") % 5)
    order = ("delivery", "o_orderkey")
    in_order = delivered.repartitionByRange(*order).sortWithinPartitions(*order)
    in_order.write.partitionBy("delivery").parquet(path)
    arrived = with_arrival(t.spark.read.parquet(path), F.col("delivery"))
    first = clean_keys(arrived, "o_custkey", [ARRIVAL])
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


def _deliver(t: Tables, layers, table: str, rows, mode: str) -> None:
    save(rows.select(RAW_SCHEMAS[table].fieldNames()), layers, "bronze", table, mode=mode)


@query("io_5_refresh_changed", "SELECT * FROM dg_cost_variance_monthly")
def _(t: Tables):
    """The monthly mart after three deliveries of cost lines, the last two refreshed by what changed."""
    table, mart = "fact_project_costs", "gold_cost_variance_monthly"
    layers = fresh_layers(t.spark)
    projects = declarative.silver_table("dim_projects", t.raw["dim_projects"])
    save(projects, layers, "silver", "dim_projects")
    share = F.pmod(F.xxhash64(*RAW_SCHEMAS[table].fieldNames()), F.lit(20))
    # The raw rows are derived once, and each delivery reads its own files.
    path = f"{shared_folder(t.spark)}/dealt"
    shares = t.raw[table].withColumn("_share", F.least(share, F.lit(2)))
    shares.write.partitionBy("_share").option("compression", COMPRESSION).parquet(path)
    dealt = t.spark.read.parquet(path)
    _deliver(t, layers, table, dealt.filter("_share > 1"), "overwrite")
    incremental.build_partitioned(t.spark, layers, mart)
    for nth in (0, 1):
        new = dealt.filter(F.col("_share") == nth)
        _deliver(t, layers, table, new, "append")
        incremental.refresh_changed(t.spark, layers, mart, new)
    return scan(t.spark, layers, "gold", mart)


@query("st_2_refresh_from_stream", "SELECT * FROM dg_schedule_kpi")
def _(t: Tables):
    """The schedule mart, kept up to date by a stream over two deliveries of milestones."""
    table, mart = "fact_schedule_milestones", "gold_schedule_kpi"
    layers = fresh_layers(t.spark)
    projects = declarative.silver_table("dim_projects", t.raw["dim_projects"])
    save(projects, layers, "silver", "dim_projects")
    share = F.pmod(F.xxhash64(PRIMARY_KEYS[table], "planned_date"), F.lit(10))
    dealt = t.raw[table].withColumn("_share", share)
    checkpoint = f"{shared_folder(t.spark)}/checkpoint"
    for condition, mode in (("_share > 0", "overwrite"), ("_share = 0", "append")):
        _deliver(t, layers, table, dealt.filter(condition), mode)
        source = layers.folder("bronze", table)
        incremental.refresh_from_stream(t.spark, layers, mart, source, checkpoint)
    return scan(t.spark, layers, "gold", mart).drop("project_bucket")


@query("cl_7_stream_dedup", "SELECT * FROM events")
def _(t: Tables):
    """Events of two deliveries that overlap by a third, read by two runs of one stream."""
    root, events = shared_folder(t.spark), t.file("events")
    third = F.col("event_id") % 3
    for rows in (events.filter(third != 0), events.filter(third != 1)):
        rows.write.mode("append").parquet(f"{root}/source")
        found, _ = ingest_unique(
            t.spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", events.schema,
            "event_id", event_time="ts", delay="60 days",
        )
    return found


_CHECKED = {
    "dim_employee": {
        "valid_employee_id": "employee_id IS NOT NULL",
        "valid_full_name": "full_name IS NOT NULL",
        "no_empty_role": "length(trim(role)) > 0",
    },
    "dim_projects": {
        "valid_project_id": "project_id IS NOT NULL",
        "positive_contract_val": "contract_value_eur >= 0",
        "positive_floor_area": "floor_area_m2 >= 0",
    },
}
_checked_sql = " UNION ALL ".join(
    f"SELECT '{table}' AS \"table\", '{rule}' AS rule,"
    f" count(*) FILTER (WHERE NOT coalesce({holds}, FALSE)) AS violations FROM b_{table}"
    for table, rules in _CHECKED.items()
    for rule, holds in rules.items()
)


@query("ex_1_stream_counts", _checked_sql)
def _(t: Tables):
    """Violations that the micro-batches of two deliveries reported, from the run metadata."""
    layers = fresh_layers(t.spark)
    for table in _CHECKED:
        root, rules = shared_folder(t.spark), declarative.required_rules()[table]
        half = F.pmod(F.xxhash64(*t.raw[table].columns), F.lit(2))
        for nth in (0, 1):
            t.raw[table].filter(half == nth).write.mode("append").parquet(f"{root}/source")
            _, report = ingest_checked(
                t.spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint",
                RAW_SCHEMAS[table], rules,
            )
            kept = record_counts(t.spark, layers, table, report)
    parts = F.split("key", "\\.")
    return kept.groupBy(parts[1].alias("table"), parts[2].alias("rule")).agg(
        F.sum(F.col("value").cast("bigint")).alias("violations")
    )


def _numbered_orders(t: Tables):
    orders = t.silver["fact_purchase_orders"]
    for column in ("vendor_id", "project_id"):
        orders = D.with_id(orders, column, D.dense_ids(t.silver["fact_purchase_orders"], column))
    return orders


def _counted():
    return {"vendors": F.col("vendor_id_number"), "projects": F.col("project_id_number")}


@query(
    "ag_5_bitmap_distinct",
    "SELECT po_category, count(DISTINCT vendor_id) AS vendors, count(DISTINCT project_id) AS projects"
    " FROM s_fact_purchase_orders GROUP BY 1",
)
def _(t: Tables):
    mart = D.bitmap_mart(_numbered_orders(t), ["po_category"], _counted())
    return D.bitmap_counts(mart, ["po_category"], ["vendors", "projects"])


@query(
    "ag_11_distinct_months_to_years",
    "SELECT po_category, strftime(po_date_dt, '%Y') AS \"year\", count(DISTINCT vendor_id) AS vendors,"
    " count(DISTINCT project_id) AS projects FROM s_fact_purchase_orders GROUP BY 1, 2",
)
def _(t: Tables):
    """Distinct vendors and projects of a year, from the stored bitmaps of its months."""
    month = year_month(F.col("po_date_dt")).alias("month")
    monthly = D.bitmap_mart(_numbered_orders(t).withColumn("month", month), ["po_category", "month"], _counted())
    path = f"{shared_folder(t.spark)}/orders_by_month"
    monthly.write.parquet(path)
    mart = t.spark.read.parquet(path).withColumn("year", F.substring("month", 1, 4))
    return D.bitmap_counts(mart, ["po_category", "year"], ["vendors", "projects"])
