"""Scalar functions on whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import core as O
from projectmart.functions.dates import year_month
from projectmart.functions.values import aging_bucket, as_of_date, round_half_up
from projectmart.sources.fixtures import AS_OF
from registry.base import Tables, query


def count_rows():
    return F.count("*").alias("n")


@query(
    "sc_1_lower_trim",
    "SELECT lower(role) AS low, trim(role) AS trimmed, count(*) AS n FROM b_dim_employee GROUP BY 1, 2",
)
def _(t: Tables):
    return (
        t.raw["dim_employee"]
        .groupBy(F.lower("role").alias("low"), F.trim("role").alias("trimmed"))
        .agg(count_rows())
    )


@query(
    "sc_2_length",
    "SELECT CAST(length(po_status) AS INTEGER) AS len, count(*) AS n FROM b_fact_purchase_orders"
    " GROUP BY 1",
)
def _(t: Tables):
    return t.raw["fact_purchase_orders"].groupBy(F.length("po_status").alias("len")).agg(count_rows())


@query(
    "sc_3_concat",
    "SELECT period_month || '-01' AS joined, count(*) AS n FROM b_fact_project_costs GROUP BY 1",
)
def _(t: Tables):
    joined = F.concat("period_month", F.lit("-01")).alias("joined")
    return t.raw["fact_project_costs"].groupBy(joined).agg(count_rows())


@query(
    "sc_4_rlike",
    "SELECT regexp_matches(vendor_id, '^VND-\\d{4,}$') AS fits, count(*) AS n FROM b_fact_invoices"
    " GROUP BY 1",
)
def _(t: Tables):
    fits = F.col("vendor_id").rlike(r"^VND-\d{4,}$").alias("fits")
    return t.raw["fact_invoices"].groupBy(fits).agg(count_rows())


@query(
    "sc_5_try_to_date",
    f"SELECT due_date, {O.parse_date('due_date', ['dd/MM/yyyy'])} AS parsed, count(*) AS n"
    f" FROM b_fact_invoices GROUP BY 1, 2",
)
def _(t: Tables):
    parsed = F.try_to_date("due_date", "dd/MM/yyyy").alias("parsed")
    return t.raw["fact_invoices"].groupBy("due_date", parsed).agg(count_rows())


@query(
    "sc_7_date_format",
    "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1",
)
def _(t: Tables):
    month = year_month(F.col("o_orderdate").cast("date")).alias("month")
    return t.file("orders").groupBy(month).agg(count_rows())


@query(
    "sc_8_datediff",
    "SELECT CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)"
    " AS days, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
)
def _(t: Tables):
    joined = t.file("lineitem").join(t.file("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    return joined.groupBy(days.alias("days")).agg(count_rows())


@query(
    "sc_9_as_of",
    f"SELECT CAST(o_orderdate AS DATE) <= {O.AS_OF} AS past, count(*) AS n FROM orders GROUP BY 1",
)
def _(t: Tables):
    past = F.col("o_orderdate").cast("date") <= as_of_date(AS_OF)
    return t.file("orders").groupBy(past.alias("past")).agg(count_rows())


@query(
    "sc_10_arithmetic",
    "SELECT c_custkey, abs(c_acctbal) AS size, c_acctbal / nullif(c_nationkey, 0) AS share,"
    " c_acctbal < 0 AS negative FROM customer",
)
def _(t: Tables):
    balance = F.col("c_acctbal")
    return t.file("customer").select(
        "c_custkey",
        F.abs(balance).alias("size"),
        F.try_divide(balance, F.col("c_nationkey")).alias("share"),
        (balance < 0).alias("negative"),
    )


@query(
    "sc_11_round",
    f"SELECT c_custkey, {O.half_up('c_acctbal / 7', 1)} AS one, {O.half_up('c_acctbal / 7', 2)} AS two,"
    f" {O.half_up('c_acctbal / 7', 4)} AS four FROM customer",
)
def _(t: Tables):
    value = F.col("c_acctbal") / 7
    return t.file("customer").select(
        "c_custkey",
        *[round_half_up(value, n).alias(name) for n, name in ((1, "one"), (2, "two"), (4, "four"))],
    )


@query(
    "sc_12_greatest",
    "SELECT c_custkey, greatest(c_acctbal, 0) AS positive FROM customer",
)
def _(t: Tables):
    return t.file("customer").select(
        "c_custkey", F.greatest(F.col("c_acctbal"), F.lit(0)).alias("positive")
    )


@query(
    "sc_13_coalesce_nullif",
    "SELECT coalesce(nullif(department, ''), 'none') AS department, count(*) AS n"
    " FROM b_dim_employee GROUP BY 1",
)
def _(t: Tables):
    filled = F.coalesce(F.nullif(F.col("department"), F.lit("")), F.lit("none"))
    return t.raw["dim_employee"].groupBy(filled.alias("department")).agg(count_rows())


@query(
    "sc_14_case",
    "SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large'"
    " END AS size, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS code, count(*) AS n"
    " FROM lineitem GROUP BY 1, 2",
)
def _(t: Tables):
    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    size = F.when(quantity < 10, "small").when(quantity < 30, "medium").otherwise("large")
    code = F.when(flag == "A", 1).when(flag == "R", 2)
    return t.file("lineitem").groupBy(size.alias("size"), code.alias("code")).agg(count_rows())


@query(
    "sc_15_in_between_null",
    "SELECT payment_status IN ('paid', 'approved') AS settled, days_overdue BETWEEN 1 AND 30 AS month,"
    " paid_date_dt IS NULL AS unpaid, count(*) AS n FROM s_fact_invoices GROUP BY 1, 2, 3",
)
def _(t: Tables):
    return (
        t.silver["fact_invoices"]
        .groupBy(
            F.col("payment_status").isin("paid", "approved").alias("settled"),
            F.col("days_overdue").between(1, 30).alias("month"),
            F.col("paid_date_dt").isNull().alias("unpaid"),
        )
        .agg(count_rows())
    )


@query(
    "sc_16_cast",
    "SELECT CAST(o_orderdate AS DATE) AS day, CAST(NULL AS DATE) AS nothing, count(*) AS n"
    " FROM orders GROUP BY 1, 2",
)
def _(t: Tables):
    day, nothing = F.col("o_orderdate").cast("date"), F.lit(None).cast("date")
    return t.file("orders").groupBy(day.alias("day")).agg(count_rows()).withColumn("nothing", nothing)


@query(
    "sc_18_aging_bucket",
    f"SELECT days_overdue, {O.bucket('days_overdue')} AS aging_bucket, count(*) AS n"
    f" FROM b_fact_invoices GROUP BY 1, 2",
)
def _(t: Tables):
    bucket = aging_bucket(F.col("days_overdue")).alias("aging_bucket")
    return t.raw["fact_invoices"].groupBy("days_overdue", bucket).agg(count_rows())


PROBABILITY = "CAST(c_custkey * 37 % 1001 AS DOUBLE) / 1000.0::DOUBLE"


def level_sql(p: str) -> str:
    return (
        f"CASE WHEN {p} <= 0 THEN NULL WHEN {p} <= 0.3::DOUBLE THEN 'low'"
        f" WHEN {p} <= 0.7::DOUBLE THEN 'medium' WHEN {p} <= 1.0::DOUBLE THEN 'high' END"
    )


O.CTES["p_fixed"] = (
    f"SELECT {O.project_key('c_custkey')} AS project_id, {PROBABILITY} AS overrun_probability"
    f" FROM customer"
)
O.CTES["p_scores"] = f"SELECT *, {level_sql('overrun_probability')} AS risk_level FROM p_fixed"


@query(
    "sc_19_risk_bucket",
    "SELECT overrun_probability, risk_level, count(*) AS n FROM p_scores GROUP BY 1, 2",
)
def _(t: Tables):
    return t.fixed_scores.groupBy("overrun_probability", "risk_level").agg(count_rows())

