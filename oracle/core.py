"""Raw, silver and gold tables as common table expressions, and helpers to compose a query."""

from __future__ import annotations

import re

from projectmart.functions import fixed_values as V
from projectmart.sources import fixtures as X
from projectmart.sources.schemas import PRIMARY_KEYS, RAW_SCHEMAS

CTES: dict[str, str] = {}


def compose(body: str) -> str:
    """Put the common table expressions that the query uses in front of it."""
    used: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z]+_[a-z0-9_]+\b", text)):
            if word in CTES and word not in used:
                visit(CTES[word])
                used.append(word)

    visit(body)
    if not used:
        return body
    listed = ",\n".join(f"{name} AS (\n{CTES[name].strip()}\n)" for name in used)
    return f"WITH {listed}\n{body.strip()}"


def text(value: object) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def in_list(values) -> str:
    return ", ".join(text(v) for v in values)


# --- defects ------------------------------------------------------------------------------------


def pick(pool, n: str) -> str:
    return f"([{in_list(pool)}])[1 + CAST(({n}) % {len(pool)} AS INTEGER)]"


def nulled(value: str, key: str, modulus: int = 41, residue: int = 7) -> str:
    return f"CASE WHEN ({key}) % {modulus} <> {residue} THEN {value} END"


def swapped(value: str, key: str, pool, modulus: int, residue: int) -> str:
    other = pick(pool, f"({key}) // {modulus}")
    return f"CASE WHEN ({key}) % {modulus} = {residue} THEN {other} ELSE {value} END"


def dirty_enum(value: str, key: str, pool) -> str:
    return swapped(value, key, pool, 11, 3)


def dirty_key(value: str, key: str, pool) -> str:
    return swapped(value, key, pool, 17, 2)


def dirty_score(value: str, key: str) -> str:
    return swapped(value, key, (-1, 0, 11, 15, 100, None), 19, 4)


def dirty_date(value: str, key: str) -> str:
    formats = ("%d/%m/%Y", "%Y%m%d", "%d-%b-%Y", "%m-%d-%Y")
    cases = " ".join(
        f"WHEN {i} THEN strftime({value}, '{fmt}')" for i, fmt in enumerate(formats)
    )
    return (
        f"CASE WHEN ({key}) % 13 = 5 THEN CASE (({key}) // 13) % 4 {cases} END"
        f" ELSE CAST({value} AS VARCHAR) END"
    )


def dirty_month(value: str, key: str) -> str:
    formats = ("%Y-%m", "%d/%m/%Y", "%B %Y")
    cases = " ".join(
        f"WHEN {i} THEN strftime({value}, '{fmt}')" for i, fmt in enumerate(formats)
    )
    return (
        f"CASE WHEN ({key}) % 13 = 6 THEN CASE (({key}) // 13) % 3 {cases} END"
        f" ELSE CAST({value} AS VARCHAR) END"
    )


def negated(value: str, key: str) -> str:
    return f"CASE WHEN ({key}) % 23 = 1 THEN -abs({value}) ELSE {value} END"


def wrong(value: str, key: str, other: str) -> str:
    return f"CASE WHEN ({key}) % 7 = 6 THEN {other} ELSE {value} END"


def illogical(value: str, key: str, other: str, where: str) -> str:
    return f"CASE WHEN ({key}) % 29 = 9 AND {where} THEN {other} ELSE {value} END"


def padded(n: str, width: int) -> str:
    s = f"CAST({n} AS VARCHAR)"
    return f"CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END"


def tagged(prefix: str, n: str, width: int) -> str:
    return f"('{prefix}' || {padded(n, width)})"


def project_key(c: str) -> str:
    return f"('FRA-' || CAST(2025 + ({c}) // 10000 AS VARCHAR) || '-' || {padded(f'({c}) % 10000', 4)})"


def percent_of(amount: str, percent: str) -> str:
    return (
        f"CAST(round(CAST({amount} AS DECIMAL(18,2)) * CAST({percent} AS DECIMAL(5,0))"
        f" * CAST(0.01 AS DECIMAL(4,2)), 2) AS DOUBLE)"
    )


# --- cleansing ----------------------------------------------------------------------------------

_FORMATS = {
    "yyyy-MM-dd": (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
    "dd/MM/yyyy": (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
    "yyyyMMdd": (r"\d{8}", "%Y%m%d"),
    "dd-MMM-yyyy": (r"\d{2}-[A-Za-z]{3}-\d{4}", "%d-%b-%Y"),
    "MM-dd-yyyy": (r"\d{2}-\d{2}-\d{4}", "%m-%d-%Y"),
    "MMMM yyyy": (r"[A-Za-z]+ \d{4}", "%B %Y"),
}


def _parsed(s: str, fmt: str) -> str:
    shape, pattern = _FORMATS[fmt]
    return (
        f"CASE WHEN regexp_full_match({s}, '{shape}')"
        f" THEN CAST(try_strptime({s}, '{pattern}') AS DATE) END"
    )


def parse_date(s: str, formats=V.FIVE_FORMATS) -> str:
    return f"coalesce({', '.join(_parsed(s, f) for f in formats)})"


def parse_month(s: str, formats=V.MONTH_FORMATS) -> str:
    first_day = f"({s} || '-01')"
    parts = [
        _parsed(first_day, "yyyy-MM-dd") if f == "yyyy-MM" else _parsed(s, f) for f in formats
    ]
    return f"coalesce({', '.join(parts)})"


def fold(s: str) -> str:
    return f"lower(trim({s}))"


def map_enum(s: str, valid, variants=None, keep: bool = False) -> str:
    words = {**{v: v for v in valid}, **(variants or {})}
    cases = " ".join(f"WHEN {text(a)} THEN {text(b)}" for a, b in words.items())
    other = f" ELSE {fold(s)}" if keep else ""
    return f"CASE {fold(s)} {cases}{other} END"


def parse_bool(s: str) -> str:
    return (
        f"CASE WHEN {fold(s)} IN ({in_list(V.TRUE_WORDS)}) THEN TRUE"
        f" WHEN {fold(s)} IN ({in_list(V.FALSE_WORDS)}) THEN FALSE END"
    )


def fk(s: str, kind: str, keys=V.WIDE_KEYS) -> str:
    return f"CASE WHEN regexp_matches({s}, '{keys[kind]}') THEN {s} END"


def flag(s: str) -> str:
    return f"coalesce(regexp_matches({s}, '{V.BUSINESS_ID}'), FALSE)"


def half_up(x: str, scale: int) -> str:
    """Rounded once, at the decimal text of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {scale}) AS DOUBLE)"


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,4))"


def msum(x: str) -> str:
    return f"CAST(sum({dec(x)}) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({msum(x)} / nullif(CAST(count({x}) AS DOUBLE), 0))"


def avg(x: str) -> str:
    """Average of whole numbers."""
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(CAST(count({x}) AS DOUBLE), 0))"


def pct(n: str, d: str, scale: int = 2) -> str:
    return half_up(f"(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0) * 100.0::DOUBLE)", scale)


def hundredths(n: str, d: str, scale: int = 2) -> str:
    return half_up(f"(CAST({n} AS DOUBLE) * 100.0::DOUBLE / nullif(CAST({d} AS DOUBLE), 0))", scale)


def ratio(n: str, d: str, scale: int = 4) -> str:
    return half_up(f"(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0))", scale)


def count_if(p: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {p}) AS BIGINT)"


def variance(b: str, a: str) -> str:
    return f"CAST(round({dec(f'abs({b})')} - {dec(f'abs({a})')}, 2) AS DOUBLE)"


def score(q: str, s: str, sf: str, c: str) -> str:
    terms = (
        f"CAST({x} AS DECIMAL(10,0)) * CAST({w} AS DECIMAL(3,2))"
        for x, w in zip((q, s, sf, c), ("0.4", "0.3", "0.2", "0.1"))
    )
    return f"CAST(round({' + '.join(terms)}, 2) AS DOUBLE)"


def in_range(c: str) -> str:
    return f"CASE WHEN {c} BETWEEN 1 AND 10 THEN {c} END"


def bucket(days: str) -> str:
    return (
        f"CASE WHEN {days} <= 0 THEN 'current' WHEN {days} <= 30 THEN '1-30 days'"
        f" WHEN {days} <= 60 THEN '31-60 days' WHEN {days} <= 90 THEN '61-90 days'"
        f" ELSE '90+ days' END"
    )


AS_OF = f"DATE '{X.AS_OF}'"

# --- raw tables ---------------------------------------------------------------------------------

_k = "s_suppkey"
CTES["b_dim_employee"] = f"""
SELECT employee_id, full_name, role, department FROM (
  SELECT {_k} AS k, {nulled(tagged('EMP-', _k, 4), _k)} AS employee_id,
    {nulled('s_name', f'{_k} + 20')} AS full_name,
    {dirty_enum(pick(V.ROLES, _k), _k, X.ROLE_DIRTY)} AS role,
    {dirty_enum(pick(V.DEPARTMENTS, _k), f'{_k} + 4', X.DEPARTMENT_DIRTY)} AS department
  FROM supplier)
UNION ALL
SELECT {nulled(tagged('EMP-', _k, 4), _k)},
  'Second ' || {nulled('s_name', f'{_k} + 20')},
  {pick(V.ROLES, f'{_k} + 1')},
  {dirty_enum(pick(V.DEPARTMENTS, _k), f'{_k} + 4', X.DEPARTMENT_DIRTY)}
FROM supplier WHERE {_k} % 59 = 0
"""

CTES["b_projects_base"] = """
SELECT c_custkey AS k, c_name, c_nationkey, c_acctbal,
  (['active', 'completed', 'tendering', 'on_hold'])[1 + CAST((c_custkey // 7) % 4 AS INTEGER)] AS s,
  DATE '1995-01-01' + CAST(c_custkey * 37 % 1500 AS INTEGER) AS starts,
  DATE '1995-01-01' + CAST(c_custkey * 37 % 1500 AS INTEGER)
    + CAST(c_custkey * 53 % 810 + 90 AS INTEGER) AS ends
FROM customer
"""
_done = "CASE WHEN s = 'completed' THEN ends + CAST(k % 151 - 30 AS INTEGER) END"
_done = illogical(_done, "k", "starts - 10", "s = 'completed'")
_done = illogical(_done, "k + 1", "ends - 5", "s = 'active'")
_value = "CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 1000 AS DOUBLE)"
_manager = tagged("EMP-", "(k % (SELECT count(*) FROM supplier))", 4)
CTES["b_projects_keyed"] = f"""
SELECT k, {nulled(project_key('k'), 'k')} AS project_id,
  {nulled('c_name', 'k + 20')} AS project_name,
  {dirty_enum(pick(V.PROJECT_TYPES, 'k'), 'k', X.TYPE_DIRTY)} AS project_type,
  {dirty_enum(pick(X.MUNICIPALITIES, 'c_nationkey'), 'k + 2', X.MUNICIPALITY_DIRTY)} AS municipality,
  {nulled("('Worksite ' || CAST(k AS VARCHAR))", 'k + 10')} AS site_address,
  {dirty_enum('s', 'k + 5', X.STATUS_DIRTY)} AS status,
  {dirty_date('starts', 'k')} AS start_date,
  {dirty_date('ends', 'k + 1')} AS planned_end_date,
  {dirty_date(f'({_done})', 'k + 2')} AS actual_end_date,
  {nulled(f'({negated(_value, "k")})', 'k + 30')} AS contract_value_eur,
  {negated('CAST(k * 97 % 49800 + 200 AS DOUBLE)', 'k + 7')} AS floor_area_m2,
  {dirty_key(_manager, 'k', X.BAD_EMPLOYEE)} AS project_manager_id,
  {dirty_key(tagged('CLI-', '(k % 200 + 1)', 3), 'k + 6', X.BAD_CLIENT)} AS client_id
FROM b_projects_base
"""
CTES["b_dim_projects"] = f"""
SELECT * EXCLUDE (k) FROM b_projects_keyed
UNION ALL
SELECT * EXCLUDE (k) REPLACE ('second entry' AS site_address,
  {pick(V.PROJECT_TYPES, 'k + 1')} AS project_type, CAST(NULL AS VARCHAR) AS actual_end_date)
FROM b_projects_keyed WHERE k % 59 = 0
"""

_business = f"(CAST({_k} * 7919 % 9000000 + 1000000 AS VARCHAR) || '-' || CAST({_k} % 10 AS VARCHAR))"
_certified = f"CASE WHEN {_k} % 2 = 1 THEN 'True' ELSE 'False' END"
CTES["b_vendors_keyed"] = f"""
SELECT {_k} AS k, {nulled(tagged('VND-', _k, 4), _k)} AS vendor_id,
  {nulled('s_name', f'{_k} + 20')} AS vendor_name,
  {dirty_enum(pick(V.VENDOR_TYPES, _k), _k, X.VENDOR_TYPE_DIRTY)} AS vendor_type,
  {dirty_enum(pick(X.TRADE_CLEAN, _k), f'{_k} + 3', X.TRADE_DIRTY)} AS trade_category,
  {swapped(_business, _k, ('12345', 'ABCDEFG-H', '0000000-0', '', None), 31, 11)} AS business_id,
  {dirty_enum(pick(V.RATINGS, _k), f'{_k} + 6', X.RATING_DIRTY)} AS dun_bradstreet_rating,
  {swapped(_certified, _k, X.CERTIFIED_DIRTY, 13, 8)} AS rala_certified,
  {dirty_enum(pick(V.APPROVALS, _k), f'{_k} + 8', X.APPROVAL_DIRTY)} AS approved_status
FROM supplier
"""
CTES["b_dim_vendors"] = f"""
SELECT * EXCLUDE (k) FROM b_vendors_keyed
UNION ALL
SELECT * EXCLUDE (k) REPLACE ('Second ' || vendor_name AS vendor_name,
  {pick(V.VENDOR_TYPES, 'k + 1')} AS vendor_type)
FROM b_vendors_keyed WHERE k % 59 = 0
"""

CTES["b_orders_keyed"] = f"""
SELECT o_orderkey AS k, {nulled(tagged('PO-', 'o_orderkey', 6), 'o_orderkey')} AS po_id,
  {dirty_key(project_key('o_custkey'), 'o_orderkey', X.BAD_PROJECT)} AS project_id,
  {dirty_key(tagged('VND-', '(o_orderkey % (SELECT count(*) FROM supplier))', 4),
             'o_orderkey + 8', X.BAD_VENDOR)} AS vendor_id,
  {dirty_date('CAST(o_orderdate AS DATE)', 'o_orderkey')} AS po_date,
  {dirty_enum(pick(V.PO_CATEGORIES, "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"),
              'o_orderkey', X.PO_CATEGORY_DIRTY)} AS po_category,
  {negated('o_totalprice', 'o_orderkey')} AS po_value_eur,
  {negated(percent_of('o_totalprice', 'o_orderkey % 131'), 'o_orderkey + 9')} AS invoiced_eur,
  {dirty_enum(pick(V.PO_STATUSES, 'o_orderkey // 3'), 'o_orderkey + 4', X.PO_STATUS_DIRTY)}
    AS po_status
FROM orders
"""
CTES["b_fact_purchase_orders"] = f"""
SELECT * EXCLUDE (k) FROM b_orders_keyed
UNION ALL
SELECT * EXCLUDE (k) REPLACE ({pick(V.PO_CATEGORIES, 'k')} AS po_category,
  {percent_of('abs(po_value_eur)', '80')} AS po_value_eur,
  {pick(V.PO_STATUSES, 'k')} AS po_status)
FROM b_orders_keyed WHERE k % 59 = 0
"""

CTES["b_lines"] = f"""
SELECT l_orderkey * 8 + l_linenumber AS k, l_orderkey, l_partkey, l_suppkey, l_linenumber,
  l_extendedprice, CAST(l_shipdate AS DATE) AS ship, o_custkey, CAST(o_orderdate AS DATE) AS ordered
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

CTES["b_invoice_lines"] = f"""
SELECT l_orderkey * 8 + l_linenumber AS k, l_orderkey, l_partkey, l_suppkey, l_extendedprice,
  CAST(l_shipdate AS DATE) AS ship,
  CAST(l_shipdate AS DATE) + {pick(X.DUE_DAYS, 'l_linenumber')} AS due,
  {pick(V.PAYMENT_STATUSES, 'l_partkey')} AS s
FROM lineitem
"""
_paid = "CASE WHEN s = 'paid' THEN due + CAST(l_partkey % 46 - 15 AS INTEGER) END"
_paid = illogical(_paid, "k", "ship - 5", "s = 'paid'")
_paid = illogical(_paid, "k + 1", "due + 3", "s <> 'paid'")
CTES["b_fact_invoices"] = f"""
SELECT {nulled(tagged('INV-', 'k', 7), 'k')} AS invoice_id,
  {dirty_key(tagged('PO-', 'l_orderkey', 6), 'k', X.BAD_PO)} AS po_id,
  {dirty_key(tagged('VND-', 'l_suppkey', 4), 'k + 8', X.BAD_VENDOR)} AS vendor_id,
  {dirty_date('ship', 'k')} AS invoice_date,
  {dirty_date('due', 'k + 4')} AS due_date,
  {dirty_date(f'({_paid})', 'k + 9')} AS paid_date,
  {negated('l_extendedprice', 'k')} AS amount_eur,
  {dirty_enum('s', 'k', X.PAYMENT_DIRTY)} AS payment_status,
  CAST({wrong('l_partkey % 120', 'k', '999')} AS INTEGER) AS days_overdue
FROM b_invoice_lines
"""

_spent = percent_of("l_extendedprice", "o_custkey % 101 + (l_linenumber - 4) * 2 + 50")
CTES["b_cost_lines"] = f"""
SELECT *, {percent_of('l_extendedprice', 'l_partkey % 91 + 30')} AS committed, {_spent} AS actual
FROM b_lines
"""
_left = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(actual AS DECIMAL(18,2)) AS DOUBLE)"
CTES["b_fact_project_costs"] = f"""
SELECT {nulled(tagged('CST-', 'k', 7), 'k')} AS cost_id,
  {dirty_key(project_key('o_custkey'), 'k', X.BAD_PROJECT)} AS project_id,
  {dirty_enum(pick(V.COST_CATEGORIES, 'l_linenumber'), 'k', X.CATEGORY_DIRTY)} AS cost_category,
  {negated('l_extendedprice', 'k')} AS budget_eur,
  {negated('committed', 'k + 6')} AS committed_eur,
  {negated('actual', 'k + 12')} AS actual_eur,
  {wrong(_left, 'k', 'actual')} AS variance_eur,
  {dirty_month("CAST(date_trunc('month', ship) AS DATE)", 'k')} AS period_month
FROM b_cost_lines
"""

CTES["b_milestone_lines"] = f"""
SELECT *, {pick(V.MILESTONE_STATUSES, 'l_partkey')} AS s FROM b_lines
"""
_actual = "CASE WHEN s = 'complete' THEN ordered + CAST(l_partkey % 56 - 10 AS INTEGER) END"
_actual = illogical(_actual, "k", "ordered + 3", "s <> 'complete'")
_late = "CASE WHEN s = 'complete' THEN l_partkey % 56 - 10 END"
CTES["b_fact_schedule_milestones"] = f"""
SELECT {nulled(tagged('MS-', 'k', 7), 'k')} AS milestone_id,
  {dirty_key(project_key('o_custkey'), 'k', X.BAD_PROJECT)} AS project_id,
  {tagged('Step ', 'l_partkey % 16 + 1', 2)} AS milestone_name,
  {nulled(tagged('Z', 'l_partkey % 11 + 1', 2), 'k', 17, 5)} AS takt_zone,
  {dirty_date('ordered', 'k')} AS planned_date,
  {dirty_date('(ordered + CAST(l_partkey % 76 - 15 AS INTEGER))', 'k + 4')} AS forecast_date,
  {dirty_date(f'({_actual})', 'k + 8')} AS actual_date,
  CAST({wrong(f'({_late})', 'k', 'l_partkey % 400')} AS INTEGER) AS delay_days,
  {dirty_enum('s', 'k', X.MILESTONE_DIRTY)} AS milestone_status
FROM b_milestone_lines
"""

CTES["b_evaluation_lines"] = """
SELECT *, CAST(l_partkey % 10 + 1 AS INTEGER) AS quality,
  CAST(l_partkey * 3 % 10 + 1 AS INTEGER) AS schedule,
  CAST(l_partkey * 7 % 10 + 1 AS INTEGER) AS safety,
  CAST(l_partkey * 9 % 10 + 1 AS INTEGER) AS communication
FROM b_lines
"""
_overall = (
    "CAST(CAST(quality * 4 + schedule * 3 + safety * 2 + communication AS DECIMAL(6,0))"
    " * CAST(0.1 AS DECIMAL(2,1)) AS DOUBLE)"
)
_rehire = "CASE WHEN l_partkey % 2 = 0 THEN 'True' ELSE 'False' END"
CTES["b_fact_subcontractor_performance"] = f"""
SELECT {nulled(tagged('PRF-', 'k', 7), 'k')} AS perf_id,
  {dirty_key(tagged('VND-', 'l_suppkey', 4), 'k', X.BAD_VENDOR)} AS vendor_id,
  {dirty_key(project_key('o_custkey'), 'k + 8', X.BAD_PROJECT)} AS project_id,
  {dirty_date('ship', 'k')} AS evaluation_date,
  {dirty_score('quality', 'k')} AS quality_score,
  {dirty_score('schedule', 'k + 4')} AS schedule_score,
  {dirty_score('safety', 'k + 9')} AS safety_score,
  {dirty_score('communication', 'k + 13')} AS communication_score,
  {wrong(_overall, 'k', 'CAST(quality AS DOUBLE)')} AS overall_score,
  {swapped(_rehire, 'k', X.REHIRE_DIRTY, 13, 8)} AS would_rehire
FROM b_evaluation_lines
"""

# --- first row per key --------------------------------------------------------------------------

for _table, _schema in RAW_SCHEMAS.items():
    _pk = PRIMARY_KEYS[_table]
    _order = ", ".join(f"{c} ASC NULLS FIRST" for c in _schema.fieldNames())
    _first = f"QUALIFY row_number() OVER (PARTITION BY {_pk} ORDER BY {_order}) = 1"
    CTES[f"u_{_table}"] = f"SELECT * FROM b_{_table} WHERE {_pk} IS NOT NULL {_first}"
    CTES[f"q_{_table}"] = f"SELECT * FROM b_{_table} {_first}"

# --- silver, batch path -------------------------------------------------------------------------

CTES["s_dim_employee"] = f"""
SELECT employee_id, full_name, {map_enum('role', V.ROLES, V.ROLE_VARIANTS)} AS role,
  {map_enum('department', (*V.DEPARTMENTS, 'unassigned'), V.DEPARTMENT_VARIANTS)} AS department
FROM u_dim_employee
"""
CTES["s_projects_parsed"] = f"""
SELECT project_id, project_name,
  {map_enum('project_type', V.PROJECT_TYPES, V.PROJECT_TYPE_VARIANTS)} AS project_type,
  {map_enum('municipality', (), V.MUNICIPALITY_VARIANTS, keep=True)} AS municipality,
  site_address, {map_enum('status', V.PROJECT_STATUSES, V.PROJECT_STATUS_VARIANTS)} AS status,
  abs(contract_value_eur) AS contract_value_eur, abs(floor_area_m2) AS floor_area_m2,
  {fk('project_manager_id', 'employee_id')} AS project_manager_id,
  {fk('client_id', 'client_id')} AS client_id,
  {parse_date('start_date')} AS start_date_dt,
  {parse_date('planned_end_date')} AS planned_end_date_dt,
  {parse_date('actual_end_date')} AS ended
FROM u_dim_projects
"""
CTES["s_dim_projects"] = """
SELECT * EXCLUDE (ended), CASE WHEN status IN ('active', 'tendering', 'on_hold') THEN NULL
  WHEN ended < start_date_dt THEN NULL ELSE ended END AS actual_end_date_dt
FROM s_projects_parsed
"""
CTES["s_dim_vendors"] = f"""
SELECT vendor_id, vendor_name,
  {map_enum('vendor_type', V.VENDOR_TYPES, V.VENDOR_TYPE_VARIANTS)} AS vendor_type,
  {map_enum('trade_category', V.TRADES, V.TRADE_VARIANTS)} AS trade_category, business_id,
  {map_enum('dun_bradstreet_rating', V.RATINGS)} AS dun_bradstreet_rating,
  {parse_bool('rala_certified')} AS rala_certified,
  {map_enum('approved_status', V.APPROVALS, V.APPROVAL_VARIANTS)} AS approved_status,
  {flag('business_id')} AS business_id_valid
FROM u_dim_vendors
"""
CTES["s_milestones_parsed"] = f"""
SELECT milestone_id, {fk('project_id', 'project_id')} AS project_id, milestone_name, takt_zone,
  {map_enum('milestone_status', V.MILESTONE_STATUSES, V.MILESTONE_STATUS_VARIANTS)}
    AS milestone_status,
  {parse_date('planned_date')} AS planned_date_dt, {parse_date('forecast_date')} AS forecast_date_dt,
  {parse_date('actual_date')} AS done
FROM u_fact_schedule_milestones
"""
CTES["s_fact_schedule_milestones"] = """
SELECT * EXCLUDE (done), CASE WHEN milestone_status = 'complete' THEN done END AS actual_date_dt,
  CAST(CASE WHEN milestone_status = 'complete'
    THEN date_diff('day', planned_date_dt, done) END AS INTEGER) AS delay_days
FROM s_milestones_parsed
"""
CTES["s_fact_project_costs"] = f"""
SELECT cost_id, {fk('project_id', 'project_id')} AS project_id,
  {map_enum('cost_category', V.COST_CATEGORIES, V.COST_CATEGORY_VARIANTS)} AS cost_category,
  abs(budget_eur) AS budget_eur, abs(committed_eur) AS committed_eur, abs(actual_eur) AS actual_eur,
  {parse_month('period_month')} AS period_month_dt,
  {variance('budget_eur', 'actual_eur')} AS variance_eur
FROM u_fact_project_costs
"""
CTES["s_fact_purchase_orders"] = f"""
SELECT po_id, {fk('project_id', 'project_id')} AS project_id,
  {fk('vendor_id', 'vendor_id')} AS vendor_id,
  {map_enum('po_category', V.PO_CATEGORIES, V.PO_CATEGORY_VARIANTS)} AS po_category,
  abs(po_value_eur) AS po_value_eur, abs(invoiced_eur) AS invoiced_eur,
  {map_enum('po_status', V.PO_STATUSES, V.PO_STATUS_VARIANTS)} AS po_status,
  {parse_date('po_date')} AS po_date_dt,
  coalesce(abs(invoiced_eur) > abs(po_value_eur), FALSE) AS is_over_invoiced
FROM u_fact_purchase_orders
"""
CTES["s_invoices_parsed"] = f"""
SELECT invoice_id, {fk('po_id', 'po_id')} AS po_id, {fk('vendor_id', 'vendor_id')} AS vendor_id,
  abs(amount_eur) AS amount_eur,
  {map_enum('payment_status', V.PAYMENT_STATUSES, V.PAYMENT_STATUS_VARIANTS)} AS payment_status,
  {parse_date('invoice_date')} AS invoice_date_dt, {parse_date('due_date')} AS due_date_dt,
  {parse_date('paid_date')} AS paid
FROM u_fact_invoices
"""
CTES["s_fact_invoices"] = f"""
SELECT * EXCLUDE (paid),
  CASE WHEN payment_status = 'paid' AND NOT coalesce(paid < invoice_date_dt, FALSE) THEN paid END
    AS paid_date_dt,
  CAST(CASE WHEN payment_status <> 'paid' AND due_date_dt IS NOT NULL
    THEN greatest(date_diff('day', due_date_dt, {AS_OF}), 0) ELSE 0 END AS INTEGER) AS days_overdue
FROM s_invoices_parsed
"""
CTES["s_performance_parsed"] = f"""
SELECT perf_id, {fk('vendor_id', 'vendor_id')} AS vendor_id,
  {fk('project_id', 'project_id')} AS project_id,
  {', '.join(f'{in_range(c)} AS {c}' for c in V.SCORE_WEIGHTS)},
  {parse_bool('would_rehire')} AS would_rehire, {parse_date('evaluation_date')} AS evaluation_date_dt
FROM u_fact_subcontractor_performance
"""
CTES["s_fact_subcontractor_performance"] = f"""
SELECT *, {score('quality_score', 'schedule_score', 'safety_score', 'communication_score')}
  AS overall_score
FROM s_performance_parsed
"""

# --- gold, batch path ---------------------------------------------------------------------------

CTES["g_cost_variance_monthly"] = f"""
SELECT c.*, p.project_name, p.project_type, p.municipality FROM (
  SELECT project_id, cost_category, strftime(period_month_dt, '%Y-%m') AS period_year_month,
    {msum('budget_eur')} AS total_budget_eur, {msum('committed_eur')} AS total_committed_eur,
    {msum('actual_eur')} AS total_actual_eur, {msum('variance_eur')} AS total_variance_eur,
    count(*) AS line_count,
    {pct(msum('actual_eur'), msum('budget_eur'))} AS budget_utilization_pct,
    coalesce({msum('variance_eur')} < 0, FALSE) AS is_over_budget
  FROM s_fact_project_costs GROUP BY 1, 2, 3) c
LEFT JOIN s_dim_projects p ON c.project_id = p.project_id
"""
CTES["g_schedule_kpi"] = f"""
SELECT m.*, p.project_name, p.project_type, p.municipality, p.status FROM (
  SELECT project_id, takt_zone, count(*) AS total_milestones,
    {count_if("milestone_status = 'complete'")} AS completed_milestones,
    {count_if("milestone_status = 'delayed'")} AS delayed_milestones,
    {count_if("milestone_status = 'on_track'")} AS on_track_milestones,
    {half_up(avg('delay_days'), 1)} AS avg_delay_days, max(delay_days) AS max_delay_days,
    {pct(count_if("milestone_status = 'complete'"), 'count(*)')} AS completion_rate_pct,
    {pct(count_if("milestone_status = 'delayed'"), 'count(*)')} AS delay_rate_pct
  FROM s_fact_schedule_milestones GROUP BY 1, 2) m
LEFT JOIN s_dim_projects p ON m.project_id = p.project_id
"""
_scores = ("quality", "schedule", "safety", "communication", "overall")
CTES["g_vendor_evaluations"] = f"""
SELECT vendor_id,
  {', '.join(f'{half_up(mean(f"{s}_score"), 2)} AS avg_{s}_score' for s in _scores)},
  count(*) AS evaluation_count, {count_if('would_rehire')} AS rehire_yes_count,
  {pct(count_if('would_rehire'), 'count(*)')} AS rehire_rate_pct
FROM s_fact_subcontractor_performance GROUP BY 1
"""
CTES["g_vendor_invoices"] = f"""
SELECT vendor_id, count(*) AS total_invoices, {msum('amount_eur')} AS total_invoice_amount,
  {avg('days_overdue')} AS avg_days_overdue,
  {count_if("payment_status = 'disputed'")} AS disputed_invoices
FROM s_fact_invoices GROUP BY 1
"""
CTES["g_vendor_orders"] = f"""
SELECT vendor_id, count(*) AS total_pos, {count_if('is_over_invoiced')} AS over_invoiced_pos
FROM s_fact_purchase_orders GROUP BY 1
"""
CTES["g_vendor_scorecard"] = """
SELECT v.*, e.* EXCLUDE (vendor_id), i.* EXCLUDE (vendor_id), o.* EXCLUDE (vendor_id)
FROM s_dim_vendors v
LEFT JOIN g_vendor_evaluations e ON v.vendor_id = e.vendor_id
LEFT JOIN g_vendor_invoices i ON v.vendor_id = i.vendor_id
LEFT JOIN g_vendor_orders o ON v.vendor_id = o.vendor_id
"""
CTES["g_invoice_aging"] = f"""
SELECT a.*, v.vendor_name, v.vendor_type FROM (
  SELECT vendor_id, payment_status, {bucket('days_overdue')} AS aging_bucket,
    count(*) AS invoice_count, {msum('amount_eur')} AS total_amount_eur,
    {half_up(avg('days_overdue'), 1)} AS avg_days_overdue, max(days_overdue) AS max_days_overdue
  FROM s_fact_invoices GROUP BY 1, 2, 3) a
LEFT JOIN s_dim_vendors v ON a.vendor_id = v.vendor_id
"""
CTES["g_project_costs"] = f"""
SELECT project_id, {msum('budget_eur')} AS total_budget_eur, {msum('actual_eur')} AS total_actual_eur,
  {msum('variance_eur')} AS total_variance_eur
FROM s_fact_project_costs GROUP BY 1
"""
CTES["g_project_schedule"] = f"""
SELECT project_id, count(*) AS total_milestones,
  {count_if("milestone_status = 'complete'")} AS completed_milestones,
  {count_if("milestone_status = 'delayed'")} AS delayed_milestones,
  {half_up(avg('delay_days'), 1)} AS avg_delay_days
FROM s_fact_schedule_milestones GROUP BY 1
"""
CTES["g_project_orders"] = f"""
SELECT project_id, {msum('po_value_eur')} AS total_po_value_eur,
  {msum('invoiced_eur')} AS total_invoiced_eur, {count_if('is_over_invoiced')} AS over_invoiced_pos
FROM s_fact_purchase_orders GROUP BY 1
"""
CTES["g_project_measures"] = f"""
SELECT p.*, c.* EXCLUDE (project_id), m.* EXCLUDE (project_id), o.* EXCLUDE (project_id),
  {pct('total_actual_eur', 'total_budget_eur')} AS budget_utilization_pct,
  {pct('completed_milestones', 'total_milestones')} AS milestone_completion_pct
FROM s_dim_projects p
LEFT JOIN g_project_costs c ON p.project_id = c.project_id
LEFT JOIN g_project_schedule m ON p.project_id = m.project_id
LEFT JOIN g_project_orders o ON p.project_id = o.project_id
"""
CTES["g_project_scored"] = """
SELECT *, CAST(round(
  coalesce(greatest(CAST(budget_utilization_pct AS DECIMAL(18,2)) - 100, 0)
    * CAST(0.5 AS DECIMAL(2,1)), 0)
  + coalesce(delayed_milestones * 5, 0) + coalesce(over_invoiced_pos * 3, 0)
  + coalesce(greatest(CAST(avg_delay_days AS DECIMAL(18,2)), 0) * CAST(0.5 AS DECIMAL(2,1)), 0),
  2) AS DOUBLE) AS risk_score
FROM g_project_measures
"""
CTES["g_project_summary"] = """
SELECT *, CASE WHEN risk_score > 50 THEN 'high' WHEN risk_score > 20 THEN 'medium' ELSE 'low' END
  AS risk_level
FROM g_project_scored
"""
CTES["g_employee_purchase_summary"] = f"""
SELECT e.employee_id, e.full_name, e.role, e.department,
  count(DISTINCT po_id) AS total_po_count,
  CAST(round(sum({dec('po_value_eur')}), 2) AS DOUBLE) AS total_po_value_eur,
  CAST(round(sum({dec('invoiced_eur')}), 2) AS DOUBLE) AS total_invoiced_eur,
  {count_if('is_over_invoiced')} AS over_invoiced_count,
  {pct(count_if('is_over_invoiced'), 'count(DISTINCT po_id)')} AS over_invoiced_pct,
  count(DISTINCT p.project_id) AS project_count,
  {half_up(mean('po_value_eur'), 2)} AS avg_po_value_eur
FROM s_dim_employee e
JOIN s_dim_projects p ON p.project_manager_id = e.employee_id
JOIN s_fact_purchase_orders o ON o.project_id = p.project_id
GROUP BY 1, 2, 3, 4
"""

# --- silver, declarative path -------------------------------------------------------------------


def _three(s: str) -> str:
    return parse_date(s, V.THREE_FORMATS)


CTES["c_dim_employee"] = f"""
SELECT *, {fold('role')} AS role_clean, {fold('department')} AS department_clean FROM q_dim_employee
"""
CTES["c_dim_projects"] = f"""
SELECT *, {_three('start_date')} AS start_dt, {_three('planned_end_date')} AS planned_end_dt,
  {_three('actual_end_date')} AS actual_end_dt, abs(contract_value_eur) AS contract_value_eur_clean,
  abs(floor_area_m2) AS floor_area_m2_clean, {fold('project_type')} AS project_type_clean,
  {fold('status')} AS status_clean
FROM q_dim_projects
"""
CTES["c_dim_vendors"] = f"""
SELECT *, {parse_bool('rala_certified')} AS rala_certified_bool,
  {flag('business_id')} AS business_id_valid, {fold('vendor_type')} AS vendor_type_clean,
  {fold('trade_category')} AS trade_category_clean, {fold('approved_status')} AS approved_status_clean
FROM q_dim_vendors
"""
CTES["c_fact_schedule_milestones"] = f"""
SELECT *, {_three('planned_date')} AS planned_dt, {_three('forecast_date')} AS forecast_dt,
  {_three('actual_date')} AS actual_dt, {fold('milestone_status')} AS status_clean
FROM q_fact_schedule_milestones
"""
CTES["c_fact_project_costs"] = f"""
SELECT *, abs(budget_eur) AS budget_eur_clean, abs(actual_eur) AS actual_eur_clean,
  {variance('budget_eur', 'actual_eur')} AS variance_eur_corrected,
  {fold('cost_category')} AS cost_category_clean,
  {parse_month('period_month', V.MONTH_FORMATS_SHORT)} AS period_month_dt
FROM q_fact_project_costs
"""
CTES["c_fact_purchase_orders"] = f"""
SELECT *, abs(po_value_eur) AS po_value_eur_clean, abs(invoiced_eur) AS invoiced_eur_clean,
  coalesce(abs(invoiced_eur) > abs(po_value_eur), FALSE) AS is_over_invoiced,
  {fold('po_category')} AS po_category_clean, {fold('po_status')} AS po_status_clean,
  {_three('po_date')} AS po_dt
FROM q_fact_purchase_orders
"""
CTES["c_fact_invoices"] = f"""
SELECT *, abs(amount_eur) AS amount_eur_clean, {_three('invoice_date')} AS invoice_dt,
  {_three('due_date')} AS due_dt, {_three('paid_date')} AS paid_dt,
  {fold('payment_status')} AS payment_status_clean
FROM q_fact_invoices
"""
CTES["c_fact_subcontractor_performance"] = f"""
SELECT *, {', '.join(f'{in_range(c)} AS {c}_clean' for c in V.SCORE_WEIGHTS)},
  {score(*(f'({in_range(c)})' for c in V.SCORE_WEIGHTS))} AS overall_score_corrected,
  {parse_bool('would_rehire')} AS would_rehire_bool, {_three('evaluation_date')} AS evaluation_dt
FROM q_fact_subcontractor_performance
"""
EXPECTED = {
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
    "dim_vendors": {"valid_vendor_id": "vendor_id IS NOT NULL"},
    "fact_schedule_milestones": {"valid_milestone_id": "milestone_id IS NOT NULL"},
    "fact_project_costs": {
        "valid_cost_id": "cost_id IS NOT NULL",
        "positive_budget": "abs(budget_eur) >= 0",
    },
    "fact_purchase_orders": {
        "valid_po_id": "po_id IS NOT NULL",
        "positive_po_value": "abs(po_value_eur) >= 0",
    },
    "fact_invoices": {
        "valid_invoice_id": "invoice_id IS NOT NULL",
        "positive_amount": "abs(amount_eur) >= 0",
    },
    "fact_subcontractor_performance": {"valid_perf_id": "perf_id IS NOT NULL"},
}
WARNED = {
    "fact_subcontractor_performance": {
        "quality_in_range": "quality_score_clean BETWEEN 1 AND 10 OR quality_score_clean IS NULL",
        "safety_in_range": "safety_score_clean BETWEEN 1 AND 10 OR safety_score_clean IS NULL",
    }
}
for _table, _rules in EXPECTED.items():
    CTES[f"d_{_table}"] = f"SELECT * FROM c_{_table} WHERE {' AND '.join(_rules.values())}"

# --- gold, declarative path ---------------------------------------------------------------------

CTES["dg_cost_variance_monthly"] = f"""
SELECT c.project_id, p.project_name, p.project_type_clean AS project_type,
  c.cost_category_clean AS cost_category, strftime(c.period_month_dt, '%Y-%m') AS period_year_month,
  {msum('c.budget_eur_clean')} AS total_budget_eur, {msum('c.actual_eur_clean')} AS total_actual_eur,
  {msum('c.variance_eur_corrected')} AS total_variance_eur,
  {hundredths(msum('c.actual_eur_clean'), msum('c.budget_eur_clean'))} AS budget_utilization_pct
FROM d_fact_project_costs c LEFT JOIN d_dim_projects p ON c.project_id = p.project_id
GROUP BY 1, 2, 3, 4, 5
"""
_delay = (
    "CASE WHEN m.status_clean = 'complete' THEN date_diff('day', m.planned_dt, m.actual_dt) END"
)
CTES["dg_schedule_kpi"] = f"""
SELECT m.project_id, p.project_name, m.takt_zone, count(*) AS total_milestones,
  {count_if("m.status_clean = 'complete'")} AS completed_milestones,
  {count_if("m.status_clean = 'delayed'")} AS delayed_milestones,
  {hundredths(count_if("m.status_clean = 'complete'"), 'count(*)')} AS completion_rate_pct,
  {half_up(avg(_delay), 1)} AS avg_delay_days
FROM d_fact_schedule_milestones m LEFT JOIN d_dim_projects p ON m.project_id = p.project_id
GROUP BY 1, 2, 3
"""
CTES["dg_vendor_scorecard"] = f"""
SELECT v.vendor_id, v.vendor_name, v.vendor_type_clean AS vendor_type,
  v.trade_category_clean AS trade_category,
  {half_up(mean('e.overall_score_corrected'), 2)} AS avg_overall_score,
  {half_up(mean('e.quality_score_clean'), 2)} AS avg_quality_score,
  {half_up(mean('e.safety_score_clean'), 2)} AS avg_safety_score,
  count(DISTINCT e.perf_id) AS evaluation_count,
  {hundredths(count_if('e.would_rehire_bool'), 'count(e.perf_id)')} AS rehire_rate_pct
FROM d_dim_vendors v LEFT JOIN d_fact_subcontractor_performance e ON v.vendor_id = e.vendor_id
GROUP BY 1, 2, 3, 4
"""
CTES["dg_invoice_aging"] = f"""
SELECT i.vendor_id, v.vendor_name, i.payment_status_clean AS payment_status,
  {bucket(f"date_diff('day', i.due_dt, {AS_OF})")} AS aging_bucket, count(*) AS invoice_count,
  {msum('i.amount_eur_clean')} AS total_amount_eur
FROM d_fact_invoices i LEFT JOIN d_dim_vendors v ON i.vendor_id = v.vendor_id
GROUP BY 1, 2, 3, 4
"""
CTES["dg_employee_purchase_summary"] = f"""
SELECT e.employee_id, e.full_name, e.role_clean, e.department_clean,
  count(DISTINCT o.po_id) AS total_po_count,
  CAST(round(sum({dec('o.po_value_eur_clean')}), 2) AS DOUBLE) AS total_po_value_eur,
  CAST(round(sum({dec('o.invoiced_eur_clean')}), 2) AS DOUBLE) AS total_invoiced_eur,
  {count_if('o.is_over_invoiced')} AS over_invoiced_count,
  {hundredths(count_if('o.is_over_invoiced'), 'count(DISTINCT o.po_id)')} AS over_invoiced_pct,
  count(DISTINCT p.project_id) AS project_count,
  {half_up(mean('o.po_value_eur_clean'), 2)} AS avg_po_value_eur
FROM d_dim_employee e
JOIN d_dim_projects p ON p.project_manager_id = e.employee_id
JOIN d_fact_purchase_orders o ON o.project_id = p.project_id
GROUP BY 1, 2, 3, 4
"""
