"""Features and model."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from oracle import core as O
from projectmart.functions import fixed_values as V
from projectmart.functions.values import round_half_up
from projectmart.plans import explain, features, leafwise, model, serve
from projectmart.plans.features import LABEL
from projectmart.sources.tables import Layers, ensure_namespaces, put_metadata, shared_folder
from registry import scalar  # noqa: F401  (the fixed predictions in SQL)
from registry.base import Stored, Tables, query, stored_query

_budget, _actual = f"sum({O.dec('budget_eur')})", f"sum({O.dec('actual_eur')})"
O.CTES["f_costs"] = f"""
SELECT project_id, {O.msum('budget_eur')} AS total_budget, {O.msum('actual_eur')} AS total_actual,
  {O.msum('committed_eur')} AS total_committed, {O.msum('variance_eur')} AS total_variance,
  count(*) AS cost_line_count, count(DISTINCT cost_category) AS distinct_cost_categories,
  {O.count_if('variance_eur < 0')} AS overrun_line_count,
  {O.pct(O.msum('actual_eur'), O.msum('budget_eur'))} AS budget_utilization_pct,
  {O.ratio(O.msum('committed_eur'), O.msum('budget_eur'))} AS committed_ratio,
  {O.pct(O.count_if('variance_eur < 0'), 'count(*)')} AS overrun_line_pct,
  CASE WHEN CAST({_actual} AS DECIMAL(30,4))
    > CAST({_budget} AS DECIMAL(30,4)) * CAST(1.10 AS DECIMAL(4,2)) THEN 1 ELSE 0 END
    AS is_over_budget
FROM s_fact_project_costs GROUP BY 1
"""
O.CTES["f_schedule"] = f"""
SELECT project_id, count(*) AS total_milestones,
  {O.count_if("milestone_status = 'complete'")} AS completed_ms,
  {O.count_if("milestone_status = 'delayed'")} AS delayed_ms,
  {O.half_up(O.avg('delay_days'), 2)} AS avg_delay_days, max(delay_days) AS max_delay_days,
  count(DISTINCT takt_zone) AS distinct_takt_zones,
  {O.ratio(O.count_if("milestone_status = 'complete'"), 'count(*)')} AS ms_completion_rate,
  {O.ratio(O.count_if("milestone_status = 'delayed'"), 'count(*)')} AS ms_delay_rate
FROM s_fact_schedule_milestones GROUP BY 1
"""
O.CTES["f_vendors"] = f"""
SELECT project_id, {O.half_up(O.mean('overall_score'), 2)} AS avg_vendor_score,
  {O.half_up('min(overall_score)', 2)} AS min_vendor_score,
  count(DISTINCT vendor_id) AS distinct_vendors,
  {O.count_if('NOT would_rehire')} AS no_rehire_count
FROM s_fact_subcontractor_performance GROUP BY 1
"""
O.CTES["f_orders"] = f"""
SELECT project_id, {O.msum('po_value_eur')} AS total_po_value,
  {O.msum('invoiced_eur')} AS total_invoiced_from_po, count(*) AS total_pos,
  {O.count_if('is_over_invoiced')} AS over_invoiced_pos,
  count(DISTINCT vendor_id) AS distinct_po_vendors,
  {O.ratio(O.count_if('is_over_invoiced'), 'count(*)')} AS over_invoice_rate
FROM s_fact_purchase_orders GROUP BY 1
"""
O.CTES["f_projects"] = """
SELECT project_id, project_type, municipality, status, contract_value_eur, floor_area_m2,
  CAST(date_diff('day', start_date_dt, planned_end_date_dt) AS INTEGER) AS planned_duration_days
FROM s_dim_projects
"""
NUMBERS = {
    "p": ("contract_value_eur", "floor_area_m2", "planned_duration_days"),
    "c": (
        "total_budget", "total_actual", "total_committed", "total_variance", "cost_line_count",
        "distinct_cost_categories", "overrun_line_count", "budget_utilization_pct",
        "committed_ratio", "overrun_line_pct",
    ),
    "m": (
        "total_milestones", "completed_ms", "delayed_ms", "avg_delay_days", "max_delay_days",
        "distinct_takt_zones", "ms_completion_rate", "ms_delay_rate",
    ),
    "v": ("avg_vendor_score", "min_vendor_score", "distinct_vendors", "no_rehire_count"),
    "o": (
        "total_po_value", "total_invoiced_from_po", "total_pos", "over_invoiced_pos",
        "distinct_po_vendors", "over_invoice_rate",
    ),
}
_numbers = ", ".join(
    f"coalesce({alias}.{c}, 0) AS {c}" for alias, columns in NUMBERS.items() for c in columns
)
O.CTES["f_table"] = f"""
SELECT p.project_id, p.project_type, p.municipality, p.status, c.is_over_budget, {_numbers}
FROM f_projects p JOIN f_costs c ON p.project_id = c.project_id
LEFT JOIN f_schedule m ON p.project_id = m.project_id
LEFT JOIN f_vendors v ON p.project_id = v.project_id
LEFT JOIN f_orders o ON p.project_id = o.project_id
"""


@query("ft_1_cost_features", "SELECT * FROM f_costs")
def _(t: Tables):
    return features.cost_features(t.silver["fact_project_costs"])


@query(
    "ft_2_overrun_label",
    "SELECT project_id, is_over_budget, total_actual, total_budget FROM f_costs",
)
def _(t: Tables):
    return features.cost_features(t.silver["fact_project_costs"]).select(
        "project_id", "is_over_budget", "total_actual", "total_budget"
    )


@query("ft_3_schedule_features", "SELECT * FROM f_schedule")
def _(t: Tables):
    return features.schedule_features(t.silver["fact_schedule_milestones"])


@query("ft_4_vendor_features", "SELECT * FROM f_vendors")
def _(t: Tables):
    return features.vendor_features(t.silver["fact_subcontractor_performance"])


@query("ft_5_po_features", "SELECT * FROM f_orders")
def _(t: Tables):
    return features.po_features(t.silver["fact_purchase_orders"])


@query("ft_6_project_features", "SELECT * FROM f_projects")
def _(t: Tables):
    return features.project_features(t.silver["dim_projects"])


@query("ft_7_feature_table", "SELECT * FROM f_table")
def _(t: Tables):
    return t.features.drop("ingestion_timestamp")


@query(
    "ft_8_label_distribution",
    "SELECT is_over_budget, count(*) AS \"count\" FROM f_table GROUP BY 1",
)
def _(t: Tables):
    return features.label_distribution(t.features)


def _code(column: str) -> str:
    return (
        f"CAST(dense_rank() OVER (ORDER BY coalesce({column}, 'unknown')) - 1 AS DOUBLE)"
        f" AS {column}_code"
    )


@query(
    "ml_1_encode",
    f"SELECT project_id, {', '.join(_code(c) for c in model.CATEGORIES)} FROM f_table",
)
def _(t: Tables):
    return model.encode(t.features).select("project_id", *[f"{c}_code" for c in model.CATEGORIES])


@query(
    "ml_2_stratified_split",
    "SELECT is_over_budget, count(*) AS all_rows, TRUE AS near_a_fifth FROM f_table GROUP BY 1",
)
def _(t: Tables):
    marked = model.with_split(t.features.select("project_id", "is_over_budget"))
    # The cut is a quantile: a class may be a row off, and the sketch a hundredth.
    off = F.abs(F.count_if("_test") - F.count("*") * V.TEST_FRACTION)
    return marked.groupBy("is_over_budget").agg(
        F.count("*").alias("all_rows"),
        (off <= F.count("*") * 0.01 + 1).alias("near_a_fifth"),
    )


@stored_query("ml_3_train")
def _(s: Stored):
    """Every fitted tree with its weight, size and the training rows that went through it."""
    leaf = F.col("left") < 0
    return explain.tree_nodes(s.model).groupBy("tree", "weight").agg(
        F.count("*").alias("nodes"),
        F.count_if(leaf).alias("leaves"),
        F.sum(F.when(leaf, F.col("cover"))).cast("bigint").alias("rows"),
    )


_EDGES = {"budget_utilization_pct": (80.0, 100.0, 120.0), "total_milestones": (5.0, 20.0)}
_binned = " UNION ALL ".join(
    f"SELECT {f} AS feature, {' + '.join(f'CAST({c} > {e} AS INTEGER)' for e in edges)} AS bin,"
    " is_over_budget FROM f_table"
    for f, (c, edges) in enumerate(_EDGES.items())
)


@query(
    "ml_3_histogram",
    "SELECT feature, bin, count(*) AS n, CAST(sum(is_over_budget) AS BIGINT) AS overruns"
    f" FROM ({_binned}) GROUP BY 1, 2",
)
def _(t: Tables):
    """What a level of best-first growth adds up, for one node and fixed bins."""
    inputs = list(_EDGES)
    rows = t.features.select("is_over_budget", *inputs)
    state = rows.select("is_over_budget", leafwise.binned(rows, inputs, list(_EDGES.values())).alias("bins"))
    sums = leafwise.histogram(state, F.lit(0), F.col("is_over_budget").cast("bigint"), F.lit(1))
    return sums.select("feature", "bin", "n", F.col("g").alias("overruns"))


@stored_query("ml_3_best_first")
def _(s: Stored):
    """Five trees of at most 31 leaves: rows, splits and leaves of each."""
    inputs = model.model_features(s.training)
    rows = model.with_weights(model.with_codes(s.training, s.model.codes, "number"))
    fitted = leafwise.fit(rows, inputs, LABEL, "weight", rounds=5)
    leaf = F.col("left") < 0
    return fitted.nodes(s.spark).groupBy("tree").agg(
        F.count("*").alias("nodes"),
        F.count_if(leaf).alias("leaves"),
        F.sum(F.when(leaf, F.col("cover"))).cast("bigint").alias("rows"),
    )


@query(
    "ml_4_class_weights",
    "SELECT is_over_budget, CAST(sum(n) OVER () AS DOUBLE) / CAST(count(*) OVER () * n AS DOUBLE)"
    " AS weight FROM (SELECT is_over_budget, count(*) AS n FROM f_table GROUP BY 1)",
)
def _(t: Tables):
    return model.class_weights(t.features.select("is_over_budget"))


@stored_query("ml_5_predict")
def _(s: Stored):
    return model.predict(s.model, s.features)


O.CTES["p_labelled"] = """
SELECT s.*, f.is_over_budget, CASE WHEN s.overrun_probability > 0.5 THEN 1 ELSE 0 END AS predicted
FROM p_scores s JOIN f_table f ON s.project_id = f.project_id
"""
_report = " UNION ALL ".join(
    f"""SELECT {c} AS "class", count(*) FILTER (WHERE is_over_budget = {c} AND predicted = {c}) AS hit,
    count(*) FILTER (WHERE predicted = {c}) AS pred,
    count(*) FILTER (WHERE is_over_budget = {c}) AS support FROM p_labelled"""
    for c in (0, 1)
)
O.CTES["p_report"] = f"""
SELECT "class", {O.ratio('hit', 'pred')} AS precision, {O.ratio('hit', 'support')} AS recall,
  {O.ratio('2 * hit', 'pred + support')} AS f1, support
FROM ({_report})
"""


@query(
    "ml_6_evaluate",
    f"""SELECT {O.half_up('''(CAST(sum(r) FILTER (WHERE y = 1) AS DOUBLE)
      - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
      / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0))''', 6)}
      AS auc_roc,
      (SELECT {O.half_up('''2.0::DOUBLE * count(*) FILTER (WHERE is_over_budget = 1 AND predicted = 1)
        / (count(*) FILTER (WHERE predicted = 1) + count(*) FILTER (WHERE is_over_budget = 1))''', 6)}
       FROM p_labelled) AS f1_score
    FROM (SELECT is_over_budget AS y, CAST(rank() OVER (ORDER BY overrun_probability) AS DOUBLE)
      + (count(*) OVER (PARTITION BY overrun_probability) - 1) / 2.0 AS r FROM p_labelled)""",
)
def _(t: Tables):
    metrics = model.evaluate(t.labelled_predictions)
    rows = [(round(metrics["auc_roc"], 6), round(metrics["f1_score"], 6))]
    return t.spark.createDataFrame(rows, "auc_roc double, f1_score double")


@query("ml_7_classification_report", "SELECT * FROM p_report")
def _(t: Tables):
    return model.classification_report(t.labelled_predictions)


@query(
    "ml_8_log_run",
    "SELECT 'label.' || is_over_budget AS \"key\", CAST(count(*) AS VARCHAR) AS \"value\""
    " FROM f_table GROUP BY is_over_budget",
)
def _(t: Tables):
    layers = Layers(f"run_{uuid.uuid4().hex}_", shared_folder(t.spark))
    ensure_namespaces(t.spark, layers)
    counts = features.label_distribution(t.features)
    entries = counts.select(
        F.concat(F.lit("label."), F.col("is_over_budget").cast("string")).alias("key"),
        F.col("count").cast("string").alias("value"),
    )
    return put_metadata(t.spark, layers, entries).select("key", "value")


@stored_query("ml_9_saved_model")
def _(s: Stored):
    return model.predict(model.load_model(s.model_path), s.features).select(
        "project_id", "overrun_probability"
    )


@stored_query("ml_10_feature_importance")
def _(s: Stored):
    measured = model.feature_importance(s.model, s.test)
    return measured.join(explain.shapley_ranking(s.model, s.test), "feature")


# A tree of two splits and three leaves: what a fixed rule gives away, and to which feature.
_SPLITS = (("budget_utilization_pct", 100.0), ("total_milestones", 20.0))
_LEAVES = {"high": 4.0, "low_few": -1.0, "low_many": 2.0}
_TWO_SPLITS = f"""
SELECT project_id, {_SPLITS[0][0]} <= {_SPLITS[0][1]} AS low, {_SPLITS[1][0]} <= {_SPLITS[1][1]} AS few
FROM f_table
"""
O.CTES["x_two_splits"] = f"""
SELECT t.*, a, f, CAST(CASE WHEN low THEN f * {_LEAVES['low_few']} + (1 - f) * {_LEAVES['low_many']}
    ELSE {_LEAVES['high']} END AS DOUBLE) AS knows_first,
  CAST(a * CASE WHEN few THEN {_LEAVES['low_few']} ELSE {_LEAVES['low_many']} END
    + (1 - a) * {_LEAVES['high']} AS DOUBLE) AS knows_second,
  CAST(CASE WHEN NOT low THEN {_LEAVES['high']} WHEN few THEN {_LEAVES['low_few']}
    ELSE {_LEAVES['low_many']} END AS DOUBLE) AS knows_both,
  CAST(a * (f * {_LEAVES['low_few']} + (1 - f) * {_LEAVES['low_many']}) + (1 - a) * {_LEAVES['high']}
    AS DOUBLE) AS knows_nothing
FROM ({_TWO_SPLITS}) t, (SELECT CAST(count(*) FILTER (WHERE low) AS DOUBLE) / count(*) AS a,
  CAST(count(*) FILTER (WHERE low AND few) AS DOUBLE) / count(*) FILTER (WHERE low) AS f
  FROM ({_TWO_SPLITS}))
"""


@query(
    "ml_10_shapley_of_two_splits",
    f"""SELECT project_id, {O.half_up('knows_nothing', 4)} AS base,
    {O.half_up('(knows_first - knows_nothing + knows_both - knows_second) / 2', 4)} AS first_share,
    {O.half_up('(knows_second - knows_nothing + knows_both - knows_first) / 2', 4)} AS second_share
    FROM x_two_splits""",
)
def _(t: Tables):
    # Counted and explained: written once, three columns a project.
    path = f"{shared_folder(t.spark)}/splits"
    t.features.select("project_id", *[c for c, _ in _SPLITS]).write.parquet(path)
    table = t.spark.read.parquet(path)
    low, few = (F.col(c) <= bound for c, bound in _SPLITS)
    n, n_low, n_few = (
        table.agg(F.count("*"), F.count_if(low), F.count_if(low & few)).first()
    )
    rows = [
        (0, 0, 1, 4, 0, _SPLITS[0][1], 0.0, n),
        (0, 1, 2, 3, 1, _SPLITS[1][1], 0.0, n_low),
        (0, 2, -1, -1, -1, None, _LEAVES["low_few"], n_few),
        (0, 3, -1, -1, -1, None, _LEAVES["low_many"], n_low - n_few),
        (0, 4, -1, -1, -1, None, _LEAVES["high"], n - n_low),
    ]
    nodes = t.spark.createDataFrame(
        [(*r[:7], float(r[7]), 1.0) for r in rows],
        "tree int, id int, left int, right int, feature int, threshold double, value double,"
        " cover double, weight double",
    )
    leaves = explain.tree_leaves(nodes)
    x = F.array(*[F.col(c).cast("double") for c, _ in _SPLITS]).alias("x")
    found = explain.explain(table.select(F.col("project_id").alias("id"), x), leaves, len(_SPLITS))
    return found.select(
        F.col("id").alias("project_id"),
        round_half_up(F.lit(explain.base_value(leaves)), 4).alias("base"),
        *[
            round_half_up(F.get("shapley", F.lit(j)), 4).alias(name)
            for j, name in enumerate(("first_share", "second_share"))
        ],
    )


@stored_query("ml_11_score_projects")
def _(s: Stored):
    return model.score_projects(s.model, s.features).drop("scored_at")


@query(
    "ml_12_risk_distribution",
    "SELECT risk_level, count(*) AS \"count\" FROM p_scores GROUP BY 1",
)
def _(t: Tables):
    return serve.risk_distribution(t.fixed_scores)
