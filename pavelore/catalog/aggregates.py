"""Counts, labels, ranks and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed import CONDITIONS, LABEL
from ..operators import cleaning, labels, model, ranking, report, roads
from .base import cte, load, query, standin
from .scalars import CLEANED_SQL

_conditions = ", ".join(f'"{c}"' for c in CONDITIONS)
JOINED_SQL = f"""{CLEANED_SQL}, counts AS (
    SELECT {_conditions}, CAST(count(*) AS BIGINT) AS "count" FROM cleaned c JOIN roads r
      ON c."Street" = r.input_street AND c."City" = r.input_city
      AND c."County" = r.input_county AND c."State" = r.input_state
    GROUP BY {_conditions})"""


def condition_counts(spark, sf):
    """Cleaned accidents joined to roads, counted per condition."""
    accidents = cleaning.clean_accidents(standin(spark, sf, "accidents"))
    return labels.count_joined_conditions(accidents, standin(spark, sf, "roads"))


@query("agg_condition_count", f"WITH {cte('accidents', 'roads')}, {JOINED_SQL} SELECT * FROM counts")
def agg_condition_count(spark, sf):
    """Join first, then count."""
    accidents = cleaning.clean_accidents(standin(spark, sf, "accidents"))
    return labels.count_conditions(roads.join_roads(accidents, standin(spark, sf, "roads")))


@query("agg_joined_count", f"WITH {cte('accidents', 'roads')}, {JOINED_SQL} SELECT * FROM counts")
def agg_joined_count(spark, sf):
    """Count both sides first, then join."""
    return condition_counts(spark, sf)


_ordered = '"count" DESC, ' + ", ".join(f'"{c}" ASC' for c in CONDITIONS)


@query(
    "topn_conditions",
    f"""WITH {cte('accidents', 'roads')}, {JOINED_SQL}
    SELECT * FROM counts ORDER BY {_ordered} LIMIT 500""",
)
def topn_conditions(spark, sf):
    return labels.most_frequent(condition_counts(spark, sf), 500)


@query(
    "topn_training",
    f"""WITH {cte('accidents', 'roads')}, {JOINED_SQL}
    SELECT * FROM counts ORDER BY {_ordered} LIMIT 20000""",
)
def topn_training(spark, sf):
    """A large top n, cut by global rank instead of one task's heap."""
    return labels.most_frequent(condition_counts(spark, sf), 20_000)


@query(
    "sort_conditions",
    f"""WITH {cte('accidents', 'roads')}, {JOINED_SQL}
    SELECT *, CAST(row_number() OVER (ORDER BY {_ordered}) AS BIGINT) AS rank FROM counts""",
)
def sort_conditions(spark, sf):
    """The full descending sort, with each row's place as a column."""
    order = [F.col("count").desc(), *[F.col(f"`{c}`").asc() for c in CONDITIONS]]
    return ranking.global_rank(condition_counts(spark, sf), order)


@query(
    "agg_minmax",
    """SELECT min(l_extendedprice) AS min_pred, max(l_extendedprice) AS max_pred FROM lineitem""",
)
def agg_minmax(spark, sf):
    return load(spark, sf, "lineitem").agg(*model.prediction_range("l_extendedprice"))


@query(
    "agg_rmse",
    """SELECT round(sqrt(avg(pow(l_discount - l_quantity / 500, 2))), 9) AS rmse FROM lineitem""",
)
def agg_rmse(spark, sf):
    rows = load(spark, sf, "lineitem").withColumn("prediction", F.col("l_quantity") / 500)
    return rows.agg(F.round(model.rmse("l_discount"), 9).alias("rmse"))


@query(
    "minmax_label",
    """WITH ends AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey,
      round((l_extendedprice - lo) / (hi - lo), 9) AS row_count_norm FROM lineitem, ends""",
)
def minmax_label(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    labelled = labels.add_minmax(rows, "l_extendedprice").drop("l_extendedprice")
    return labelled.withColumn(LABEL, F.round(LABEL, 9))


def lambda_sql(pairs: str) -> str:
    """CTEs ending in ``best(lam)``: four rounds of a likelihood grid over ``pairs(x, w)``."""
    rounds = []
    grid, step = "SELECT i * 5e-1 AS lam FROM range(-40, 41) AS g(i)", 0.5
    for k in range(4):
        rounds.append(
            f"""grid{k} AS ({grid}),
    fit{k} AS (SELECT lam, (lam - 1) * sum(w * ln(x)) - sum(w) / 2e0 * ln(
        sum(w * y * y) / sum(w) - pow(sum(w * y) / sum(w), 2)) AS llf FROM (
        SELECT lam, w, x, CASE WHEN abs(lam) < 1e-9 THEN ln(x) WHEN abs(lam) < 5e-1 THEN (pow(x, lam) - 1) / lam ELSE pow(x, lam) / lam END AS y
        FROM {pairs}, grid{k}) GROUP BY lam)"""
        )
        step = step / 50
        grid = (
            f"SELECT (SELECT arg_max(lam, llf) FROM fit{k}) + i * {step!r} AS lam"
            " FROM range(-60, 61) AS g(i)"
        )
    return ",\n    ".join(rounds) + ", best AS (SELECT arg_max(lam, llf) AS lam FROM fit3)"


_pairs = """pairs AS (SELECT CAST(n + 1 AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS w FROM (
    SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY n)"""


@query(
    "boxcox_lambda",
    f"""WITH {_pairs}, {lambda_sql('pairs')} SELECT round(lam, 4) AS lam FROM best""",
)
def boxcox_lambda(spark, sf):
    """The exponent for the number of rows per order."""
    sizes = load(spark, sf, "lineitem").groupBy("l_orderkey").agg((F.count(F.lit(1)) + 1).alias("x"))
    lam = labels.boxcox_lambda(sizes, "x")
    return spark.range(1).select(F.round(F.lit(lam), 4).alias("lam"))


LABEL_SQL = f"""{JOINED_SQL}, top AS (
    SELECT * FROM counts ORDER BY {_ordered} LIMIT 220000),
  pairs AS (SELECT CAST("count" + 1 AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS w FROM top GROUP BY "count"),
  {lambda_sql('pairs')},
  powered AS (SELECT top.*, CASE WHEN abs(lam) < 1e-9 THEN ln("count" + 1)
    ELSE (pow("count" + 1, lam) - 1) / lam END AS count_bc FROM top, best),
  ends AS (SELECT min(count_bc) AS lo, max(count_bc) AS hi FROM powered)"""


@query(
    "risk_label",
    f"""WITH {cte('accidents', 'roads')}, {LABEL_SQL}
    SELECT {_conditions}, "count", round(count_bc, 4) AS count_bc,
      round((count_bc - lo) / (hi - lo), 4) AS row_count_norm FROM powered, ends""",
)
def risk_label(spark, sf):
    """Flagship: accidents and roads to the labelled training table."""
    return flagship(spark, sf).withColumns(
        {"count_bc": F.round("count_bc", 4), LABEL: F.round(LABEL, 4)}
    )


def flagship(spark, sf):
    from ..plans.train import training_table

    table, _ = training_table(standin(spark, sf, "accidents"), standin(spark, sf, "roads"))
    return table


@query(
    "frequency_index",
    """SELECT p_name, CAST(count(*) AS BIGINT) AS frequency,
      CAST(row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS DOUBLE) AS p_name_indexed
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name""",
)
def frequency_index(spark, sf):
    parts = load(spark, sf, "part").select("p_partkey", "p_name")
    rows = load(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    per_part = rows.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n"))
    return ranking.frequency_index(per_part.join(parts, "p_partkey"), "p_name", weight="n")


@query(
    "top_candidates",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey
      ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 100""",
)
def top_candidates(spark, sf):
    """The 100 best rows of every group."""
    rows = load(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return ranking.top_per_group(rows, ["l_suppkey"], order, 100)


@query(
    "dash_road_metrics",
    f"""WITH {cte('scored')}
    SELECT name, round(avg(danger_index), 9) AS avg_danger, min(danger_index) AS min_danger,
      max(danger_index) AS max_danger FROM scored WHERE name IS NOT NULL GROUP BY name""",
)
def dash_road_metrics(spark, sf):
    metrics = report.road_metrics(standin(spark, sf, "scored"))
    return metrics.withColumn("avg_danger", F.round("avg_danger", 9))


@query(
    "dash_top5_other",
    f"""WITH {cte('scored')},
    best AS (SELECT name FROM scored WHERE name IS NOT NULL GROUP BY name
      ORDER BY avg(danger_index) DESC, name LIMIT 5)
    SELECT CASE WHEN b.name IS NULL THEN 'Other' ELSE s.name END AS name, b.name IS NULL AS is_other,
      round(avg(danger_index), 9) AS avg_danger, min(danger_index) AS min_danger,
      max(danger_index) AS max_danger
    FROM scored s LEFT JOIN best b ON s.name = b.name WHERE s.name IS NOT NULL GROUP BY 1, 2""",
)
def dash_top5_other(spark, sf):
    top = report.top_roads(standin(spark, sf, "scored"))
    return top.withColumn("avg_danger", F.round("avg_danger", 9))
