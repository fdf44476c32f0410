"""Model queries. Forest output has no SQL twin; features and codes have."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..fixed import CATEGORIES, CONDITIONS, FEATURES, LABEL
from ..operators import cleaning, model
from ..plans.train import training_table
from ..session import materialize, scratch_path
from .base import cte, query, standin
from .aggregates import JOINED_SQL, condition_counts
from .scalars import CLEANED_SQL

_trained: dict = {}


def trained(spark, sf):
    """The labelled table and the model fitted on it, once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trained:
        table, _ = training_table(standin(spark, sf, "accidents"), standin(spark, sf, "roads"))
        table = materialize(table)
        _trained[key] = (table, model.train(table))
    return _trained[key]


def _indexed(spark, sf):
    cleaned = cleaning.clean_accidents(standin(spark, sf, "accidents"))
    return cleaned.withColumn("highway", F.concat(F.lit("way "), F.col("County")))


def _index_sql(column: str) -> str:
    return f"""index_{column} AS (SELECT "{column}" AS v,
      CAST(row_number() OVER (ORDER BY count(*) DESC, "{column}") - 1 AS DOUBLE) AS code
      FROM featured GROUP BY "{column}")"""


_codes = {f"{c}_indexed": f"i{n}.code" for n, c in enumerate(CATEGORIES)}
_feature_columns = ", ".join(
    f'{_codes[c]} AS "{c}"' if c in _codes else f'CAST(f."{c}" AS DOUBLE) AS "{c}"' for c in FEATURES
)


@query(
    "ml_features",
    f"""WITH {cte('accidents')}, {CLEANED_SQL},
    featured AS (SELECT *, 'way ' || "County" AS highway FROM cleaned),
    {', '.join(_index_sql(c) for c in CATEGORIES)}
    SELECT {_feature_columns} FROM featured f
    {' '.join(f'JOIN index_{c} i{n} ON i{n}.v = f."{c}"' for n, c in enumerate(CATEGORIES))}""",
)
def ml_features(spark, sf):
    """Category codes and the assembled vector, shown as 16 columns."""
    rows = _indexed(spark, sf)
    vectors = Pipeline(stages=model.feature_stages()).fit(rows).transform(rows)
    values = vector_to_array(F.col(model.VECTOR))
    return vectors.select(*[values[i].alias(name) for i, name in enumerate(FEATURES)])


# A tree of one split, on a label that one flag decides up to noise: its predictions are two
# group means, so SQL can state all that follows from them. Labels are exact binary fractions.
STUMP_FLAG = "Crossing"
_stump_label = f"""(0.25e0 + 0.5e0 * "{STUMP_FLAG}" + 0.125e0 * ("count" % 2))"""
STUMP_SQL = f"""{JOINED_SQL},
    labelled AS (SELECT *, {_stump_label} AS label FROM counts),
    means AS (SELECT "{STUMP_FLAG}" AS flag, avg(label) AS mean FROM labelled GROUP BY 1),
    figures AS (SELECT min(mean) AS min_pred, max(mean) AS max_pred,
      round(sqrt(avg((label - mean) * (label - mean))), 9) AS rmse
      FROM labelled JOIN means ON flag = "{STUMP_FLAG}")"""
_stumps: dict = {}


def stump(spark, sf):
    """The labelled table and the one-split model, once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stumps:
        label = F.lit(0.25) + 0.5 * F.col(STUMP_FLAG) + 0.125 * (F.col("count") % 2)
        table = materialize(condition_counts(spark, sf).withColumn(LABEL, label))
        _stumps[key] = (table, model.train(table, trees=1, depth=1, bootstrap=False))
    return _stumps[key]


@query(
    "ml_stump_score",
    f"""WITH {cte('accidents', 'roads')}, {STUMP_SQL}
    SELECT {', '.join(f'"{c}"' for c in CONDITIONS)}, mean AS prediction
    FROM labelled JOIN means ON flag = "{STUMP_FLAG}\"""",
)
def ml_stump_score(spark, sf):
    """Train a one-split forest and score the training table."""
    table, fitted = stump(spark, sf)
    return fitted.transform(table).select(*[F.col(f"`{c}`") for c in CONDITIONS], "prediction")


@query("ml_stump_evaluate", f"WITH {cte('accidents', 'roads')}, {STUMP_SQL} SELECT * FROM figures")
def ml_stump_evaluate(spark, sf):
    table, fitted = stump(spark, sf)
    return model.evaluate(fitted.transform(table)).withColumn("rmse", F.round("rmse", 9))


_fold = "('0x' || substr(md5(concat_ws('|', " + ", ".join(f'"{c}"' for c in CONDITIONS) + ")), 1, 8))::BIGINT % 5"


@query(
    "ml_holdout",
    f"""WITH {cte('accidents', 'roads')}, {JOINED_SQL},
    labelled AS (SELECT *, {_stump_label} AS label, {_fold} AS fold FROM counts),
    means AS (SELECT f.fold, "{STUMP_FLAG}" AS flag, avg(label) AS mean
      FROM labelled l JOIN (SELECT DISTINCT fold FROM labelled) f ON l.fold <> f.fold GROUP BY ALL)
    SELECT l.fold, count(*) AS n, round(min(mean), 9) AS min_pred, round(max(mean), 9) AS max_pred,
      round(sqrt(avg((label - mean) * (label - mean))), 9) AS rmse
    FROM labelled l JOIN means m ON m.fold = l.fold AND m.flag = l."{STUMP_FLAG}" GROUP BY l.fold""",
)
def ml_holdout(spark, sf):
    """Errors of five one-split models, each on the fold that it has not seen."""
    found = model.holdout(stump(spark, sf)[0], 5, trees=1, depth=1, bootstrap=False)
    return found.select("fold", "n", *[F.round(c, 9).alias(c) for c in ("min_pred", "max_pred", "rmse")])


_importances = ", ".join(f"({i}, '{f}', {float(f == STUMP_FLAG)}e0)" for i, f in enumerate(FEATURES))


@query(
    "ml_stump_importance",
    f"""WITH {cte('accidents', 'roads')}, {JOINED_SQL}
    SELECT position::INTEGER AS position, feature, importance
    FROM (VALUES {_importances}) v(position, feature, importance), (SELECT count(*) AS n FROM counts) WHERE n > 0""",
)
def ml_stump_importance(spark, sf):
    """All importance is the flag's."""
    return model.importances(stump(spark, sf)[1], spark)


@query(
    "ml_stump_report",
    f"""WITH {cte('accidents', 'roads')}, {STUMP_SQL}
    SELECT 'v1' AS version, 0::INTEGER AS position, 'min_pred' AS metric, round(min_pred, 9) AS value FROM figures
    UNION ALL SELECT 'v1', 1, 'max_pred', round(max_pred, 9) FROM figures
    UNION ALL SELECT 'v1', 2, 'rmse', rmse FROM figures
    UNION ALL SELECT 'v1', position + 3, 'importance ' || feature, importance
      FROM (VALUES {_importances}) v(position, feature, importance)""",
)
def ml_stump_report(spark, sf):
    """The report of the one-split model, appended to a table and read back."""
    table, fitted = stump(spark, sf)
    path = scratch_path(spark, "report")
    model.append_report(model.report(fitted, fitted.transform(table), "v1"), path)
    return spark.read.parquet(path).withColumn("value", F.round("value", 9))


# A tree of three levels on a label that three flags decide up to noise. The twin searches the best
# split of every node over all features and values by itself, level by level.
_depth3_label = """(0.0625e0 + 0.5e0 * "Crossing" + 0.25e0 * "Junction" + 0.125e0 * "Stop" + 0.015625e0 * ("count" % 2))"""
_feature_values = ", ".join(
    f"""({i}, "{f.removesuffix('_indexed')}"::VARCHAR, NULL)""" if f.endswith("_indexed") else f"""({i}, "{f}"::VARCHAR, "{f}"::DOUBLE)"""
    for i, f in enumerate(FEATURES)
)


def _level_sql(level: int) -> str:
    """CTEs: the best split of each node of a level, and the rows' nodes on the next.

    Values of a feature are in order, categories by the mean label of their rows; a split
    sends the first ones left. Of the largest fall in squared error the first feature and
    the first split count.
    """
    return f"""vals{level} AS (SELECT node, f, v, any_value(x) AS x, count(*)::DOUBLE AS n, sum(label) AS s
      FROM nodes{level} JOIN feats USING (id) GROUP BY node, f, v),
    runs{level} AS (SELECT *, row_number() OVER w AS r, sum(n) OVER w AS ln, sum(s) OVER w AS ls,
        sum(n) OVER (PARTITION BY node, f) AS alln, sum(s) OVER (PARTITION BY node, f) AS alls
      FROM vals{level} WINDOW w AS (PARTITION BY node, f ORDER BY coalesce(x, s / n), v ROWS UNBOUNDED PRECEDING)),
    best{level} AS (SELECT node, f, r, ls * ls / ln + (alls - ls) * (alls - ls) / (alln - ln) - alls * alls / alln AS gain
      FROM runs{level} WHERE ln < alln
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, r) = 1),
    nodes{level + 1} AS (SELECT id, node * 2 + (runs.r > best.r)::INT AS node
      FROM nodes{level} JOIN best{level} best USING (node) JOIN feats USING (id, f)
      JOIN runs{level} runs USING (node, f, v))"""


DEPTH3_SQL = f"""{JOINED_SQL},
    labelled AS (SELECT *, {_depth3_label} AS label, row_number() OVER () AS id FROM counts),
    feats AS (SELECT id, label, f, v, x FROM labelled, LATERAL (VALUES {_feature_values}) t(f, v, x)),
    nodes0 AS (SELECT id, 1 AS node FROM labelled),
    {", ".join(_level_sql(level) for level in range(3))},
    leaves AS (SELECT node, avg(label) AS mean FROM nodes3 JOIN labelled USING (id) GROUP BY node),
    gains AS (SELECT f, sum(gain) AS gain FROM (FROM best0 UNION ALL FROM best1 UNION ALL FROM best2) GROUP BY f)"""
_depth3: dict = {}


def depth3(spark, sf):
    """The labelled table and the unsampled tree of three levels, once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _depth3:
        parts = ((0.5, "Crossing"), (0.25, "Junction"), (0.125, "Stop"))
        label = F.lit(0.0625) + 0.015625 * (F.col("count") % 2)
        for weight, flag in parts:
            label = label + weight * F.col(flag)
        table = materialize(condition_counts(spark, sf).withColumn(LABEL, label))
        _depth3[key] = (table, model.train(table, trees=1, depth=3, bootstrap=False))
    return _depth3[key]


@query(
    "ml_depth3_score",
    f"""WITH {cte('accidents', 'roads')}, {DEPTH3_SQL}
    SELECT {', '.join(f'"{c}"' for c in CONDITIONS)}, round(mean, 9) AS prediction
    FROM labelled JOIN nodes3 USING (id) JOIN leaves USING (node)""",
)
def ml_depth3_score(spark, sf):
    """Train a tree of three levels and score the training table."""
    table, fitted = depth3(spark, sf)
    scored = fitted.transform(table)
    return scored.select(*[F.col(f"`{c}`") for c in CONDITIONS], F.round("prediction", 9).alias("prediction"))


_all_features = ", ".join(f"({i}, '{f}')" for i, f in enumerate(FEATURES))
_weights_sql = f"""weights AS (SELECT i::INTEGER AS position, feature,
      round(coalesce(gain, 0e0) / (SELECT sum(gain) FROM gains), 9) AS importance
    FROM (VALUES {_all_features}) v(i, feature) LEFT JOIN gains ON f = i)"""


@query("ml_depth3_importance", f"WITH {cte('accidents', 'roads')}, {DEPTH3_SQL}, {_weights_sql} SELECT * FROM weights")
def ml_depth3_importance(spark, sf):
    """Shares of the fall in squared error, by feature."""
    found = model.importances(depth3(spark, sf)[1], spark)
    return found.withColumn("importance", F.round("importance", 9))


@query(
    "ml_depth3_report",
    f"""WITH {cte('accidents', 'roads')}, {DEPTH3_SQL}, {_weights_sql},
    figures AS (SELECT min(mean) AS low, max(mean) AS high, sqrt(avg((label - mean) * (label - mean))) AS rmse
      FROM labelled JOIN nodes3 USING (id) JOIN leaves USING (node))
    SELECT 'v3' AS version, 0::INTEGER AS position, 'min_pred' AS metric, round(low, 9) AS value FROM figures
    UNION ALL SELECT 'v3', 1, 'max_pred', round(high, 9) FROM figures
    UNION ALL SELECT 'v3', 2, 'rmse', round(rmse, 9) FROM figures
    UNION ALL SELECT 'v3', position + 3, 'importance ' || feature, importance FROM weights""",
)
def ml_depth3_report(spark, sf):
    """The report of the tree of three levels, appended to a table and read back."""
    table, fitted = depth3(spark, sf)
    path = scratch_path(spark, "report")
    model.append_report(model.report(fitted, fitted.transform(table), "v3"), path)
    return spark.read.parquet(path).withColumn("value", F.round("value", 9))


@query("ml_train")
def ml_train(spark, sf):
    """Fit on the labelled table; predictions per condition."""
    table, fitted = trained(spark, sf)
    return fitted.transform(table).select("highway", "Weather_Condition", "count", LABEL, "prediction")


@query("ml_score")
def ml_score(spark, sf):
    """Score every condition of the accidents, also the rare ones, with the fitted model."""
    _, fitted = trained(spark, sf)
    scored = fitted.transform(condition_counts(spark, sf))
    return scored.select(*[F.col(f"`{c}`") for c in CONDITIONS], "count", "prediction")


@query("ml_evaluate")
def ml_evaluate(spark, sf):
    table, fitted = trained(spark, sf)
    return model.evaluate(fitted.transform(table))


@query("ml_importance")
def ml_importance(spark, sf):
    _, fitted = trained(spark, sf)
    return model.importances(fitted, spark)


@query("ml_report")
def ml_report(spark, sf):
    """Range, error and importances, appended to a report table and read back."""
    table, fitted = trained(spark, sf)
    path = scratch_path(spark, "report")
    model.append_report(model.report(fitted, fitted.transform(table), "v1"), path)
    return spark.read.parquet(path)


@query(
    "ml_save_load",
    f"""WITH {cte('accidents', 'roads')}, {JOINED_SQL}
    SELECT least(count(*), 220000) AS rows, 0::BIGINT AS different FROM counts""",
)
def ml_save_load(spark, sf):
    """Save under a version, load it again, and compare both models' predictions."""
    table, fitted = trained(spark, sf)
    folder = scratch_path(spark, "models")
    loaded = model.load_model(folder, model.save_model(fitted, folder))
    before = fitted.transform(table).withColumnRenamed("prediction", "before")
    keep = [c for c in before.columns if not c.endswith("_indexed") and c != model.VECTOR]
    both = loaded.transform(before.select(*[F.col(f"`{c}`") for c in keep]))
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("before") != F.col("prediction"), 1)).alias("different"),
    )
