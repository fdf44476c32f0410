"""Train: accidents and roads to a risk model.

    spark-submit -m pavelore.plans.train --accidents A.csv --roads R.csv --out FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..fixed import MAX_TRAINING_CONDITIONS
from ..operators import cleaning, labels, model
from ..schemas import ACCIDENTS, ROADS
from ..sources.files import read_csv, read_csv_checked


def training_table(
    accidents: DataFrame, roads: DataFrame, n: int = MAX_TRAINING_CONDITIONS
) -> tuple[DataFrame, float]:
    """The ``n`` most frequent conditions with ``count_bc`` and label, and the exponent."""
    counts = labels.count_joined_conditions(cleaning.clean_accidents(accidents), roads)
    return labels.risk_label(labels.most_frequent(counts, n))


def train_and_save(
    table: DataFrame, folder: str, version: str | None = None, folds: int = 0, **settings
) -> tuple[PipelineModel, str]:
    """Fit on the labelled table, save model, report and table; returns model and version.

    With ``folds`` the report also has the error on each fold of a model that has not seen it.

    The table is saved beside the model, so that a refit needs no accidents.
    """
    table = table.persist()
    try:
        fitted = model.train(table, **settings)
        version = model.save_model(fitted, folder, version)
        rows = model.report(fitted, fitted.transform(table), version)
        if folds:
            rows = rows.unionByName(model.holdout_report(model.holdout(table, folds, **settings), version))
        model.append_report(rows, f"{folder}/{version}/report")
        table.write.mode("overwrite").parquet(f"{folder}/{version}/training")
    finally:
        table.unpersist()
    return fitted, version


def train_from_files(
    spark: SparkSession, accidents: str, roads: str, folder: str, n: int = MAX_TRAINING_CONDITIONS, **settings
) -> tuple[PipelineModel, str, float]:
    """Train on CSV files with any further columns in any order.

    Broken lines of the accidents are written beside the model, with the reason.
    """
    good, broken = read_csv_checked(spark, accidents, ACCIDENTS)
    table, lam = training_table(good, read_csv(spark, roads, ROADS), n)
    fitted, version = train_and_save(table, folder, **settings)
    broken.write.mode("overwrite").json(f"{folder}/{version}/rejects")
    return fitted, version, lam


def main() -> None:
    options = argparse.ArgumentParser(description=__doc__)
    for name in ("accidents", "roads", "out"):
        options.add_argument(f"--{name}", required=True)
    options.add_argument("--rows", type=int, default=MAX_TRAINING_CONDITIONS)
    options.add_argument("--folds", type=int, default=0, help="also report errors on so many folds")
    args = options.parse_args()
    spark = SparkSession.builder.appName("pavelore-train").getOrCreate()
    _, version, lam = train_from_files(spark, args.accidents, args.roads, args.out, args.rows, folds=args.folds)
    print(f"exponent {lam}, model version {version}")


if __name__ == "__main__":
    main()
