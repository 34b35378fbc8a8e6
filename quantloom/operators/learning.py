"""Factor models: datasets of many features, boosted trees, importance, prediction; Spark's own learners.

A dataset is wide (a column a feature), made from a long factor table by one pivot with named columns.
Missing features become 0 after scaling, the training median, as trees of Spark take no missing values.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clean, div
from ..shipping import stored
from .evaluation import exact_quantile, ic_series, robust_scale, split_segments


def build_dataset(long: DataFrame, mask: DataFrame, label: DataFrame, features: list[str], train_end: str, valid_end: str, embargo_months: int = 1) -> DataFrame:
    """entity, date, segment, label and scaled features, for usable cells (pre) with a finite label."""
    wide = long.where(F.col("factor").isin(features)).groupBy("entity", "date").pivot("factor", features).agg(F.max(clean("value")))
    on = mask.where("pre").select("entity", "date").join(label.where(clean("label").isNotNull()).select("entity", "date", "label"), ["entity", "date"]).join(wide, ["entity", "date"], "left")
    # Scaling reads the joined cells several times.
    on = stored(on, "cells")
    return robust_scale(split_segments(on, train_end, valid_end, embargo_months), features, F.col("segment") == "train").select("entity", "date", "segment", "label", *features)


def vectors(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_features").transform(df.fillna(0.0, features))


def train_boosted(dataset: DataFrame, features: list[str], rounds: int = 100, depth: int = 5, rate: float = 0.05, seed: int = 7) -> GBTRegressionModel:
    """Stops early where the validation segment no longer gains."""
    rows = vectors(dataset.where("segment in ('train', 'valid')"), features).withColumn("_valid", F.col("segment") == "valid")
    return GBTRegressor(featuresCol="_features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, validationIndicatorCol="_valid").fit(rows)


def top_features(model: GBTRegressionModel, features: list[str], k: int = 64) -> list[tuple[str, float]]:
    """The k features of the highest gain importance; ties by name."""
    return sorted(zip(features, map(float, model.featureImportances.toArray()), strict=True), key=lambda x: (-x[1], x[0]))[:k]


def predict(model: GBTRegressionModel, dataset: DataFrame, features: list[str]) -> DataFrame:
    return model.transform(vectors(dataset, features)).select(*dataset.columns, F.col("prediction").alias("score"))


def model_ic(scored: DataFrame, least: int = 30) -> DataFrame:
    """Days, mean coefficient and ratio (sample deviation), over ranks of cells with both a score and a label."""
    s = ic_series(scored, "score", "label", ["date"], True, least).where("ic is not null")
    return s.agg(F.count("ic").alias("n_days"), F.avg("ic").alias("ic_mean"), div(F.avg("ic"), F.stddev_samp("ic")).alias("icir"))


def common_last_day(long: DataFrame, features: list[str]) -> DataFrame:
    """One row: the last date that all features cover."""
    ends = long.where(F.col("factor").isin(features) & F.col("value").isNotNull()).groupBy("factor").agg(F.max("date").alias("d"))
    return ends.agg(F.when(F.count(F.lit(1)) == len(features), F.min("d")).alias("last_day"))


def scaler_table(train: DataFrame, features: list[str]) -> DataFrame:
    """feature, median, scale of the training rows: what is kept beside a model."""
    med = exact_quantile(train, features).withColumnRenamed("value", "median")
    # One row a feature, twice.
    by = {r.feature: r.median for r in med.collect()}
    away = train.select(*(F.abs(F.col(f) - F.lit(by[f])).alias(f) for f in features if f in by))
    scale = exact_quantile(away, [f for f in features if f in by]) if by else med.withColumnRenamed("median", "value")
    return med.join(scale, "feature").select("feature", "median", (F.col("value") * 1.4826).alias("scale"))


def scaled(df: DataFrame, scaler: DataFrame, features: list[str]) -> DataFrame:
    """Features of any rows on a stored scale; one row a feature comes to the driver."""
    by = {r.feature: r for r in scaler.collect()}
    return df.withColumns({f: div(F.col(f) - by[f]["median"], F.lit(by[f].scale)) if f in by else F.lit(None).cast("double") for f in features})


def predict_live(model: GBTRegressionModel, scaler: DataFrame, long: DataFrame, mask: DataFrame, features: list[str], start: str) -> DataFrame:
    """Scores of all usable cells from `start` to the last day that every feature covers; no label is needed."""
    wide = long.where(F.col("factor").isin(features)).groupBy("entity", "date").pivot("factor", features).agg(F.max(clean("value")))
    cells = mask.where(F.col("pre") & (F.col("date") >= F.lit(start).cast("date"))).select("entity", "date").crossJoin(F.broadcast(common_last_day(long, features))).where("date <= last_day").drop("last_day")
    return predict(model, scaled(cells.join(wide, ["entity", "date"], "left"), scaler, features), features).select("entity", "date", "score")


def save(model: GBTRegressionModel, scaler: DataFrame, features: list[str], path: str) -> None:
    """The model, its scaler and the order of its features, side by side."""
    model.write().overwrite().save(f"{path.rstrip('/')}/model")
    place = F.create_map(*(x for i, f in enumerate(features) for x in (F.lit(f), F.lit(i))))
    scaler.withColumn("place", place[F.col("feature")]).write.mode("overwrite").parquet(f"{path.rstrip('/')}/scaler")


def load(spark, path: str) -> tuple[GBTRegressionModel, DataFrame, list[str]]:
    scaler = spark.read.parquet(f"{path.rstrip('/')}/scaler")
    names = [r.feature for r in scaler.orderBy("place").select("feature").collect()]
    return GBTRegressionModel.load(f"{path.rstrip('/')}/model"), scaler, names
