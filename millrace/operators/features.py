"""Labels, splits, preprocessing and boosted-tree models on pyspark.ml."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import md5_bucket
from millrace.operators.changes import upsert
from millrace.operators.quality import require_unique


def status_label(df: DataFrame, status: str, bad: str, keep: Sequence[str], name: str = "is_bad") -> DataFrame:
    """Rows with one of the kept states, and 1 for the bad one."""
    return df.filter(F.col(status).isin(list(keep))).withColumn(name, (F.col(status) == bad).cast("int"))


def hash_split(df: DataFrame, key: str, parts: Mapping[str, int] | None = None, name: str = "split") -> DataFrame:
    """Fixed split by the md5 of the key into parts given in percent (80/10/10 by default)."""
    parts = parts or {"train": 80, "validate": 10, "test": 10}
    if sum(parts.values()) != 100:
        raise ValueError("the parts must add up to 100")
    bucket, edge, out = md5_bucket(F.col(key), 100), 0, None
    for part, share in parts.items():
        edge += share
        out = F.when(bucket < edge, part) if out is None else out.when(bucket < edge, part)
    return df.withColumn(name, out)


def merge_features(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A feature table with new rows merged in by its primary key of one or more columns: rows of a known key replace it, others are added.

    Keys must be set and unique among the new rows; else nothing is merged.
    """
    missing = rows.filter(reduce(or_, [F.col(k).isNull() for k in keys]))
    if not missing.isEmpty():
        raise ValueError(f"keys without a value over {', '.join(keys)}")
    require_unique(rows, keys)
    return upsert(target, rows, keys)


def feature_lookup(labels: DataFrame, features: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Label rows with the chosen features of their key; missing keys give nulls."""
    return labels.join(features.select(*keys, *columns), list(keys), "left")


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def preprocessing(numeric: Sequence[str], categorical: Sequence[str] = ()) -> list:
    """Mean imputation and scaling of numbers, one-hot encoding of categories; unseen categories are kept apart."""
    filled = [f"{c}_filled" for c in numeric]
    stages = [
        Imputer(strategy="mean", inputCols=list(numeric), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="numbers", handleInvalid="keep"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
    ]
    parts = ["scaled"]
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        encoded = [f"{c}_onehot" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        ]
        parts += encoded
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def scaled_values(df: DataFrame, numeric: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Imputed, standardised numbers as plain columns, from one aggregate over the table."""
    cells = [c for n in numeric for c in (F.avg(n).alias(f"{n}_m"), F.stddev_samp(n).alias(f"{n}_s"))]
    stats = df.agg(*cells)
    out = []
    for n in numeric:
        mean, spread = stats.select(f"{n}_m").scalar(), stats.select(f"{n}_s").scalar()
        scaled = F.try_divide(F.coalesce(F.col(n), mean) - mean, spread)
        # A constant column has no spread: all its values are the mean.
        out.append(F.when(mean.isNotNull(), F.coalesce(scaled, F.lit(0.0))).alias(n))
    return df.select(*keep, *out)


def fit_classifier(train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (), **options):
    stages = preprocessing(numeric, categorical)
    model = GBTClassifier(labelCol=label, featuresCol="features", seed=42, **options)
    return Pipeline(stages=[*stages, model]).fit(train)


def fit_regressor(train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (), **options):
    stages = preprocessing(numeric, categorical)
    model = GBTRegressor(labelCol=label, featuresCol="features", seed=42, **options)
    return Pipeline(stages=[*stages, model]).fit(train)


def score(model, df: DataFrame, keep: Sequence[str], probability: bool = False) -> DataFrame:
    """The model's prediction beside the kept columns."""
    out = model.transform(df)
    extra = [vector_to_array("probability")[1].alias("probability")] if probability else []
    return out.select(*keep, "prediction", *extra)


def confusion(scored: DataFrame, label: str) -> DataFrame:
    """Rows per pair of label and prediction, both as whole numbers; as many rows as pairs of classes."""
    return scored.groupBy(F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def weighted_f1(pairs: DataFrame) -> DataFrame:
    """One row: f1 over the classes, weighted by their rows, from the counts of ``confusion``."""
    right = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    actual = pairs.groupBy(F.col("label").alias("c")).agg(F.sum("n").alias("actual"), right.alias("right"))
    said = pairs.groupBy(F.col("predicted").alias("c")).agg(F.sum("n").alias("said"))
    both = actual.join(said, "c", "left")
    per_class = 2 * F.col("right") / (F.col("actual") + F.coalesce("said", F.lit(0)))
    return both.agg((F.sum(per_class * F.col("actual")) / F.sum("actual")).alias("f1"))


def f1(scored: DataFrame, label: str) -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1").evaluate(scored)


def mean_squared_error(scored: DataFrame, label: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mse").evaluate(scored)
