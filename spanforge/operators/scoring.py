"""Scaling, imputation and thresholds around a pluggable classifier score."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

#: What infinities become when missing values are imputed.
LARGEST = 1.7976931348623157e308


def fit_scaler(rows: DataFrame, features: list[str]) -> DataFrame:
    """feature, centre, scale: mean and population deviation over values that are there; a constant feature has scale 1."""
    stats = rows.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(features) for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    long = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{i}").alias("centre"), F.when(F.col(f"s_{i}") > 0, F.col(f"s_{i}")).otherwise(F.lit(1.0)).alias("scale")) for i, c in enumerate(features)])
    return stats.select(F.explode(long).alias("p")).select("p.*")


def scaled(params: DataFrame, features: list[str]) -> dict[str, Column]:
    """(x - centre) / scale of each feature.  There is one parameter row per feature, so they become literals of the plan."""
    known = {r["feature"]: (r["centre"], r["scale"]) for r in params.where(F.col("feature").isin(*features)).collect()}
    number = lambda v: F.lit(v).cast("double")
    return {c: (F.col(c) - number(known[c][0])) / number(known[c][1]) for c in features}


def scale(rows: DataFrame, params: DataFrame, features: list[str]) -> DataFrame:
    done = scaled(params, features)
    return rows.select(*[done[c].alias(c) if c in done else F.col(f"`{c}`") for c in rows.columns])


def imputed(x: Column) -> Column:
    """Missing to 0, infinities to the largest finite values."""
    x = F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(0.0))
    return F.when(x == float("inf"), F.lit(LARGEST)).when(x == float("-inf"), F.lit(-LARGEST)).otherwise(x)


def impute(rows: DataFrame, features: list[str]) -> DataFrame:
    return reduce(lambda d, c: d.withColumn(c, imputed(F.col(c))), features, rows)


def predicted(confidence: Column, threshold: float = C.DEFAULT_THRESHOLD) -> Column:
    return (confidence >= threshold).cast("int")


def assemble(rows: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(rows)


def train_forest(rows: DataFrame, features: list[str], trees: int = 100, seed: int = 42) -> RandomForestClassificationModel:
    """A random forest over scaled and imputed columns with an integer label."""
    data = assemble(rows.withColumn("label", F.col("label").cast("double")), features)
    return RandomForestClassifier(numTrees=trees, seed=seed, featuresCol="features", labelCol="label").fit(data)


class Threshold:
    """A model with the probability `low` where the only feature is below `cut`, and `high` from there on."""

    def __init__(self, cut: float, low: float = 0.0, high: float = 1.0) -> None:
        self.cut, self.low, self.high = cut, low, high

    def transform(self, rows: DataFrame) -> DataFrame:
        p = F.when(vector_to_array("features")[0] >= self.cut, F.lit(self.high)).otherwise(F.lit(self.low))
        return rows.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def with_confidence(rows: DataFrame, model, features: list[str], threshold: float = C.DEFAULT_THRESHOLD) -> DataFrame:
    """Add confidence and predicted by a model's probability, or predicted alone and a null confidence without one."""
    out = model.transform(assemble(rows, features))
    if "probability" in out.columns:
        own = vector_to_array("probability")[1]
        return out.withColumn("confidence", own).select(*rows.columns, "confidence", predicted(F.col("confidence"), threshold).alias("predicted"))
    return out.select(*rows.columns, F.lit(None).cast("double").alias("confidence"), F.col("prediction").cast("int").alias("predicted"))


def score(rows: DataFrame, params: DataFrame, model, features: list[str] = list(C.FEATURE_COLUMNS), threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """Scale, then impute, then decide, all in columns of their own: the given columns come out as they went in, one row for each row."""
    own = {f"_input_{i}": imputed(x) for i, x in enumerate(scaled(params, features).values())}
    return with_confidence(rows.withColumns(own), model, list(own), threshold).drop(*own)
