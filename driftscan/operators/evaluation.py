"""Model quality: confusion matrices, scores, ensembles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftscan import functions as X


def join_truth(predictions: DataFrame, truth: DataFrame, key: str = "filename") -> DataFrame:
    """Inner join; a name that occurs twice on one side gives a row for each."""
    return predictions.join(truth, key)


def confusion(rows: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """label, pred, count in long form over the true labels only: predictions outside them are dropped, empty cells are 0."""
    labels = rows.select(F.col(label).alias("label")).filter("label is not null").distinct()
    cells = rows.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count("*").alias("count"))
    axis = labels.agg(F.sort_array(F.collect_set("label")).alias("axis"))
    grid = labels.join(F.broadcast(axis)).select("label", F.explode("axis").alias("pred"))
    return grid.join(cells, ["label", "pred"], "left").na.fill(0, ["count"])


def confusion_wide(rows: DataFrame, labels: list, label: str = "label", pred: str = "pred") -> DataFrame:
    return rows.filter(F.col(label).isin(labels)).groupBy(label).pivot(pred, labels).count().na.fill(0)


def class_scores(rows: DataFrame, label: str = "label", pred: str = "pred", true_labels_only: bool = True) -> DataFrame:
    """precision, recall, f1 and support of each class; 0 where undefined."""
    long = rows.select(F.explode(F.array(F.struct(F.col(label).alias("class"), F.lit(1).alias("t"), F.lit(0).alias("p"), (F.col(label) == F.col(pred)).cast("int").alias("hit")), F.struct(F.col(pred).alias("class"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("hit")))).alias("e")).select("e.*")
    c = long.filter(F.col("class").isNotNull()).groupBy("class").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum(F.coalesce("hit", F.lit(0))).alias("hits"))
    share = lambda a, b: F.when(b > 0, a / F.nullif(b, F.lit(0))).otherwise(0.0)
    c = c.withColumn("precision", share(F.col("hits"), F.col("predicted"))).withColumn("recall", share(F.col("hits"), F.col("support")))
    both = F.col("precision") + F.col("recall")
    c = c.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / F.nullif(both, F.lit(0.0))).otherwise(0.0)).drop("predicted", "hits")
    return c.filter("support > 0") if true_labels_only else c


def macro_scores(rows: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Unweighted means over every class seen in truth or prediction."""
    return class_scores(rows, label, pred, true_labels_only=False).agg(*(F.avg(x).alias(f"macro_{x}") for x in ("precision", "recall", "f1")))


def accuracy(rows: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    hit = F.col(label) == F.col(pred)
    return rows.agg(F.count_if(hit).alias("correct"), F.count("*").alias("n"), F.avg(F.coalesce(hit, F.lit(False)).cast("int")).alias("accuracy"))


def side_by_side(scores: dict[str, DataFrame], value: str = "f1") -> DataFrame:
    """One column a model, over every class that any model has."""
    return reduce(lambda a, b: a.join(b, "class", "full_outer"), (df.select("class", F.col(value).alias(f"{value}_{name}")) for name, df in scores.items()))


def ensemble(models: list[DataFrame], keys: list[str], classes: list[str]) -> DataFrame:
    """Mean of each class over the models that have it (absent columns are null), with the best class and its mean."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), models)
    mean = rows.groupBy(*keys).agg(*(F.avg(X.nan_to_null(c)).alias(c) for c in classes))
    probs = F.array(*(F.coalesce(F.col(c), F.lit(float("-inf"))) for c in classes))
    best = X.argmax(probs)
    return mean.withColumn("ens_pred", F.get(F.array(*map(F.lit, classes)), best)).withColumn("ens_conf", F.array_max(probs))


def most_confused(rows: DataFrame, least: int = 2, label: str = "label", pred: str = "pred") -> DataFrame:
    return rows.filter(F.col(label) != F.col(pred)).groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count("*").alias("count")).filter(F.col("count") >= least)


def top_losses(rows: DataFrame, probs: str, label_id: str, k: int = 20, tie: str = "id") -> DataFrame:
    loss: Column = -F.log(F.greatest(F.get(F.col(probs), F.col(label_id).cast("int")), F.lit(1e-12)))
    return rows.withColumn("loss", loss).orderBy(F.desc("loss"), tie).limit(k)
