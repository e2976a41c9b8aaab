"""Object rows to image verdicts: derived features, rule scores, votes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftscan import functions as X


@dataclass(frozen=True)
class BubbleRules:
    """Limits of the hard rule and weights of the score; defaults are fixed values."""

    od: float = 0.02
    solidity: float = 0.95
    eccentricity: float = 0.3
    ratio: float = 0.9
    weight_od: float = 0.4
    weight_solidity: float = 0.2
    weight_eccentricity: float = 0.2
    weight_ratio: float = 0.2
    score: float = 0.7
    gradient: float | None = None
    std: float | None = None


def _unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def rule_score(objects: DataFrame, r: BubbleRules = BubbleRules()) -> DataFrame:  # noqa: B008
    """objects (mean_optical_density, solidity, eccentricity, intensity_ratio) with bubble_score, is_bubble_hard, is_bubble_scored, is_bubble."""
    od, solid, ecc, ratio = (F.col(c) for c in ("mean_optical_density", "solidity", "eccentricity", "intensity_ratio"))
    parts = ((r.weight_od, _unit(1 - od / r.od)), (r.weight_solidity, _unit((solid - r.solidity) / (1 - r.solidity))), (r.weight_eccentricity, _unit(1 - ecc / r.eccentricity)), (r.weight_ratio, _unit((ratio - r.ratio) / (1 - r.ratio))))
    score = sum((w * p for w, p in parts[1:]), parts[0][0] * parts[0][1])
    hard = (od < r.od) & (solid > r.solidity) & (ecc < r.eccentricity) & (ratio > r.ratio)
    if r.gradient is not None:
        hard = hard & (F.col("gradient_rms") < r.gradient)
    if r.std is not None:
        hard = hard & (F.col("intensity_std") < r.std)
    out = objects.withColumn("bubble_score", score).withColumn("is_bubble_hard", hard).withColumn("is_bubble_scored", F.col("bubble_score") > r.score)
    return out.withColumn("is_bubble", F.col("is_bubble_hard") | F.col("is_bubble_scored"))


def image_vote(objects: DataFrame, image: str = "image_id") -> DataFrame:
    """Verdict of each image: an artefact if more than half of its objects are."""
    share = F.avg(F.col("is_bubble").cast("int"))
    return objects.groupBy(image).agg((share > 0.5).alias("is_bubble"), F.avg("bubble_score").alias("bubble_score"), F.count("*").alias("object_count"))


def apply_verdict(images: DataFrame, verdicts: DataFrame, image: str = "image_id") -> DataFrame:
    """Images not judged artefacts; those without a verdict, as after an error, stay with score 0 and count 0."""
    v = verdicts.select(image, "is_bubble", "bubble_score", "object_count")
    out = images.join(v, image, "left").withColumn("bubble_score", F.coalesce("bubble_score", F.lit(0.0))).withColumn("object_count", F.coalesce("object_count", F.lit(0)))
    return out.filter(~F.coalesce("is_bubble", F.lit(False))).drop("is_bubble")


def derive_shapes(objects: DataFrame, shapes: list[tuple] | None = None) -> DataFrame:
    """objects with every derived feature whose inputs they have; shapes are (name, required columns, expression), X.SHAPE_RULES where none are given.

    Of several rules of a name the first that has its inputs counts; a column
    that is there stays.
    """
    have, made = set(objects.columns), {}
    for name, need, f in X.SHAPE_RULES if shapes is None else shapes:
        if have.issuperset(need) and name not in have:
            made.setdefault(name, f(*map(F.col, need)))
    return objects.withColumns(made) if made else objects


def object_means(objects: DataFrame, image: str, features: list[str]) -> DataFrame:
    """Mean of each feature over an image's objects, NaN left out, and object_count."""
    return objects.groupBy(image).agg(*(F.avg(X.nan_to_null(f)).alias(f) for f in features), F.count("*").alias("object_count"))


def combine_first(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with right's columns; where both have one, left's value unless it is null."""
    r = right.select(*keys, *(F.col(c).alias(f"__{c}") for c in right.columns if c not in keys))
    j = left.join(r, keys, "left")
    both = [c for c in right.columns if c not in keys]
    return j.select(*keys, *(F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in both else F.col(c) for c in left.columns if c not in keys), *(F.col(f"__{c}").alias(c) for c in both if c not in left.columns))
