"""Document evidence by naive Bayes models over words or style marks, in DataFrame expressions only.

A label has one family of marks as its evidence. Style tells quality: shares of
symbols, of capitals and of distinct words; a text's many words, which depend
on one another, would drown it (held out, sf0.1: 86 % with words, 99 % without).
Words tell toxicity, without the marks that stand around them.

The models are fitted on a bounded sample of labelled documents by one grouped
count and keep every mark whose presence differs between the classes by more
than chance; the weights then stand as one hashed table, a literal, in the
expression that scores whole texts, which costs a mark the same whatever the
number of weights.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: The marks that are evidence of a label: "style" or "words".
FAMILIES = {"quality": "style", "toxic": "words"}
#: What stands between two words: white space, and marks that are set at their ends.
_BETWEEN = r"""[\x20\x09-\x0D!#$%&*|.,;:?"()]+"""


@dataclass(frozen=True)
class NaiveBayes:
    """Log odds of a binary label: base, plus weights of the marks of its family that are present."""

    base: float
    weights: dict[str, float]
    family: str = "words"


def words_and_style(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words (long, runs between white space), words (the distinct ones of the whole text, bare) and style (its marks)."""
    t = F.coalesce(F.col(text), F.lit(""))
    own = df.withColumn("n_words", F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")).withColumn("__split", F.array_remove(F.split(F.lower(t), _BETWEEN), ""))
    own = own.withColumn("__bare", F.size("__split")).withColumn("words", F.array_distinct("__split"))

    def level(name: str, share: Column) -> Column:
        return F.concat(F.lit(f"\x00{name}:"), F.floor(F.least(F.lit(1.0), F.coalesce(share, F.lit(0.0))) * 10).cast("string"))

    n = F.greatest(F.col("n_words"), F.lit(1))
    distinct = level("distinct", F.size("words") / F.greatest(F.col("__bare"), F.lit(1)))
    style = F.array(
        level("symbols", F.regexp_count(t, F.lit(r"[%&$#*!|]+")) / n),
        level("capitals", F.regexp_count(t, F.lit("[A-Z]{2,}")) / n),
        distinct,
        F.concat(distinct, F.lit("/"), F.least(F.lit(9), F.floor(F.log2(n.cast("double")))).cast("string")),
    )
    return own.withColumn("style", style).drop("__split", "__bare")


def labelled_sample(documents: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """doc_id, text, quality, toxic of about max_labelled labelled documents, chosen by the hash of their ids.

    Rows without an id or with neither label are no use; of repeated labels of a
    document the greatest counts.
    """
    known = labels.filter("doc_id is not null and (quality is not null or toxic is not null)").select("doc_id", "quality", "toxic")
    n = known.count()
    cut = int(min(1.0, max_labelled / max(1, n)) * 2**31)
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(2**31)) < cut
    some = known.filter(chosen).groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return documents.filter(chosen).select("doc_id", "text").join(some, "doc_id")


def fit(sample: DataFrame, targets: tuple[str, ...], least_docs: int = 5, least_z: float = 5.0, families: dict[str, str] = FAMILIES) -> dict[str, NaiveBayes]:
    """A model for each binary label column of sample (with text), by the marks of its family.

    All marks of at least least_docs documents and a two-proportion z score of
    least_z or more count. A target with one class only, or none, gets its
    smoothed prior.
    """
    totals = sample.agg(*(F.count_if(F.col(t) == v).alias(f"{t}{v}") for t in targets for v in (0, 1))).first().asDict()
    of = {t: (totals[f"{t}0"] or 0, totals[f"{t}1"] or 0) for t in targets}
    marked = words_and_style(sample).select(F.explode(F.concat("words", "style")).alias("mark"), *targets)
    counts = marked.groupBy("mark").agg(*(F.count_if(F.col(t) == v).alias(f"{t}{v}") for t in targets for v in (0, 1)))

    def telling(t: str) -> Column:
        (n0, n1), a, b = of[t], F.col(f"{t}0"), F.col(f"{t}1")
        if not (n0 and n1):
            return F.lit(False)
        share = (a + b) / (n0 + n1)
        z = (b / n1 - a / n0) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1) + 1e-9)
        return (F.startswith(F.col("mark"), F.lit("\x00")) == F.lit(families[t] == "style")) & (a + b >= least_docs) & (F.abs(z) >= least_z)

    base, weights = {t: math.log((n1 + 1) / (n0 + 1)) for t, (n0, n1) in of.items()}, {t: {} for t in targets}
    kept = counts.select("*", *(telling(t).alias(f"{t}_tells") for t in targets)).filter(" or ".join(f"{t}_tells" for t in targets))
    for r in sorted(kept.collect(), key=lambda r: r["mark"]):
        for t in targets:
            if r[f"{t}_tells"]:
                n0, n1 = of[t]
                p0, p1 = (r[f"{t}0"] + 0.5) / (n0 + 1), (r[f"{t}1"] + 0.5) / (n1 + 1)
                absent = math.log((1 - p1) / (1 - p0))
                base[t] += absent
                weights[t][r["mark"]] = math.log(p1 / p0) - absent
    return {t: NaiveBayes(base[t], weights[t], families[t]) for t in targets}


def _slot(mark: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(mark), F.lit(n)).cast("int")


def _hashed(weights: dict[str, float]) -> tuple[int, Column]:
    """A number of slots and a foldable array of as many maps, each with the weights whose marks hash to it: Spark searches a map from end to end."""
    n = 2 * len(weights)
    spark = SparkSession.active()
    slots: list[dict[str, float]] = [{} for _ in range(n)]
    # an Arrow table stays on the driver; a list would go through Python workers, which then stay beside the executors' heaps
    marks = pa.table({"mark": pa.array(weights.keys(), pa.string()), "weight": pa.array(weights.values(), pa.float64())})
    for r in spark.createDataFrame(marks).select("mark", "weight", _slot(F.col("mark"), n).alias("slot")).collect():
        slots[r["slot"]][r["mark"]] = r["weight"]
    return n, F.from_json(F.lit(json.dumps(slots)), "array<map<string,double>>")


def log_odds(model: NaiveBayes, most: float = 12.0) -> Column:
    """The model's log odds of a document with words and style, within -most and most."""
    if not model.weights:
        return F.lit(max(-most, min(most, model.base)))
    n, table = _hashed(model.weights)
    total = F.aggregate(F.col(model.family), F.lit(model.base), lambda s, m: s + F.coalesce(F.element_at(F.get(table, _slot(m, n)), m), F.lit(0.0)))
    return F.greatest(F.lit(-most), F.least(F.lit(most), total))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))
