"""A training corpus from raw documents, in five stages over the columns of documents.

Each stage works on all that the one before it kept, and is written as Parquet
to the shared folder and read again as the next one's input. A stage drops the
scratch tables of the one before it when it starts, unless its input still reads
them, so that they never add up; run() drops a stage's input as soon as its
result is written. Those of the last stage go with the application.

Every stage takes null values in any column, empty texts, repeated rows, empty
tables and columns of any further names, and says what becomes of them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftscan.llm import langid, mixing, neardup, packing, secrets
from driftscan.session import drop_path, load, materialize, scratch_tables, ship

#: A document's best language must have this share of its positions; less is undetermined.
LEAST_SCORE = 0.3
#: Expected tokens of each domain that stay, as shares of what there is.
FACTORS = {"good": 1.0, "good_toxic": 0.0, "low": 0.5, "low_toxic": 0.0}

ORACLE_SQL = None


_left: dict[str, list[str]] = {}


def _stage(f: Callable) -> Callable:
    """f, which begins by dropping what the stage before it, whose result has been written by then, left in the shared folder."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        read = docs.inputFiles() if _left.get(app) else []
        kept = []
        for path in _left.get(app, []):
            name = path.rpartition("/")[2]
            if any(f"/{name}/" in p for p in read):
                kept.append(path)
            else:
                drop_path(spark, path)
        with scratch_tables() as made:
            out = f(spark, docs, sf_dir)
        _left[app] = [*kept, *made]
        return out

    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter (null and empty texts too), or no language with LEAST_SCORE."""
    ship(spark)
    found = langid.identify(docs, langid.train(docs))
    return found.filter((F.col("lang_pred") != langid.UND) & (F.col("score") >= LEAST_SCORE)).select("row.*")


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8, that of the least doc_id stays. Rows without an id stay.

    Rows with one doc_id are one document; where it stays, so do all its rows
    that differ, and one of those that are equal in every column.
    """
    ship(spark)
    found = neardup.near_duplicates(docs, percent=80).filter("doc_id is not null")
    gone = materialize(found.filter("not kept").select("doc_id").distinct(), "gone")
    few = gone.count() <= neardup.MOST_BROADCAST
    named = docs.filter("doc_id is not null").join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = found.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not repeated.isEmpty():
        repeated = materialize(repeated, "repeated")
        named = named.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(named.join(repeated, "doc_id", "left_semi").select(*docs.columns).distinct())
    return named.unionByName(docs.filter("doc_id is null"))


@_stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; what was found in their texts is masked, and n_chars follows."""
    found = secrets.find_secrets(docs)
    text = secrets.redact(F.col("row.text"), F.col("spans"))
    out = found.select(*(F.when(F.size("spans") > 0, text).otherwise(F.col("row.text")).alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates from 0 to 1, fitted to FACTORS, decide which documents stay.

    A document of rate 1 always stays, one of rate 0 never, and one between by a
    hash of its row, so that equal rows go alike and a repeated run keeps the
    same. Null and empty texts are rated by the marks of an empty text.
    """
    rated, _ = mixing.mix(docs, load(spark, sf_dir, "labels"), factors=FACTORS, most=1.0)
    return mixing.apply_rates(rated)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids. Null and empty texts have their end id alone; repeated rows and null ids are documents of their own."""
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixing", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        with scratch_tables() as made:
            docs = materialize(out, name)
        if read:
            drop_path(spark, read)
        read = made[-1]
    return STAGES[-1][1](spark, docs, sf_dir)
