"""Threshold-scaled sketches of documents.

A sketch is the set of all shingle hashes below a fixed fraction of their range.
Sketches of two texts can be merged by union, and the share of the smaller
sketch found in the other estimates containment however unequal the texts are.
A text none of whose hashes is below the threshold keeps its least one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftscan.session import materialize

WORDS, SCALE, BITS = 5, 8, 40


def words(text: Column) -> Column:
    """Words between ASCII white space, in lower case."""
    bare = F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def sketch_of_words(ws: Column, scale: int = SCALE) -> Column:
    """The sorted sketch of an array of words: hashes of BITS bits; fewer than five words are one shingle, none has none."""
    n = F.size(ws)

    def shingle(i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*(F.get(ws, i + k) for k in range(WORDS))), 64 - BITS)

    hashes = F.transform(F.sequence(F.lit(0), F.greatest(n - WORDS, F.lit(0))), shingle)
    low = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < (1 << BITS) // scale)))
    none = F.array().cast("array<bigint>")
    return F.when(n == 0, none).when(F.size(low) > 0, low).otherwise(F.array(F.array_min(hashes)))


def add_sketch(df: DataFrame, text: str, out: str, scale: int = SCALE) -> DataFrame:
    """df with the sketch of column text as column out; a null text is empty."""
    return df.withColumn("__w", words(F.coalesce(F.col(text), F.lit("")))).withColumn(out, sketch_of_words(F.col("__w"), scale)).drop("__w")


def merge(a: Column, b: Column) -> Column:
    """The sketch of both texts together (but for shingles across their join)."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch in the other; of two empty ones 1, of an empty and another 0."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise((F.size(a) == F.size(b)).cast("double"))


def spell(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ".")


def following(ids: DataFrame, partitions: int) -> DataFrame:
    """id and next_id of distinct non-null ids, descending; the last is followed by the first.

    Ids are dealt out by range and looked at within a range; only each range's
    first id goes to a single task, to be handed to the range before it.
    """
    dealt = materialize(ids.select("id").repartitionByRange(partitions, F.desc("id")).withColumn("part", F.spark_partition_id()), "ids")
    inner = dealt.withColumn("next_id", F.lead("id").over(Window.partitionBy("part").orderBy(F.desc("id"))))
    over = Window.orderBy("part")
    first = dealt.groupBy("part").agg(F.max("id").alias("id"))
    first = first.select("part", F.coalesce(F.lead("id").over(over), F.first("id").over(over)).alias("after"))
    return inner.join(first, "part").select("id", F.coalesce("next_id", "after").alias("next_id"))


def edited_pairs(documents: DataFrame, partitions: int | None = None, scale: int = SCALE) -> DataFrame:
    """Every document with its own sketch, the next document's, and the sketch of its edited text.

    doc_id, n_chars, sketch, edited_text, edited_sketch, next_sketch. The edited
    text has its last floor(n/2) code points replaced by the first as many, or
    all, of the next document in descending order of doc_id (a null id counts as
    the least). Null texts are empty. Rows with one id share the next id; where
    that id has several rows, the least stands for it. A text is shuffled once,
    and of the part that the document before it takes, once more.
    """
    spark = documents.sparkSession
    own = documents.select(F.coalesce("doc_id", F.lit(-(1 << 63))).cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = materialize(own.groupBy("id").agg(F.max(F.length("text")).alias("n_chars"), F.count("*").alias("rows")), "sizes")
    order = following(sizes, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = materialize(order.join(sizes, "id").select(F.col("next_id").alias("id"), F.col("id").alias("prev_id"), F.floor(F.col("n_chars") / 2).cast("int").alias("taken")), "before")

    placed = own.join(before, "id")  # both branches below take id and text of it alone, and so share its shuffle
    left = placed.select("id", "text", F.length("text").alias("n_chars"))
    left = add_sketch(left, "text", "sketch", scale).withColumn("text", F.substring("text", F.lit(1), F.col("n_chars") - F.floor(F.col("n_chars") / 2).cast("int")))
    right = add_sketch(placed, "text", "next_sketch", scale).select(F.col("prev_id").alias("id"), F.substring("text", F.lit(1), F.col("taken")).alias("tail"), "next_sketch")
    if not sizes.filter("rows > 1").isEmpty():
        right = right.groupBy("id").agg(F.min(F.struct("tail", "next_sketch")).alias("m")).select("id", "m.*")
    both = left.join(right, "id")
    edited = F.concat("text", F.substring("tail", F.lit(1), F.floor(F.col("n_chars") / 2).cast("int")))
    both = both.select(F.nullif("id", F.lit(-(1 << 63))).alias("doc_id"), F.col("n_chars").cast("bigint").alias("n_chars"), "sketch", edited.alias("edited_text"), "next_sketch")
    return add_sketch(both, "edited_text", "edited_sketch", scale)
