"""Merging, excluding and de-duplicating sets of files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftscan import functions as X


def map_by_key(files: DataFrame, key: DataFrame) -> DataFrame:
    """files (source, folder, …) with detailed_cat from the key table; files without an entry drop out."""
    return files.join(key.select("source", "folder", "detailed_cat"), ["source", "folder"])


def first_wins(files: DataFrame, dest: list[str], *order: str) -> DataFrame:
    """Of rows with one destination the first in order."""
    return files.withColumn("__n", F.row_number().over(Window.partitionBy(*dest).orderBy(*order))).filter("__n = 1").drop("__n")


def exclude(rows: DataFrame, known: DataFrame, key: str | list[str]) -> DataFrame:
    """rows whose key is not in known: existing files, test images, quarantined files, finished outputs."""
    return rows.join(known, key, "left_anti")


def duplicate_groups(files: DataFrame, content: str, name: str, least: int = 2) -> DataFrame:
    """sha256, n and the sorted names of files with equal contents. Names of one group meet in one row, as the result must."""
    hashed = files.select(F.sha2(F.col(content).cast("binary"), 256).alias("sha256"), F.col(name).alias("name"))
    many = hashed.groupBy("sha256").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return hashed.join(many, "sha256").groupBy("sha256").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("name")).alias("names"))


def diagonal(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def side_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of two tables of one order put side by side, by a row key."""
    return left.join(right, key, "full_outer")


def files_per_folder(files: DataFrame, path: str = "path") -> DataFrame:
    """folder and n_files; files without a folder are counted under a null one."""
    p = F.replace(F.col(path), F.lit("\\"), F.lit("/"))
    return files.groupBy(F.try_element_at(F.split(p, "/"), F.lit(-2)).alias("folder")).agg(F.count("*").alias("n_files"))


def members_of(samples: DataFrame, members: DataFrame) -> DataFrame:
    """Sampled (tar_path, id) rows with the member of that archive and base name, whichever separator the archive used."""
    a = samples.withColumn("basename", X.basename("id"))
    return a.join(members.withColumn("basename", X.basename("name")), ["tar_path", "basename"])


def before_after(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    counts = before.groupBy(key).agg(F.count("*").alias("before")).join(after.groupBy(key).agg(F.count("*").alias("after")), key, "full_outer").na.fill(0, ["before", "after"])
    return counts.withColumn("rejected", F.col("before") - F.col("after"))


def best_of(rows: DataFrame, key: str, name: str, loss: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min_by(name, F.struct(loss, name)).alias("best"), F.min(loss).alias("best_loss"))


def quarantine(files: DataFrame, name: str, when: str, *order: str) -> DataFrame:
    """Names under which corrupt files are kept: the plain one first, then with time and a sequence number; `order` decides at one time."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(when, *order)) - 1
    return files.withColumn("kept_as", F.when(n == 0, F.col(name)).otherwise(F.concat_ws("_", F.date_format(when, "yyyyMMddHHmmss"), n.cast("string"), F.col(name))))


def corrupt_list(images: DataFrame, error: str = "error") -> DataFrame:
    """tar_path, filename and error of every damaged image, to be kept as a list and excluded on the next run."""
    return images.filter(F.col(error).isNotNull()).select("tar_path", "filename", F.col(error).alias("error"))


def record_table(images: DataFrame, *order: str) -> DataFrame:
    """bucket, index within it, filename, tar_path, shape (height, width and, for colour, channels) and dtype of grouped images."""
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(*(order or ("tar_path", "member_idx")))) - 1
    colour = F.when(F.col("channels") > 1, F.array("channels")).otherwise(F.array().cast("array<int>"))
    return images.select("bucket", place.alias("index"), "filename", "tar_path", F.concat(F.array("height", "width"), colour).alias("shape"), "dtype")


def first_names(members: DataFrame, most: int = 10) -> DataFrame:
    """tar_path and the names of the first `most` members of each archive, in its order; no more of them meet in a task."""
    rank = F.row_number().over(Window.partitionBy("tar_path").orderBy("member_idx"))
    first = members.filter("member_idx >= 0").select("tar_path", "member_idx", "name").withColumn("rank", rank).filter(F.col("rank") <= most)
    return first.groupBy("tar_path").agg(F.transform(F.array_sort(F.collect_list(F.struct("member_idx", "name"))), lambda m: m["name"]).alias("names"))
