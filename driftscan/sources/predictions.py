"""Prediction tables: reading the detail CSVs, long and wide form, detail and summary rows."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from driftscan import functions as X
from driftscan.session import ship
from driftscan.stores import STREAMED, is_local, open_file

DOUBLES = ("density", "subsample_factor", "lat", "lon", "pred_id", "pred_conf", "total_counts")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: A header line is looked for within so many bytes.
LONGEST_HEADER = 4_000_000
HEADERS = "path string, header array<string>, error string"


def _first_line(file) -> bytes:
    """The first line of an open file, decompressed if it is packed."""
    from driftscan.sources.archives import unpacked

    source, line = unpacked(file) or file, b""
    while b"\n" not in line and len(line) < LONGEST_HEADER and (more := source.read(8192)):
        line += more
    return line.partition(b"\n")[0].removeprefix(b"\xef\xbb\xbf")


def _fields(line: bytes) -> list[str]:
    return next(csv.reader([line.decode("utf-8", "replace").rstrip("\r")]), [])


def csv_headers(spark: SparkSession, *paths: str, pattern: str = "*.csv*") -> DataFrame:
    """path, header (the names in the first line) and error of every CSV at or below paths, found by one job.

    Tasks read the beginnings of files, packed ones too, and nothing else. In
    stores that only Spark reaches the driver does. Files without bytes have no row.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(list(paths)).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, errors = [], []
            for path in b.column(0).to_pylist():
                try:
                    with open_file(path) as f:
                        found.append(_fields(_first_line(f)))
                        errors.append(None)
                except (OSError, ValueError, EOFError, csv.Error) as e:
                    found.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:200])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string())), pa.array(errors, pa.string())], ["path", "header", "error"])

    if all(is_local(p) or "://" not in p or p.partition("://")[0] in STREAMED for p in paths) and not _is_foreign(spark):
        return files.mapInArrow(run, HEADERS)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def opened(path: str) -> bytes:
        p = jvm.org.apache.hadoop.fs.Path(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(conf).open(p), "UTF-8"))
        try:
            return (reader.readLine() or "").encode().removeprefix("\ufeff".encode())
        finally:
            reader.close()

    return spark.createDataFrame([(r["path"], _fields(opened(r["path"])), None) for r in files.collect()], HEADERS)


def _is_foreign(spark: SparkSession) -> bool:
    """Whether paths without a scheme lie in a store that tasks cannot open."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return not (is_local(default) or default.partition("://")[0] in STREAMED)


def vocabulary(headers: DataFrame, fixed: tuple[str, ...] = ()) -> DataFrame:
    """name and n_files of every column of all headers but the fixed ones."""
    names = headers.select("path", F.explode(F.array_distinct("header")).alias("name"))
    return names.filter(~F.col("name").isin(*fixed) if fixed else F.lit(True)).groupBy("name").agg(F.count("*").alias("n_files"))


def _unglobbed(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_united(spark: SparkSession, headers: DataFrame, least_columns: int = 0, file: str | None = None) -> list[tuple[list[str], DataFrame]]:
    """For each distinct header its names and all rows below it as strings; the number of jobs does not grow with that of files.

    Files with fewer columns than least_columns are left out whole, unreadable
    ones too. Of columns of one name the first stays. file names a column for
    the path that a row came from.
    """
    groups = headers.filter((F.size("header") >= max(1, least_columns)) & F.col("error").isNull()).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    parts = []
    for g in sorted(groups, key=lambda g: g["header"]):
        header = g["header"]
        names = [f"{h}__{k}" if header.index(h) != k else h for k, h in enumerate(header)]
        rows = spark.read.option("header", "true").option("enforceSchema", "true").schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv([_unglobbed(p) for p in sorted(g["paths"])])
        kept = [n for k, n in enumerate(names) if header.index(header[k]) == k]
        own = [F.col("_metadata.file_path").alias(file)] if file else []
        parts.append((kept, rows.select(*(F.col(_quoted(n)) for n in kept), *own)))
    return parts


def _number(name: str) -> Column:
    return F.when(F.lower(_quoted(name)).isin("inf", "infinity"), F.lit(float("inf"))).otherwise(F.col(_quoted(name)).try_cast("double"))


def read_detail(spark: SparkSession, paths: list[str], classes: list[str] | None = None) -> DataFrame:
    """Detail CSVs at or below paths united by name. A second pred_conf column is dropped, `inf` is read as infinity, datetime is made from date and time.

    Files with fewer columns than classes are left out whole. One job reads all
    headers; files of one header are one scan.
    """
    parts = []
    for names, rows in read_united(spark, csv_headers(spark, *paths), len(classes or [])):
        rows = rows.select(*(_number(n).alias(n) if n in DOUBLES or n.endswith("_conf") else F.col(_quoted(n)) for n in names))
        parts.append(rows.withColumn("datetime", X.combine_datetime("date", "time")) if {"date", "time"} <= set(names) else rows)
    if not parts:
        raise ValueError("no file is complete")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_truth(spark: SparkSession, *paths: str) -> DataFrame:
    """filename, label and all other columns of the ground truth's CSVs, in which these are Filename and Subdirectory (or Label)."""
    renamed = {"Filename": "filename", "Subdirectory": "label", "Label": "label"}
    parts = [rows.withColumnsRenamed({n: renamed[n] for n in names if n in renamed}) for names, rows in read_united(spark, csv_headers(spark, *paths))]
    if not parts:
        raise ValueError("no ground truth")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


#: Columns of a model's predictions on the test set that are no class.
FIXED = ("Path", "Filename", "Label", "Pred")


def read_models(spark: SparkSession, *paths: str, prefix: str = "", suffix: str = ".csv", fixed: tuple[str, ...] = FIXED) -> tuple[DataFrame, list[str]]:
    """Rows of all models' prediction CSVs with `model`, and the names of all classes that any of them has.

    A model is named by its file without prefix and suffix. Classes are doubles,
    null where a model does not know one.
    """
    headers = csv_headers(spark, *paths)
    classes = sorted(r["name"] for r in vocabulary(headers, fixed).collect())
    parts = [rows.select(X.strip_affixes(X.basename("__file"), prefix, suffix).alias("model"), *(F.col(_quoted(n)) if n in fixed else _number(n).alias(n) for n in names)) for names, rows in read_united(spark, headers, file="__file")]
    if not parts:
        raise ValueError("no predictions")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows, classes


def detail(images: DataFrame, classes: list[str], cruise: str) -> DataFrame:
    """Rows of images (tar_path, id, probs) with label, confidence, instrument, date and time of their bin; Background.tif is left out."""
    own = images.filter(~F.contains(F.col("id"), F.lit("Background.tif"))).withColumn("pred_id", X.argmax("probs"))
    first = F.min_by(X.instrument_code("id"), "id").over(Window.partitionBy("tar_path"))
    token = X.timestamp_token("tar_path")
    at = own.withColumn("pred_label", F.get(F.array(*map(F.lit, classes)), F.col("pred_id"))).withColumn("pred_conf", X.confidence("probs", "pred_id")).withColumn("instrument_code", first)
    at = at.withColumn("date", X.origin("tar_path")["date"]).withColumn("time", F.concat(F.substring(token, 1, 2), F.lit(":"), F.substring(token, 3, 2))).withColumn("cruise_name", F.lit(cruise))
    return at.withColumn("datetime", X.combine_datetime("date", "time"))


def widen(rows: DataFrame, classes: list[str], probs: str = "probs") -> DataFrame:
    """One column for each class, in the order of names."""
    return rows.withColumns({f"{c}_conf": F.get(F.col(probs), F.lit(classes.index(c))) for c in sorted(classes)}).drop(probs)


def write_detail(rows: DataFrame, path: str, digits: int | None = None, mode: str = "overwrite") -> None:
    """CSV by date and time; summaries with numbers rounded to digits."""
    if digits is not None:
        rows = rows.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes))
    rows.withColumns({"_date": F.col("date"), "_time": F.replace("time", F.lit(":"), F.lit(""))}).write.partitionBy("_date", "_time").option("header", "true").mode(mode).csv(path)
