"""Kept images written back as survey archives: one tar for each date and ten-minute bin, with mapping, manifest and checks.

Rows are dealt by (date, bin) and sorted within tasks, so that a task writes its
archives one after another, each as a stream, and holds no group. An archive is
one file by nature: a bin's members go through one task, whose memory does not
grow with them. Everything is staged and takes its name at the commit.
"""

from __future__ import annotations

import csv
import io
import json
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from driftscan import functions as X
from driftscan.session import ship
from driftscan.sources import archives
from driftscan.stores import Publication, file_system, files_below

#: Columns of the mapping from each exported member to where it came from and lies now.
MAPPING = "date string, timestamp string, tar_filename string, member string, tar_path string, filename string, member_idx int, size bigint, offset bigint, data_offset bigint, next_offset bigint"
#: Members that stand at the top of an archive; all others stand in RawImages.
TOP = ("Background.tif", "Bubbles.txt", "Cameralog.txt", "HitsMisses.txt")


def exportable(max_bubble_score: float = 1.0, min_object_count: int = 0) -> Column:
    """Whether a record's bubble_score and object_count let it be exported; missing ones are 0."""
    return (F.coalesce("bubble_score", F.lit(0.0)) <= max_bubble_score) & (F.coalesce("object_count", F.lit(0)) >= min_object_count)


def place(records: DataFrame, cruise: str, bin_minutes: int = 10) -> DataFrame:
    """records with date, timestamp (the bin's), tar_filename and is_valid_bin, told by tar_path; an archive without a time is put at 0000."""
    at = records.withColumn("__o", X.origin("tar_path"))
    token = F.when(F.col("__o.timestamp") == "", "0000").otherwise(F.col("__o.timestamp"))
    out = at.withColumn("date", F.col("__o.date")).withColumn("timestamp", X.floor_bin(token, bin_minutes)).drop("__o")
    return out.withColumn("tar_filename", F.concat(F.lit(f"{cruise}_"), "timestamp", F.lit(".tar"))).withColumn("is_valid_bin", F.col("timestamp").endswith("0"))


@dataclass
class Exported(WriterCommitMessage):
    """A task's archives (staged path, date, timestamp, tar_filename, n_images, bytes) and its part of the mapping."""

    archives: list[tuple] = field(default_factory=list)
    mapping: str | None = None


class ExportSink(DataSource):
    """rows.write.format("tar_export"): date, timestamp, tar_filename, tar_path, filename, content, sorted, become archives below the path."""

    @classmethod
    def name(cls) -> str:
        return "tar_export"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ExportWriter(dict(self.options))


class _Counted:
    """A stream that knows how much went into it."""

    def __init__(self, stream):
        self.stream, self.n = stream, 0

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        self.n += len(data)
        return len(data)


class ExportWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.run = options["path"], options["run"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Exported:
        from pyspark import TaskContext

        name = f"{TaskContext.get().taskAttemptId()}"
        to, told = Publication(self.root, self.run), Exported()
        names = [f.split()[0] for f in MAPPING.split(", ")]
        to.store.create_dir(f"{to.staging}/{name}", recursive=True)
        group = tar = stream = base = None
        n_images = k = repeats = 0

        def close() -> None:
            if tar is not None:
                tar.close()
                stream.stream.close()
                told.archives.append((f"{name}/{len(told.archives)}.tar", *group, n_images, stream.n))

        with to.store.open_output_stream(f"{to.staging}/{name}/mapping.csv", compression=None) as side, io.TextIOWrapper(side, "utf-8", newline="", write_through=True) as lines:
            mapping = csv.writer(lines)
            mapping.writerow(names)
            for b in iterator:
                for date, timestamp, tar_filename, tar_path, filename, content in zip(*(b.column(c) for c in ("date", "timestamp", "tar_filename", "tar_path", "filename", "content")), strict=True):
                    now = (date.as_py(), timestamp.as_py(), tar_filename.as_py())
                    if now != group:  # rolls over at the edge of each group
                        close()
                        group, n_images, k, base = now, 0, 0, None
                        stream = _Counted(to.store.open_output_stream(f"{to.staging}/{name}/{len(told.archives)}.tar", compression=None))
                        tar = tarfile.open(fileobj=stream, mode="w|", format=tarfile.PAX_FORMAT)
                    data = content.as_py() or b""
                    own = (filename.as_py() or "").replace("\\", "/").rpartition("/")[2] or "unnamed"
                    repeats, base = (repeats + 1 if own == base else 0), own
                    # files of one name, which stand together, keep it in folders of their own
                    member = "/".join([*([] if own in TOP else ["RawImages"]), *([str(repeats)] if repeats else []), own])
                    info = tarfile.TarInfo(member)
                    info.size, offset = len(data), tar.offset
                    tar.addfile(info, io.BytesIO(data))
                    tar.members.clear()
                    padded = -(-len(data) // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE
                    mapping.writerow([*now, member, tar_path.as_py(), filename.as_py(), k, len(data), offset, tar.offset - padded, tar.offset])
                    k, n_images = k + 1, n_images + (own not in TOP)
            close()
        told.mapping = f"{name}/mapping.csv" if told.archives else None
        return told

    def commit(self, messages: list[Exported | None]) -> None:
        to, done = Publication(self.root, self.run), [m for m in messages if m]
        made = sorted((a[1:], a[0]) for m in done for a in m.archives)
        places = [f"source/{a[0]}/{a[2]}" for a, _ in made]
        if len(set(places)) < len(places):
            to.clear()
            raise RuntimeError("an archive was written by two tasks")
        manifest = [dict(zip(("date", "timestamp", "tar_filename", "n_images", "bytes"), a, strict=True)) | {"is_valid_bin": a[1].endswith("0")} for a, _ in made]
        to.write("export_manifest.json", json.dumps(manifest, indent=1).encode(), "commit")
        names = {staged: name for (_, staged), name in zip(made, places, strict=True)}
        to.store.create_dir(f"{to.staging}/mapping", recursive=True)
        for k, m in enumerate(m for m in done if m.mapping):
            to.store.move(f"{to.staging}/{m.mapping}", f"{to.staging}/mapping/{k:06}.csv")
        to.publish(names | {"mapping": "metadata/origin_mapping.csv", "export_manifest.json": "metadata/export_manifest.json"})

    def abort(self, messages: list[Exported | None]) -> None:
        Publication(self.root, self.run).clear()


def export_archives(records: DataFrame, root: str, cruise: str, bin_minutes: int = 10, max_bubble_score: float = 1.0, min_object_count: int = 0) -> None:
    """Writes the exportable records (tar_path, filename, content, and bubble_score, object_count, bucket if there are such) below root.

    Instead of content, records may have the member's place (member_idx, size,
    data_offset, as archives.locate gives): then the task that writes an archive
    reads the bytes, and no shuffle carries them; unreadable members are left out.
    root gets source/{date}/{cruise}_{bin}.tar, and metadata: export_manifest.json,
    origin_mapping.csv, and the filter's results of all records by bucket. Members
    bear their base names; the second and further ones of a bin stand in numbered
    folders, in the order of tar_path, filename and, where records have it,
    member_idx. Null contents are empty files, null names `unnamed`. Archives of
    other bins that are there stay; the manifest and the mapping tell of this
    export alone. Without any exportable record the manifest is empty.
    """
    spark = records.sparkSession
    ship(spark)
    spark.dataSource.register(ExportSink)
    missing = {c: F.lit(None).cast(t) for c, t in (("bubble_score", "double"), ("object_count", "int"), ("bucket", "string")) if c not in records.columns}
    placed = place(records.withColumns(missing) if missing else records, cruise, bin_minutes).withColumn("exported", exportable(max_bubble_score, min_object_count))
    run, group = uuid.uuid4().hex, ["date", "timestamp", "tar_filename"]
    base = F.element_at(F.split(F.translate("filename", "\\", "/"), "/"), -1)
    rows = placed.filter("exported")
    located = "content" not in rows.columns
    if located and not rows.filter("data_offset is null").isEmpty():  # of compressed archives each is read once, in its order
        rows, located = archives.fetch(rows).filter("error is null"), False
    order = [*group, "__base", "tar_path", "filename", *(["member_idx"] if "member_idx" in rows.columns else [])]
    rows = rows.withColumn("__base", base).repartition(*group).sortWithinPartitions(*order)
    if located:
        rows = archives.fetch_in_place(rows).filter("error is null")
    rows.select(*group, "tar_path", "filename", "content").write.format("tar_export").mode("append").option("run", run).save(root)
    results = placed.select("tar_path", "filename", "bubble_score", "object_count", "exported", *group, F.coalesce("bucket", F.lit("none")).alias("bucket"))
    results.write.mode("overwrite").partitionBy("bucket").option("header", "true").csv(f"{root.rstrip('/')}/metadata/filter_results")


def read_mapping(spark: SparkSession, root: str) -> DataFrame:
    """The rows of MAPPING of an export; with tar_export, the archive's own path, they serve as a member index."""
    at = spark.read.schema(MAPPING).option("header", "true").csv(f"{root.rstrip('/')}/metadata/origin_mapping.csv")
    return at.withColumn("tar_export", F.concat(F.lit(f"{root.rstrip('/')}/source/"), "date", F.lit("/"), "tar_filename"))


def read_filter_results(spark: SparkSession, root: str) -> DataFrame:
    schema = "tar_path string, filename string, bubble_score double, object_count int, exported boolean, date string, timestamp string, tar_filename string, bucket string"
    return spark.read.schema(schema).option("header", "true").csv(f"{root.rstrip('/')}/metadata/filter_results")


def member_index(mapping: DataFrame) -> DataFrame:
    """The export's mapping in the form of archives.member_index, without another pass over the archives."""
    return mapping.select(F.col("tar_export").alias("tar_path"), "member_idx", F.col("member").alias("name"), "size", "offset", "data_offset", "next_offset", F.lit(None).cast("string").alias("error"))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """date, timestamp, tar_filename, n_images, bytes, is_valid_bin of each archive of the last export."""
    schema = "date string, timestamp string, tar_filename string, n_images bigint, bytes bigint, is_valid_bin boolean"
    return spark.read.schema(schema).option("multiLine", "true").json(f"{root.rstrip('/')}/metadata/export_manifest.json")


def validate(spark: SparkSession, root: str) -> DataFrame:
    """check, severity, subject and detail of each thing that is wrong with an export; no rows if all is well.

    Errors: no source folder; no image. Warnings: a date folder or archive of the
    manifest that is not there or has another size, a folder without archives, a
    bin whose time does not end in 0, which the classifier would skip.
    """
    store, inner, _ = file_system(root.rstrip("/"))
    told = manifest(spark, root)
    if store.get_file_info(f"{inner}/source").type.name == "NotFound":
        return spark.createDataFrame([("source_exists", "error", "source", "no such folder")], "check string, severity string, subject string, detail string")
    paths = [(p.rpartition("/source/")[2], file_system(p)[0].get_file_info(file_system(p)[1]).size) for p in files_below(f"{root.rstrip('/')}/source")]
    there = spark.createDataFrame(paths, "path string, size bigint")
    at = told.withColumn("path", F.concat_ws("/", "date", "tar_filename")).join(there, "path", "left")

    def found(rows: DataFrame, check: str, severity: str, subject: Column, detail: Column) -> DataFrame:
        return rows.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), subject.alias("subject"), detail.alias("detail"))

    dates = told.select("date").distinct().join(there.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("date")).distinct(), "date", "left_anti")
    images = told.agg(F.coalesce(F.sum("n_images"), F.lit(0)).alias("n")).filter("n = 0")
    return (
        found(dates, "date_has_archives", "warning", F.col("date"), F.lit("no archives"))
        .unionByName(found(at.filter("size is null or size <> bytes"), "archive_is_whole", "warning", F.col("path"), F.concat(F.coalesce(F.col("size"), F.lit(0)).cast("string"), F.lit(" bytes of "), F.col("bytes").cast("string"))))
        .unionByName(found(told.filter("not is_valid_bin"), "bin_ends_in_0", "warning", F.concat_ws("/", "date", "tar_filename"), F.col("timestamp")))
        .unionByName(found(images, "has_images", "error", F.lit("export"), F.lit("no image")))
    )


def merge_results(results: DataFrame, mapping: DataFrame, filter_results: DataFrame) -> DataFrame:
    """results (date, time as HH:mm, id, …) of a classified export with where each image came from and what the filter said of it.

    Images are found by the member's whole name where id has it, else by base
    name; rows without an exported member have nulls.
    """
    own = mapping.select("date", F.col("timestamp").alias("__t"), F.col("member").alias("__m"), F.col("tar_path").alias("origin_tar"), F.col("filename").alias("origin_filename"))
    name = F.translate("id", "\\", "/")
    at = results.withColumn("__t", F.translate("time", ":", "")).withColumn("__m", F.when(name.contains("RawImages/"), F.concat(F.lit("RawImages/"), F.element_at(F.split(name, "RawImages/"), -1))).otherwise(F.concat(F.lit("RawImages/"), X.basename("id"))))
    said = filter_results.select(F.col("tar_path").alias("origin_tar"), F.col("filename").alias("origin_filename"), "bubble_score", "object_count").dropDuplicates(["origin_tar", "origin_filename"])
    return at.join(own, ["date", "__t", "__m"], "left").join(said, ["origin_tar", "origin_filename"], "left").select(*results.columns, "origin_tar", "origin_filename", "bubble_score", "object_count")
