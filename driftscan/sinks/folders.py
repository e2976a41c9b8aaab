"""Many small files in folders: sampled images by class."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.window import Window

from driftscan import functions as X
from driftscan.operators import sampling
from driftscan.session import materialize, ship
from driftscan.sources import archives
from driftscan.stores import Publication, file_system


@dataclass
class Filled(WriterCommitMessage):
    """How many files of each folder a task wrote."""

    files: dict[str, int]


class FolderSink(DataSource):
    """rows.write.format("folders"): columns folder, name and content become files of whole folders below the path."""

    @classmethod
    def name(cls) -> str:
        return "folders"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return FolderWriter(dict(self.options))


class FolderWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.run = options["path"], options["run"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Filled:
        from pyspark import TaskContext

        to, files = Publication(self.root, self.run), Counter()
        attempt = f"attempt-{TaskContext.get().taskAttemptId()}"
        for b in iterator:
            for folder, name, content in zip(*(b.column(c) for c in ("folder", "name", "content")), strict=True):
                to.write(f"{folder.as_py()}/{name.as_py()}", content.as_py() or b"", attempt)
                files[folder.as_py()] += 1
        return Filled(dict(files))

    def commit(self, messages: list[Filled | None]) -> None:
        to = Publication(self.root, self.run)
        made = {folder for m in messages if m for folder in m.files}
        to.publish({f: f for f in sorted(made)})

    def abort(self, messages: list[Filled | None]) -> None:
        Publication(self.root, self.run).clear()


def existing_folders(root: str) -> list[str]:
    """Names of the folders in root; none where it is not there."""
    store, inner, _ = file_system(root.rstrip("/"))
    if store.get_file_info(inner).type != fs.FileType.Directory:
        return []
    return sorted(f.base_name for f in store.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.Directory and not f.base_name.startswith("."))


def write_folders(files: DataFrame, root: str) -> None:
    """Writes files (folder, name, content); folders appear whole, in place of older ones of their names."""
    ship(files.sparkSession)
    files.sparkSession.dataSource.register(FolderSink)
    files.select("folder", "name", "content").write.format("folders").mode("append").option("run", uuid.uuid4().hex).save(root)


def class_folder(class_id: str = "pred_id", label: str = "pred_label"):
    """{id}_{label}, with what no folder's name should have replaced."""
    return F.concat_ws("_", F.col(class_id).cast("bigint").cast("string"), F.regexp_replace(F.coalesce(F.col(label), F.lit("unknown")), r"[/\\\x00-\x1f]", "_"))


def sample_folders(predictions: DataFrame, index: DataFrame, root: str, n: int = 100, seed: int = 42, key: str = "id") -> DataFrame:
    """Copies n images of each class out of the archives into {class id}_{label} folders below root; returns what could not be copied.

    predictions have tar_path, pred_id, pred_label and the image's name in `key`;
    index is the archives' member index. Classes whose folder is there are
    skipped, so that a broken run goes on where it stopped. Backgrounds are left
    out, fewer than n are all taken. Of images of one name in a class all are
    kept, further ones with a number before it. Rows returned have the
    prediction's columns and an error.
    """
    spark = predictions.sparkSession
    known = spark.createDataFrame([(f,) for f in existing_folders(root)], "folder string")
    rows = predictions.filter(~F.contains(F.col(key), F.lit("Background.tif"))).withColumn("folder", class_folder()).join(F.broadcast(known), "folder", "left_anti")
    drawn = sampling.per_class(rows, "folder", key, n, seed).drop("draw")
    fetched = materialize(archives.fetch(archives.locate(drawn, index, key)), "samples")
    again = F.row_number().over(Window.partitionBy("folder", "name").orderBy("tar_path", key)) - 1
    good = fetched.filter("error is null").withColumn("name", X.basename("name")).withColumn("again", again)
    named = F.when(F.col("again") > 0, F.concat_ws("_", F.col("again").cast("string"), "name")).otherwise(F.col("name"))
    write_folders(good.withColumn("name", named), root)
    return fetched.filter("error is not null").select(*predictions.columns, "error")
