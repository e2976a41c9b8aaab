"""Tar archives as tables: one row a member, decoded images, side-cars, positions.

`members` streams each archive inside a task, so that its size is not bounded by
a row's; a member's is (2 GB). Archives are listed by Spark's binaryFile source
without their content, and opened where they are. `archives` of this package
splits them over tasks and reads single members.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftscan import functions as X
from driftscan.session import ship
from driftscan.sources.archives import whole_members

EXTENSIONS = (".jpg", ".jpeg", ".png", ".tiff", ".tif", ".bmp", ".webp")
IMAGES = "tar_path string, member_idx int, filename string, height int, width int, channels int, ndim int, dtype string, pixels binary, error string"


def archives(spark: SparkSession, *paths: str) -> DataFrame:
    """tar_path, length and content of all archives below paths; unused columns are not read."""
    ship(spark)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar*").load(list(paths)).select(F.regexp_replace("path", "^file:", "").alias("tar_path"), "length", "content")


def members(tars: DataFrame, with_content: bool = True, only_images: bool = False) -> DataFrame:
    """One row for each file in each archive (MEMBERS), any compression; an unreadable archive is one row with an error after what could be read.

    A member of more than 2 GB has an error and no content. Large archives are
    better split over tasks: archives.split_members.
    """
    if only_images:
        return whole_members(tars, with_content, lambda name: name.lower().endswith(EXTENSIONS))
    return whole_members(tars, with_content)


_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], names: list[str], schema: str) -> pa.RecordBatch:
    types = [_TYPES[x.split()[1]] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def manifest(tars: DataFrame) -> DataFrame:
    """tar_path, n_members and the image members' names in order, without decoding."""
    m = members(tars, with_content=False, only_images=True)
    return m.filter("member_idx >= 0").groupBy("tar_path").agg(F.count("*").alias("n_members"), F.transform(F.array_sort(F.collect_list(F.struct("member_idx", "name"))), lambda x: x["name"]).alias("names"))


def decode_images(member_rows: DataFrame, mode: str | None = None, min_size: tuple[int, int] = (0, 0), max_size: tuple[int, int] = (1 << 30, 1 << 30), full: bool = True) -> DataFrame:
    """IMAGES rows of the image members; sizes are (width, height), inclusive, after mode conversion.

    Damaged and unsupported files keep a row with an error and no pixels (the
    quarantine); images out of bounds are dropped.
    """
    names = [x.split()[0] for x in IMAGES.split(", ")]

    def one(path, k, name, content):
        from driftscan.imaging import decode

        try:
            a = decode.convert(decode.decode(content or b""), mode)
        except ValueError as e:
            return path, k, name, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:200]
        return path, k, name, a.shape[0], a.shape[1], a.shape[2] if a.ndim > 2 else 1, a.ndim, a.dtype.name, a.tobytes() if full else None, None

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 16):
                rows = [one(*(c.as_py() for c in r)) for r in zip(*(b.column(i)[lo : lo + 16] for i in range(4)), strict=True)]
                if rows:
                    yield _batch(rows, names, IMAGES)

    images = member_rows.filter(X.suffix("name").isin(*EXTENSIONS)).select("tar_path", "member_idx", "name", "content").mapInArrow(run, IMAGES)
    inside = F.col("width").between(min_size[0], max_size[0]) & F.col("height").between(min_size[1], max_size[1])
    return images.filter(F.col("error").isNotNull() | inside)


def check_images(member_rows: DataFrame, strict: bool = False) -> DataFrame:
    """tar_path, member_idx, name, corrupt and error of the image members.

    The lenient check looks at a file's structure, the strict one decodes all
    pixels as well. Sound files of a form that is not decoded here are not
    corrupt; members without content are.
    """

    def run(batches):
        from driftscan.imaging import decode

        for b in batches:
            errors = []
            for content in b.column("content"):
                try:
                    decode.verify(content.as_py() or b"")
                    if strict:
                        decode.decode(content.as_py() or b"")
                    errors.append(None)
                except decode.Unsupported:
                    errors.append(None)
                except ValueError as e:
                    errors.append(str(e)[:200])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([e is not None for e in errors]), pa.array(errors, pa.string())], ["tar_path", "member_idx", "name", "corrupt", "error"])

    images = member_rows.filter(X.suffix("name").isin(*EXTENSIONS)).select("tar_path", "member_idx", "name", "content")
    return images.mapInArrow(run, "tar_path string, member_idx int, name string, corrupt boolean, error string")


def hits_misses(member_rows: DataFrame) -> DataFrame:
    """tar_path, line_no, hits, misses of the HitsMisses.txt side-cars; empty ones have no rows."""
    text = member_rows.filter(X.basename("name") == "HitsMisses.txt").select("tar_path", F.posexplode(F.split(F.col("content").cast("string"), r"\r?\n")).alias("line_no", "line"))
    parts = F.split("line", ",")
    return text.filter(F.trim("line") != "").select("tar_path", "line_no", F.get(parts, F.lit(0)).try_cast("bigint").alias("hits"), F.get(parts, F.lit(1)).try_cast("bigint").alias("misses"))


def positions(member_rows: DataFrame, background: str = "Background.tif") -> DataFrame:
    """tar_path, lat, lon from the background image's GPS tags; nulls where it has none."""

    def run(batches):
        from driftscan.imaging.decode import gps

        for b in batches:
            got = [gps(c.as_py() or b"") for c in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64())], ["tar_path", "lat", "lon"])

    rows = member_rows.filter(X.basename("name") == background).select("tar_path", "content").mapInArrow(run, "tar_path string, lat double, lon double")
    return rows.groupBy("tar_path").agg(F.max("lat").alias("lat"), F.max("lon").alias("lon"))


def survey_bins(tars: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Archives of ten-minute bins with date folder and timestamp; those with a finished output are left out."""
    out = tars.withColumn("timestamp", X.timestamp_token("tar_path")).withColumn("date", F.element_at(F.split("tar_path", "/"), -2)).filter(X.tenth_minute("timestamp"))
    return out if done is None else out.join(done.select("date", "timestamp"), ["date", "timestamp"], "left_anti")
