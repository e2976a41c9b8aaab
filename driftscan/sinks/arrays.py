"""Zarr v2 stores of bucketed images, written chunk file by chunk file from tasks.

The sink is a data source of its own. Every chunk is a file below a staging
folder that one task writes, so tasks need no order and a retried one writes the
same bytes again. Tasks tell the commit how many chunks of each array they
wrote. The commit holds that against the manifest, adds the metadata and lets
the finished stores take the place of older ones, which stay whole until then;
an aborted job leaves nothing but them.
"""

from __future__ import annotations

import json
import math
import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from driftscan import functions as X
from driftscan.operators import stats
from driftscan.session import materialize, scratch_tables, ship
from driftscan.sources.archives import batches
from driftscan.stores import Publication, file_system, files_below, local, open_file

TILES = "bucket string, level int, z bigint, ty int, tx int, chunk string, data binary"
CHUNKS = "chunk string, data binary"


def _tasks(spark: SparkSession) -> int:
    """How many tasks small files are dealt over: they cost by their number, which adaptive execution does not see in their bytes."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class Codec:
    """How chunks are compressed: none, zlib, zstd or lz4, and whether bytes are shuffled by the size of an element before."""

    name: str = "zlib"
    level: int = 5
    shuffle: bool = False

    def __post_init__(self):
        if self.name not in ("none", "zlib", "zstd", "lz4"):
            raise ValueError(f"unsupported codec {self.name}")

    def encode(self, data: bytes, itemsize: int) -> bytes:
        if self.shuffle and itemsize > 1:
            data = np.frombuffer(data, np.uint8).reshape(-1, itemsize).T.tobytes()
        if self.name == "zlib":
            return zlib.compress(data, self.level)
        if self.name == "zstd":
            return pa.Codec("zstd", compression_level=self.level).compress(data, asbytes=True)
        if self.name == "lz4":
            return struct.pack("<I", len(data)) + pa.Codec("lz4_raw").compress(data, asbytes=True)
        return data

    def metadata(self, itemsize: int) -> dict:
        compressor = {"zlib": {"id": "zlib", "level": self.level}, "zstd": {"id": "zstd", "level": self.level}, "lz4": {"id": "lz4", "acceleration": 1}}.get(self.name)
        return {"compressor": compressor, "filters": [{"id": "shuffle", "elementsize": itemsize}] if self.shuffle and itemsize > 1 else None}

    def label(self) -> str:
        return f"{self.name}_clevel{self.level}_{'shuffle' if self.shuffle else 'noshuffle'}"


def tile_table(images: DataFrame, tile: int = 300, levels: int = 1, factor: int = 2, on_oversize: str = "error") -> DataFrame:
    """TILES of bucketed images (bucket_h, bucket_w, bucket, z, height, width, channels, ndim, dtype, pixels); chunk is a tile's name in its array.

    Images of a bucket are brought to its widest dtype and its most channels,
    padded with zeros, and averaged down for further levels. They are dealt over
    tasks by bucket and z, so that a bucket's images are made by many.
    """
    common = stats.promote(images).select("bucket", F.col("dtype").alias("to_dtype"), F.col("channels").alias("to_channels"))
    rows = images.join(F.broadcast(common), "bucket").select("bucket", "z", "bucket_h", "bucket_w", "height", "width", "channels", "ndim", "dtype", "to_dtype", "to_channels", "pixels")
    schema = T.StructType.fromDDL(TILES)

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from driftscan.imaging import arrays

        for b in parts:
            for r in (dict(zip(b.schema.names, (c[k].as_py() for c in b.columns), strict=True)) for k in range(b.num_rows)):
                a = np.frombuffer(r["pixels"], r["dtype"]).reshape((r["height"], r["width"], r["channels"]) if r["ndim"] > 2 else (r["height"], r["width"]))
                a = arrays.pad_to(arrays.harmonise(a, r["to_channels"]).astype(r["to_dtype"]), r["bucket_h"], r["bucket_w"], on_oversize)
                last = ".0" if a.ndim > 2 else ""  # a colour image has one chunk of channels
                for lv, p in enumerate(arrays.pyramid(a, levels, factor)):
                    for ty, tx, t in arrays.tiles(p, min(tile, *p.shape[:2])):
                        yield r["bucket"], lv, r["z"], ty, tx, f"{r['z']}.{ty}.{tx}{last}", t.tobytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(made(parts), schema, 6, most_bytes=4_000_000)

    return rows.repartition(_tasks(images.sparkSession), "bucket", "z").mapInArrow(run, TILES)


def manifest(images: DataFrame, tile: int = 300, levels: int = 1, factor: int = 2, codec: Codec = Codec()) -> DataFrame:
    """One row for each bucket and level: shape, chunks, dtype, number of images and compression."""
    common = stats.promote(images)
    sizes = images.groupBy("bucket").agg(F.count("*").alias("n_images"), F.first("bucket_h").alias("h"), F.first("bucket_w").alias("w")).join(common, "bucket")
    at = sizes.select("*", F.posexplode(F.array(*(F.lit(factor**k) for k in range(levels)))).alias("level", "f"))
    h, w = F.ceil(F.col("h") / F.col("f")).cast("int"), F.ceil(F.col("w") / F.col("f")).cast("int")
    side = F.least(F.lit(tile), h, w)
    tail = F.when(F.col("channels") > 1, F.array("channels")).otherwise(F.array().cast("array<int>"))
    return at.select("bucket", "level", "n_images", "dtype", F.concat(F.array(F.col("n_images").cast("int"), h, w), tail).alias("shape"), F.concat(F.array(F.lit(1), side, side), tail).alias("chunks"), F.lit(codec.label()).alias("compression"))


@dataclass
class Written(WriterCommitMessage):
    """How many chunks of each (bucket, level) a task wrote."""

    chunks: dict[tuple[str, int], int]


class ArraySink(DataSource):
    """rows.write.format("zarr"): columns bucket, level, chunk and data become chunk files of stores below the path.

    Options: manifest, the path of the written manifest table; settings, what
    write_stores was given as JSON.
    """

    @classmethod
    def name(cls) -> str:
        return "zarr"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrayWriter(dict(self.options))


class ArrayWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.manifest, own = options["manifest"], json.loads(options["settings"])
        self.codec, self.itemsizes = Codec(**own["codec"]), {}
        self.levels, self.factor, self.pixel_size = own["levels"], own["factor"], own["pixel_size"]
        self.root, self.run = options["path"], own["run"]

    def rows(self) -> list[dict]:
        """The manifest: one row for each array."""
        import pyarrow.dataset as ds

        files = [file_system(p)[1] for p in files_below(self.manifest, lambda name: name.endswith(".parquet"))]
        return ds.dataset(files, filesystem=file_system(self.manifest)[0]).to_table().to_pylist() if files else []

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        attempt = f"attempt-{TaskContext.get().taskAttemptId()}"
        to, chunks = Publication(self.root, self.run), Counter()
        itemsizes = {(r["bucket"], r["level"]): np.dtype(r["dtype"]).itemsize for r in self.rows()} if self.codec.shuffle else {}
        for b in iterator:
            for bucket, level, chunk, data in zip(*(b.column(n) for n in ("bucket", "level", "chunk", "data")), strict=True):
                key = (bucket.as_py(), level.as_py())
                to.write(f"bucket_{key[0]}.zarr/{key[1]}/{chunk.as_py()}", self.codec.encode(data.as_py(), itemsizes.get(key, 1)), attempt)
                chunks[key] += 1
        return Written(dict(chunks))

    def commit(self, messages: list[Written | None]) -> None:
        to, made = Publication(self.root, self.run), Counter()
        for m in messages:
            made.update(m.chunks if m else {})
        rows = self.rows()
        for r in rows:
            want = math.prod(-(-n // c) for n, c in zip(r["shape"], r["chunks"], strict=True))
            if made[r["bucket"], r["level"]] != want:
                to.clear()
                raise RuntimeError(f"{r['bucket']}, level {r['level']}: {made[r['bucket'], r['level']]} chunks of {want}")
        for r in rows:
            store, kind = f"bucket_{r['bucket']}.zarr", np.dtype(r["dtype"])
            array = {"zarr_format": 2, "shape": r["shape"], "chunks": r["chunks"], "dtype": kind.str, "fill_value": 0, "order": "C", **self.codec.metadata(kind.itemsize)}
            to.write(f"{store}/{r['level']}/.zarray", _json(array), "commit")
            if r["level"] == 0:
                to.write(f"{store}/.zgroup", _json({"zarr_format": 2}), "commit")
                to.write(f"{store}/.zattrs", _json(multiscale_metadata(self.levels, self.factor, self.pixel_size, r["shape"])), "commit")
        to.publish({s: s for s in sorted({f"bucket_{r['bucket']}.zarr" for r in rows})})

    def abort(self, messages: list[Written | None]) -> None:
        Publication(self.root, self.run).clear()


def _json(value: dict) -> bytes:
    return json.dumps(value, indent=1, sort_keys=True).encode()


def write_stores(images: DataFrame, root: str, tile: int = 300, levels: int = 1, factor: int = 2, level: int = 5, pixel_size: float = 0.36, on_oversize: str = "error", codec: Codec | None = None) -> DataFrame:
    """Writes bucket_{HxW}.zarr stores below root and returns the manifest with their paths.

    root is a folder that all executors reach: of a mounted file system, or of a
    store with renames that Arrow's file systems open (hdfs, abfs). An older
    store of a name is readable until the new one is complete, and stays if the
    job fails; stores of other names are left alone. No images make no stores.
    level is that of codec where none is given.
    """
    spark, codec = images.sparkSession, codec or Codec(level=level)
    ship(spark)
    spark.dataSource.register(ArraySink)
    with scratch_tables() as made:
        plan = materialize(manifest(images, tile, levels, factor, codec), "manifest")
    settings = {"codec": codec.__dict__, "levels": levels, "factor": factor, "pixel_size": pixel_size, "run": uuid.uuid4().hex}
    chunks = tile_table(images, tile, levels, factor, on_oversize).select("bucket", "level", "chunk", "data")
    chunks.write.format("zarr").mode("append").option("manifest", made[-1]).option("settings", json.dumps(settings)).save(root)
    return plan.withColumn("store_path", F.concat(F.lit(f"{local(root.rstrip('/'))}/bucket_"), "bucket", F.lit(".zarr")))


def read_chunks(spark: SparkSession, array: str) -> DataFrame:
    """Name and bytes, as they are stored, of every chunk of an array of a published store.

    The array's own metadata tell which chunks there are, so that no folder with a
    file for each is listed; a chunk that is not there is an error. Tasks open
    them where they lie.
    """
    ship(spark)
    with open_file(f"{array.rstrip('/')}/.zarray") as f:
        told = json.loads(f.read())
    grid, schema = tuple(-(-n // c) for n, c in zip(told["shape"], told["chunks"], strict=True)), T.StructType.fromDDL(CHUNKS)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        store, inner, _ = file_system(array.rstrip("/"))
        for b in parts:
            for at in zip(*(x.tolist() for x in np.unravel_index(b.column(0).to_numpy(), grid)), strict=True):
                name = ".".join(map(str, at))
                with store.open_input_file(f"{inner}/{name}") as f:
                    yield name, f.read()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(read(parts), schema, 1, most_bytes=4_000_000)

    return spark.range(0, math.prod(grid), 1, _tasks(spark)).mapInArrow(run, CHUNKS)


def multiscale_metadata(levels: int, factor: int, pixel_size: float, shape) -> dict:
    """Axes and transforms of the levels: scale s*f^l, translation (f^l-1)*s/2."""
    colour = [{"name": "c", "type": "channel"}] if len(shape) > 3 else []
    axes = [{"name": "z", "type": "space"}, *({"name": n, "type": "space", "unit": "micrometer"} for n in "yx"), *colour]
    sets = []
    for k in range(levels):
        s, t = pixel_size * factor**k, (factor**k - 1) * pixel_size / 2
        extra = [1.0] * len(colour)
        sets.append({"path": str(k), "coordinateTransformations": [{"type": "scale", "scale": [1.0, s, s, *extra]}, {"type": "translation", "translation": [0.0, t, t, *(0.0 for _ in extra)]}]})
    return {"multiscales": [{"version": "0.4", "axes": axes, "datasets": sets, "type": "mean"}]}


def image_metadata(images: DataFrame) -> DataFrame:
    """One row for each image of a store, in its order."""
    opt = [F.col(c) if c in images.columns else F.lit(None).cast(t) for c, t in (("bubble_score", "double"), ("object_count", "int"))]
    return images.select("bucket", F.col("z").alias("index"), F.col("filename").alias("original_filename"), opt[0].alias("bubble_detection_score"), opt[1].alias("object_count"), F.array("height", "width").alias("original_shape"), F.col("tar_path").alias("tar_source"))


def label(codec: str, level: int, shuffle: str):
    return X.compression_label(F.lit(codec), F.lit(level), F.lit(shuffle))


def zip_store(store: str, out: str) -> None:
    """A finished store as an uncompressed ZIP archive with paths relative to it."""
    import os
    import zipfile

    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for folder, _, names in sorted(os.walk(store)):
            for n in sorted(names):
                full = os.path.join(folder, n)
                z.write(full, os.path.relpath(full, store))
