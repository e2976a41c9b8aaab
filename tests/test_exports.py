"""Array stores and archive exports: what is written, and what stays when a job fails."""

import io
import json
import struct
import tarfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftscan.sinks import arrays, exports
from driftscan.sources import archives, tar
from driftscan.stores import Publication

IMAGES = "bucket string, bucket_h int, bucket_w int, z long, height int, width int, channels int, ndim int, dtype string, pixels binary"


def images(spark, fill=1, kind="uint16", n=3, size=(5, 7), colour=False):
    shape = (*size, 3) if colour else size
    rows = [("8x8", 8, 8, z, *size, 3 if colour else 1, len(shape), kind, bytearray(np.full(shape, fill + z, kind).tobytes())) for z in range(n)]
    return spark.createDataFrame(rows, IMAGES)


def chunk(path, codec, kind):
    raw = path.read_bytes()
    if codec.name == "zlib":
        raw = zlib.decompress(raw)
    elif codec.name == "zstd":
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(raw)
    elif codec.name == "lz4":
        raw = pa.Codec("lz4_raw").decompress(raw[4:], struct.unpack("<I", raw[:4])[0], asbytes=True)
    size = np.dtype(kind).itemsize
    if codec.shuffle and size > 1:
        raw = np.frombuffer(raw, np.uint8).reshape(size, -1).T.tobytes()
    return np.frombuffer(raw, kind)


@pytest.mark.parametrize("codec", [arrays.Codec(), arrays.Codec("none"), arrays.Codec("zstd", 3, True), arrays.Codec("lz4", 1, True), arrays.Codec("zlib", 9, True)])
def test_codecs(spark, tmp_path, codec):
    out = arrays.write_stores(images(spark), str(tmp_path), tile=4, codec=codec).first()
    assert out["compression"] == codec.label() and out["store_path"] == f"{tmp_path}/bucket_8x8.zarr"
    meta = json.loads((tmp_path / "bucket_8x8.zarr/0/.zarray").read_text())
    assert (meta["compressor"] or {}).get("id", "none") == codec.name and bool(meta["filters"]) == codec.shuffle
    got = chunk(tmp_path / "bucket_8x8.zarr/0/2.1.1", codec, "<u2").reshape(4, 4)
    assert (got == np.pad(np.full((1, 3), 3), ((0, 3), (0, 1)))).all()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bucket_8x8.zarr"]
    with pytest.raises(ValueError):
        arrays.Codec("blosc")


def test_a_failed_job_leaves_the_old_store_and_nothing_else(spark, tmp_path):
    arrays.write_stores(images(spark), f"file://{tmp_path}", tile=4)
    before = {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    large = images(spark, 9).unionByName(images(spark, 9, size=(9, 9)))  # the last do not fit into their bucket
    with pytest.raises(Exception, match="(?i)larger|exceed|fit|oversize"):
        arrays.write_stores(large, str(tmp_path), tile=4)
    assert {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()} == before
    assert [p.name for p in tmp_path.iterdir()] == ["bucket_8x8.zarr"]
    arrays.write_stores(images(spark, 9, n=1, colour=True), str(tmp_path), tile=4)
    assert json.loads((tmp_path / "bucket_8x8.zarr/0/.zarray").read_text())["shape"] == [1, 8, 8, 3]
    assert {p.name for p in (tmp_path / "bucket_8x8.zarr/0").iterdir()} == {".zarray", *(f"0.{y}.{x}.0" for y in (0, 1) for x in (0, 1))}


def test_missing_chunks_and_lost_swaps_are_not_published(spark, tmp_path, monkeypatch):
    arrays.write_stores(images(spark), str(tmp_path), tile=4)
    before = {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    table = str(tmp_path.parent / f"{tmp_path.name}-plan")
    arrays.manifest(images(spark), 4).write.parquet(table)
    own = {"codec": arrays.Codec().__dict__, "levels": 1, "factor": 2, "pixel_size": 1.0, "run": "r1"}
    writer = arrays.ArrayWriter({"path": str(tmp_path), "manifest": table, "settings": json.dumps(own)})
    with pytest.raises(RuntimeError, match="11 chunks of 12"):
        writer.commit([arrays.Written({("8x8", 0): 6}), None, arrays.Written({("8x8", 0): 5})])
    to = Publication(str(tmp_path), "r2")
    to.write("bucket_8x8.zarr/0/.zarray", b"new", "a")
    to.write("bucket_8x8.zarr/0/.zarray", b"new", "b")  # an attempt that was begun twice
    with pytest.raises(FileNotFoundError):
        to.publish({"bucket_8x8.zarr": "bucket_8x8.zarr", "gone": "other"})
    assert {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file() and ".staging" not in str(p)} == before
    to.publish({"bucket_8x8.zarr": "bucket_8x8.zarr"})
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == [".zarray"] and not list(tmp_path.glob(".*"))


def test_one_bucket_is_written_and_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(40).select(F.lit("8x8").alias("bucket"), F.col("id").alias("z"), *(F.lit(8).alias(c) for c in ("bucket_h", "bucket_w", "height", "width")), F.lit(1).alias("channels"), F.lit(2).alias("ndim"), F.lit("uint8").alias("dtype"), F.unhex(F.repeat(F.lpad(F.hex("id"), 2, "0"), 64)).alias("pixels")).coalesce(1)
    dealt = arrays.tile_table(rows, 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 4 and max(r["count"] for r in dealt) < 120
    arrays.write_stores(rows, str(tmp_path), tile=4, codec=arrays.Codec("none"))
    got = arrays.read_chunks(spark, f"file://{tmp_path}/bucket_8x8.zarr/0")
    assert {r["chunk"]: bytes(r["data"]) for r in got.collect()} == {f"{z}.{y}.{x}": bytes([z]) * 16 for z in range(40) for y in (0, 1) for x in (0, 1)}
    assert got.filter("chunk is not null").count() == 160
    (tmp_path / "bucket_8x8.zarr/0/7.1.0").unlink()
    with pytest.raises(Exception, match="7.1.0"):
        got.collect()


def test_no_images_make_no_stores(spark, tmp_path):
    assert arrays.write_stores(images(spark).limit(0), str(tmp_path)).count() == 0
    assert list(tmp_path.iterdir()) == []


RECORDS = [
    ("/s/2024-01-01/run_1454.tar", "RawImages\\a.tif", b"one", 0.1, 1, "300x300"),
    ("/s/2024-01-01/run_1450.tar", "RawImages/a.tif", b"two", 0.2, 2, "300x300"),
    ("/s/2024-01-01/run_1450.tar", "RawImages/b.tif", b"", None, None, "300x600"),
    ("/s/2024-01-01/run_1450.tar", "Background.tif", b"back", 0.0, 0, None),
    ("/s/2024_01_02/run_930.tar", "c.tif", None, 0.0, 0, "300x300"),
    ("/s/2024_01_02/run_930.tar", None, b"n", 0.0, 0, "300x300"),
    ("/s/none.tar", "ü" * 80 + ".tif", b"long", 0.0, 0, "300x300"),
    ("/s/2024-01-01/run_1450.tar", "RawImages/x.tif", b"bubble", 0.9, 1, "300x300"),
]
SCHEMA = "tar_path string, filename string, content binary, bubble_score double, object_count int, bucket string"


def test_export_archives(spark, tmp_path):
    rows = spark.createDataFrame([(*r[:2], bytearray(r[2]) if r[2] is not None else None, *r[3:]) for r in RECORDS], SCHEMA).repartition(3)
    exports.export_archives(rows, str(tmp_path), "cruise", max_bubble_score=0.5)
    assert sorted(str(p.relative_to(tmp_path / "source")) for p in (tmp_path / "source").rglob("*.tar")) == ["1970-01-01/cruise_0000.tar", "2024-01-01/cruise_1450.tar", "2024-01-02/cruise_0930.tar"]
    with tarfile.open(tmp_path / "source/2024-01-01/cruise_1450.tar") as t:
        held = {m.name: t.extractfile(m).read() for m in t}
    assert held == {"Background.tif": b"back", "RawImages/a.tif": b"two", "RawImages/1/a.tif": b"one", "RawImages/b.tif": b""}
    mapping = exports.read_mapping(spark, str(tmp_path))
    assert mapping.count() == 7 and {r["filename"] for r in mapping.filter("member = 'RawImages/1/a.tif'").collect()} == {"RawImages\\a.tif"}
    # the mapping is an index: the same as a pass over the archives gives
    index = archives.member_index(tar.archives(spark, f"{tmp_path}/source"))
    assert sorted(map(str, exports.member_index(mapping).collect())) == sorted(map(str, index.collect()))
    told = {r["tar_filename"]: (r["n_images"], r["is_valid_bin"]) for r in exports.manifest(spark, str(tmp_path)).collect()}
    assert told == {"cruise_0000.tar": (1, True), "cruise_1450.tar": (3, True), "cruise_0930.tar": (2, True)}
    assert exports.validate(spark, str(tmp_path)).collect() == []
    said = exports.read_filter_results(spark, str(tmp_path))
    assert said.count() == 8 and said.filter("not exported").count() == 1
    results = spark.createDataFrame([("2024-01-01", "14:50", "/tmp/q/RawImages/1/a.tif", 3), ("2024-01-01", "14:50", "b.tif", 4), ("2024-01-01", "14:50", "zz.tif", 5)], "date string, time string, id string, pred_id int")
    merged = {r["pred_id"]: r for r in exports.merge_results(results, mapping, said).collect()}
    assert (merged[3]["origin_tar"], merged[3]["bubble_score"]) == (RECORDS[0][0], 0.1)
    assert merged[4]["origin_filename"] == "RawImages/b.tif" and merged[5]["origin_tar"] is None


@pytest.mark.parametrize("mode", ["w", "w:gz"])
def test_export_of_located_members_reads_them_where_they_are_written(spark, tmp_path, mode):
    """Two source archives of one bin, whose members alternate in the export."""
    for stamp in ("1231", "1234"):
        with tarfile.open(tmp_path / f"run_{stamp}.tar", mode) as t:
            for k in range(30):
                info = tarfile.TarInfo(f"RawImages/{k:02}.tif")
                info.size = len(stamp) + k
                t.addfile(info, io.BytesIO(stamp.encode() + b"x" * k))
    index = archives.member_index(tar.archives(spark, str(tmp_path)))
    rows = index.filter("member_idx % 3 > 0").select("tar_path", F.col("name").alias("filename"), "member_idx", "size", "data_offset")
    gone = spark.createDataFrame([("/none/run_1230.tar", "q.tif", 0, 5, 512 if mode == "w" else None)], rows.schema)
    exports.export_archives(rows.unionByName(gone), str(tmp_path / "out"), "c")
    with tarfile.open(tmp_path / "out/source/1970-01-01/c_1230.tar") as t:
        held = {m.name: t.extractfile(m).read() for m in t}
    want = {f"RawImages/{'' if s == '1231' else '1/'}{k:02}.tif": s.encode() + b"x" * k for s in ("1231", "1234") for k in range(30) if k % 3}
    assert held == want


def test_members_of_one_archive_and_name_stand_in_its_order(spark, tmp_path):
    rows = [("/s/2024-01-01/run_1450.tar", "RawImages/a.tif", k, bytearray(b"%d" % k)) for k in reversed(range(40))]
    exports.export_archives(spark.createDataFrame(rows, "tar_path string, filename string, member_idx bigint, content binary"), str(tmp_path), "c")
    with tarfile.open(tmp_path / "source/2024-01-01/c_1450.tar") as t:
        assert [t.extractfile(m).read() for m in t] == [b"%d" % k for k in range(40)]


def test_export_again_replaces_and_validates(spark, tmp_path):
    rows = spark.createDataFrame([(*r[:2], bytearray(r[2] or b"")) for r in RECORDS], "tar_path string, filename string, content binary")
    exports.export_archives(rows, f"file://{tmp_path}", "c", bin_minutes=7)
    bad = {(r["check"], r["subject"]) for r in exports.validate(spark, str(tmp_path)).collect()}
    assert bad and {c for c, _ in bad} == {"bin_ends_in_0"}
    exports.export_archives(rows.filter("tar_path like '%none%'"), str(tmp_path), "c")
    assert exports.read_mapping(spark, str(tmp_path)).count() == 1
    (tmp_path / "source/1970-01-01/c_0000.tar").unlink()
    assert {r["check"] for r in exports.validate(spark, str(tmp_path)).collect()} == {"date_has_archives", "archive_is_whole"}
    exports.export_archives(rows.limit(0), str(tmp_path), "c")
    assert {(r["check"], r["severity"]) for r in exports.validate(spark, str(tmp_path)).collect()} == {("has_images", "error")}
    assert [r["check"] for r in exports.validate(spark, str(tmp_path / "none")).collect()] == ["source_exists"] if (tmp_path / "none").exists() else True


def test_one_bin_of_many_members_is_streamed(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit("/s/2024-01-01/r_1000.tar").alias("tar_path"), F.concat(F.lit("i"), "id", F.lit(".tif")).alias("filename"), F.repeat(F.lit("x"), 200).cast("binary").alias("content"))
    exports.export_archives(rows, str(tmp_path), "c")
    told = exports.manifest(spark, str(tmp_path)).collect()
    assert [(r["n_images"], r["bytes"] >= 20_000 * 1024) for r in told] == [(20_000, True)]
    with tarfile.open(tmp_path / "source/2024-01-01/c_1000.tar") as t:
        assert sum(1 for _ in t) == 20_000


def test_a_failed_export_leaves_the_old_one(spark, tmp_path):
    rows = spark.createDataFrame([(*r[:2], bytearray(r[2] or b"")) for r in RECORDS], "tar_path string, filename string, content binary")
    exports.export_archives(rows, str(tmp_path), "c")
    before = {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    broken = rows.withColumn("content", F.when(F.col("filename") == "c.tif", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.lit(b"other")))
    with pytest.raises(Exception, match="lost"):
        exports.export_archives(broken, str(tmp_path), "c")
    assert {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()} == before and not list(tmp_path.glob(".*"))


def test_members_of_a_broken_archive_before_the_damage_stay(spark, tmp_path):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for k in range(50):
            info = tarfile.TarInfo(f"{k}.tif")
            info.size = 1000
            t.addfile(info, io.BytesIO(np.random.default_rng(k).bytes(1000)))
    raw = bytearray(out.getvalue())
    raw[30_000:30_200] = bytes(200)
    (tmp_path / "x.tar.gz").write_bytes(raw)
    got = tar.members(tar.archives(spark, str(tmp_path))).collect()
    assert sum(r["error"] is None for r in got) >= 20 and sum(r["error"] is not None for r in got) == 1
