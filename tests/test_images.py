"""Archives, decoders, kernels and array stores, on files made here."""

import gzip
import io
import json
import struct
import tarfile
import zlib

import numpy as np
import pytest

from driftscan.imaging import arrays, decode, regions
from driftscan.operators import stats
from driftscan.sinks import arrays as sink
from driftscan.sources import objects, tar


def tiff(a: np.ndarray, gps: tuple | None = None, pack: int = 1) -> bytes:
    body = zlib.compress(a.tobytes()) if pack == 8 else a.tobytes()
    h, w = a.shape[:2]
    c = a.shape[2] if a.ndim > 2 else 1
    tags = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 1, a.itemsize * 8), (259, 3, 1, pack), (262, 3, 1, 2 if c == 3 else 1), (273, 4, 1, 8), (277, 3, 1, c), (278, 4, 1, h), (279, 4, 1, len(body))]
    at = 8 + len(body)
    extra = b""
    if gps:
        tags.append((0x8825, 4, 1, at + 2 + 12 * (len(tags) + 1) + 4))
        base = tags[-1][3] + 2 + 12 * 4 + 4
        rats = b"".join(struct.pack("<II", int(round(v * 100)), 100) for dms in gps[:2] for v in dms)
        own = [(1, 2, 2, gps[2]), (2, 5, 3, base), (3, 2, 2, gps[3]), (4, 5, 3, base + 24)]
        extra = struct.pack("<H", 4) + b"".join(struct.pack("<HHI4s", t, k, n, v.encode().ljust(4, b"\0")) if k == 2 else struct.pack("<HHII", t, k, n, v) for t, k, n, v in own) + b"\0" * 4 + rats
    ifd = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in sorted(tags)) + b"\0" * 4
    return struct.pack("<2sHI", b"II", 42, at) + body + ifd + extra


def png(a: np.ndarray, how: int = 0) -> bytes:
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w = a.shape[:2]
    rows = []
    for y in range(h):
        row = a[y].astype(np.int16)
        up = a[y - 1].astype(np.int16) if y else np.zeros_like(row)
        left = np.concatenate([np.zeros_like(row[:1]), row[:-1]])
        f = {0: row, 1: row - left, 2: row - up, 3: row - (left + up) // 2}[how]
        rows.append(bytes([how]) + (f & 255).astype(np.uint8).tobytes())
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if a.ndim > 2 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def disk(h=120, w=160, r=20, at=(60, 70), base=200, dark=60):
    y, x = np.mgrid[:h, :w]
    return np.where((y - at[0]) ** 2 + (x - at[1]) ** 2 <= r * r, dark, base).astype(np.uint8)


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("survey") / "2024-01-01"
    root.mkdir()
    rng = np.random.default_rng(1)
    files = {"Background.tif": tiff(np.full((10, 10), 9, np.uint8), ((52, 30, 36), (4, 15, 0), "N", "W")), "HitsMisses.txt": b"900,100\n\n10,0\n", "bad.tif": b"text", "RawImages\\x.2024.1450+N00000001.tif": tiff(rng.integers(0, 60000, (480, 640), dtype=np.uint16), pack=8)}
    for k, (h, w) in enumerate([(500, 700), (300, 300), (601, 601), (100, 100)]):
        files[f"RawImages/x.2024.1450+N0000001{k}.png"] = png(rng.integers(0, 255, (h, w, 3) if k % 2 else (h, w), dtype=np.uint8), how=k)
    for stamp in ("1450", "1454"):
        with tarfile.open(root / f"run_{stamp}.tar", "w") as t:
            for name, data in files.items():
                info = tarfile.TarInfo(name)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    (root / "run_0000.tar").write_bytes(b"not a tar" * 100)
    return root.parent


def test_decoders():
    rng = np.random.default_rng(0)
    a16, rgb = rng.integers(0, 65535, (7, 9), dtype=np.uint16), rng.integers(0, 255, (6, 5, 3), dtype=np.uint8)
    assert (decode.decode(tiff(a16)) == a16).all() and (decode.decode(tiff(rgb, pack=8)) == rgb).all()
    for how in range(4):
        assert (decode.decode(png(rgb, how)) == rgb).all()
    assert decode.gps(tiff(a16, ((52, 30, 36), (4, 15, 0), "N", "W"))) == (pytest.approx(52.51), pytest.approx(-4.25))
    assert decode.gps(tiff(a16)) == (None, None) and decode.gps(tiff(a16, ((0, 0, 0), (0, 0, 0), "N", "E"))) == (None, None)
    for damaged in (tiff(a16)[:40], b"", png(rgb)[:-20] + b"x" * 20):
        with pytest.raises(ValueError):
            decode.decode(damaged)


def bmp(pixels: np.ndarray, masks: tuple | None = None) -> bytes:
    h, w = pixels.shape[:2]
    body = b"".join(bytes(pixels[y, :, [2, 1, 0, 3]].T.tobytes()) for y in range(h - 1, -1, -1))
    extra = struct.pack("<III", *masks) if masks else b""
    return b"BM" + struct.pack("<IHHI", 54 + len(extra) + len(body), 0, 0, 54 + len(extra)) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 32, 3 if masks else 0, len(body), 0, 0, 0, 0) + extra + body


def test_colour_masks_of_bitmaps():
    a = np.random.default_rng(0).integers(0, 255, (3, 5, 4), dtype=np.uint8)
    assert (decode.decode(bmp(a)) == a[:, :, :3]).all() and (decode.decode(bmp(a, (0xFF0000, 0xFF00, 0xFF))) == a[:, :, :3]).all()
    with pytest.raises(decode.Unsupported):
        decode.decode(bmp(a, (0xFF, 0xFF00, 0xFF0000)))


def test_lenient_and_strict_checks(spark):
    a = np.random.default_rng(0).integers(0, 255, (40, 50), dtype=np.uint8)
    whole, wrong = png(a), bytearray(png(a))
    at = wrong.index(b"IDAT") + 8
    wrong[at : at + 4] = b"\xff\xff\xff\xff"
    n = struct.unpack(">I", wrong[at - 12 : at - 8])[0]
    wrong[at - 4 + n : at + n] = struct.pack(">I", zlib.crc32(wrong[at - 8 : at - 4 + n]))  # sound chunks around unsound data
    files = {"a.png": whole, "b.png": whole[:-20], "c.png": bytes(wrong), "d.tif": tiff(a), "e.tif": tiff(a)[:60], "f.tif": b"text", "g.jpg": b"\xff\xd8\xff" + b"x" * 50 + b"\xff\xd9", "h.jpg": b"\xff\xd8\xff" + b"x" * 50, "i.webp": b"RIFF" + struct.pack("<I", 12) + b"WEBP" + b"x" * 8, "j.bmp": bmp(np.zeros((2, 2, 4), np.uint8)), "k.bmp": b"BM12", "l.png": None}
    rows = spark.createDataFrame([("t", k, n, bytearray(c) if c is not None else None) for k, (n, c) in enumerate(files.items())] + [("t", 99, "no.txt", None)], "tar_path string, member_idx int, name string, content binary")
    lenient, strict = ({r["name"] for r in tar.check_images(rows, s).collect() if r["corrupt"]} for s in (False, True))
    assert lenient == {"b.png", "e.tif", "f.tif", "h.jpg", "k.bmp", "l.png"} and strict == lenient | {"c.png"}


def test_archives_larger_than_a_value_are_streamed(spark, archive, tmp_path):
    data = (archive / "2024-01-01" / "run_1450.tar").read_bytes()
    (tmp_path / "a b.tar.gz").write_bytes(gzip.compress(data))
    (tmp_path / "run.tar").write_bytes(data)
    (tmp_path / "short.tar").write_bytes(data[: len(data) // 2])
    tars = tar.archives(spark, str(tmp_path))
    held = tars.collect()
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        got = tar.members(tars).collect()
        names = {r["tar_path"].split("/")[-1]: r["n_members"] for r in tar.manifest(tars).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    far = tar.members(spark.createDataFrame([("far:" + r["tar_path"], r["content"]) for r in held], "tar_path string, content binary")).collect()

    def told(rows):
        return sorted((r["tar_path"].removeprefix("far:"), r["member_idx"], r["name"] or "", r["size"] or 0, bytes(r["content"] or b"")) for r in rows)

    assert told(got) == told(far) and names["run.tar"] == names["a b.tar.gz"] == 7
    whole = {n: [r for r in got if r["tar_path"].endswith(n)] for n in ("a b.tar.gz", "run.tar", "short.tar")}
    assert len(whole["a b.tar.gz"]) == len(whole["run.tar"]) == 8 and all(r["error"] is None and len(r["content"]) == r["size"] for r in whole["run.tar"])
    assert whole["short.tar"][-1]["error"]


def test_scan(spark, archive):
    tars = tar.archives(spark, str(archive))
    m = tar.members(tars).cache()
    assert m.filter("error is not null").count() == 1
    assert sorted(r["n_members"] for r in tar.manifest(tars).collect()) == [7, 7]
    hits = stats.hits_and_misses(tar.hits_misses(m), "tar_path").collect()
    assert [(r["hits"], r["misses"]) for r in hits] == [(910, 100)] * 2
    assert {round(r["lat"], 2) for r in tar.positions(m).collect()} == {52.51}
    assert [r["timestamp"] for r in tar.survey_bins(tars.select("tar_path")).orderBy("timestamp").collect()] == ["0000", "1450"]
    images = tar.decode_images(m, min_size=(128, 128))
    got = images.collect()
    assert sum(r["error"] is not None for r in got) == 2 and sum(r["error"] is None for r in got) == 8
    assert {r["dtype"] for r in got if r["filename"].startswith("RawImages\\")} == {"uint16"}


def test_stores(spark, archive, tmp_path):
    images = tar.decode_images(tar.members(tar.archives(spark, str(archive))), min_size=(128, 128)).filter("error is null")
    bucketed = stats.truncate_buckets(stats.assign_buckets(images, 300), 100, "tar_path", "member_idx")
    out = sink.write_stores(bucketed, str(tmp_path), tile=300, levels=2)
    rows = {(r["bucket"], r["level"]): r for r in out.collect()}
    assert list(rows[("600x900", 0)]["shape"]) == [4, 600, 900] and list(rows[("600x900", 1)]["shape"]) == [4, 300, 450]
    meta = json.loads((tmp_path / "bucket_600x900.zarr/0/.zarray").read_text())
    assert meta["chunks"] == [1, 300, 300] and meta["dtype"] == "<u2"
    first = bucketed.filter("bucket = '600x900' and z = 0").first()
    a = np.frombuffer(first["pixels"], first["dtype"]).reshape(first["height"], first["width"])
    chunk = np.frombuffer(zlib.decompress((tmp_path / "bucket_600x900.zarr/0/0.0.0").read_bytes()), "<u2").reshape(300, 300)
    assert (chunk == a[:300, :300]).all()
    assert sum(1 for _ in (tmp_path / "bucket_600x900.zarr/0").glob("*.*.*")) == 4 * 2 * 3
    sink.zip_store(str(tmp_path / "bucket_600x900.zarr"), str(tmp_path / "s.zip"))
    assert not list(tmp_path.glob("*.tmp"))


def test_kernels():
    a = np.arange(24, dtype=np.uint8).reshape(4, 6)
    assert arrays.pad_to(a, 5, 7).shape == (5, 7) and arrays.harmonise(a, 3).shape == (4, 6, 3)
    with pytest.raises(ValueError):
        arrays.pad_to(a, 3, 7)
    assert [p.shape for p in arrays.pyramid(a, 3)] == [(4, 6), (2, 3), (1, 2)]
    assert arrays.gray(np.full((2, 2, 3), 7, np.uint8)).dtype == np.uint8


def test_regions():
    g = disk()
    labels = regions.segment(255 - g, 1.0)
    row, = regions.region_rows(labels, g, ring=10)
    assert row["area"] == pytest.approx(np.pi * 400, rel=0.05) and row["eccentricity"] < 0.15 and row["solidity"] > 0.95
    assert row["circularity"] == pytest.approx(1, abs=0.12) and row["bg_mean"] == 200 and row["local_bg"] == 200 and row["euler_number"] == 1
    two = np.minimum(disk(at=(60, 50)), disk(at=(60, 86)))
    assert regions.segment(255 - two, 1.0).max() == 2
    assert regions.segment(np.zeros((30, 30), np.uint8)).max() == 0
    hole = np.ones((9, 9), bool)
    hole[4, 4] = False
    assert regions.euler_number(hole) == 0


def test_objects_and_scores(spark):
    g = (255 - disk()).tobytes()
    df = spark.createDataFrame([("t", "a.tif", 120, 160, 1, 2, "uint8", bytearray(g)), ("t", "b.tif", None, None, None, None, None, None)], tar_schema())
    rows = objects.objects(df, sigma=1.0)
    assert rows.count() == 1
    out = objects.mlp_scores(rows, ["area", "solidity"], [(np.zeros((2, 1)), np.zeros(1), "sigmoid")], np.zeros(2), np.ones(2))
    assert out.first()["score"] == 0.5


def tar_schema():
    return "tar_path string, filename string, height int, width int, channels int, ndim int, dtype string, pixels binary"
