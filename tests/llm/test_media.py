import hashlib
import io
import zlib

import numpy as np
import pytest

from driftscan.llm import media


def test_round_trips():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (7, 5, 3), dtype=np.uint8)
    assert (media.decode(media.encode_ppm(a)) == a).all() and (media.decode(media.encode_bmp(a)) == a).all()
    g = a[:, :, :1]
    assert (media.decode(media.encode_ppm(g)) == g).all()


def test_netpbm_forms():
    assert media.decode(b"P1 # c\n3 2\n1 0 1\n010")[:, :, 0].tolist() == [[0, 255, 0], [255, 0, 255]]
    assert media.decode(b"P4\n9 1\n" + bytes([0b10101010, 0b10000000]))[0, :, 0].tolist() == [0, 255] * 4 + [0]
    assert media.decode(b"P2\n2 1\n#x\n255\n7 9\n")[0, :, 0].tolist() == [7, 9]
    assert media.decode(b"P5 2 1 65535\n" + (300).to_bytes(2, "big") + (5).to_bytes(2, "big")).tolist() == [[[300], [5]]]
    for damaged in (b"P6\n2 2\n255\nxx", b"P9", b"", b"BM" + b"\0" * 60, b"P5\n0 1\n255\n", b"P5\n99999999999 99999999999\n255\n", b"P2\n1 1\n255\n70000", b"P2\n1 1\n255\n-9 ", b"P2\n1 1\n255\nx", b"P1\n2 1\nab", b"P3\n9 9\n255\n1 2"):
        with pytest.raises((ValueError, IndexError)):
            media.decode(damaged)


def test_area_resize_is_the_exact_mean():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (12, 18, 1), dtype=np.uint8)
    assert np.allclose(media.area_resize(a, 4, 6), a.reshape(4, 3, 6, 3, 1).mean(axis=(1, 3)))
    fine = np.repeat(np.repeat(a.astype(float), 5, 0), 7, 1)
    assert np.allclose(media.area_resize(a, 5, 7), fine.reshape(5, 12, 7, 18, 1).mean(axis=(1, 3)))
    assert media.area_resize(a[:1, :1], 3, 3).shape == (3, 3, 1)


def test_digest_query(spark):
    texts = [None, "", "short", "x" * 192, "ü" * 100, "y" * 5000, "short", "\x00é" * 3000]
    df = spark.createDataFrame([(k, t, "f") for k, t in enumerate(texts)] + [(None, "short", "f")], "doc_id bigint, text string, feature string").repartition(2)
    got = {r["doc_id"]: r for r in media.text_media_digest(df).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        pay = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        r = got[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(pay), hashlib.sha256(pay).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(pay[-16:])
        stored = media.text_to_media(pay)
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert media.decode(stored).tobytes() == pay
    assert got[2]["feature"] == got[6]["feature"] == got[None]["feature"]
    assert media.text_media_digest(df.limit(0)).count() == 0


def test_media_features(spark):
    a = np.arange(300 * 10 * 3, dtype=np.uint32).astype(np.uint8).reshape(300, 10, 3)
    rows = [(1, bytearray(media.encode_bmp(a)), "x"), (2, None, "x"), (3, bytearray(b"junk"), "x"), (3, bytearray(b"junk"), "x")]
    got = media.media_features(spark.createDataFrame(rows, "id int, media binary, error string"), keep_samples=True).orderBy("id").collect()
    f = got[0]["features"]
    assert (f["height"], f["width"], f["channels"], bytes(f["samples"])) == (300, 10, 3, a.tobytes())
    back = np.concatenate([np.load(io.BytesIO(bytes(t["npy"]))) for t in f["tiles"]])
    assert (back == a).all() and np.load(io.BytesIO(bytes(f["thumbnail"]))).shape == (16, 16, 3)
    assert [bool(r["features"]["error"]) for r in got] == [False, True, True, True]


def test_damaged_files_are_rows(spark):
    bad = [b"P5\n99999999999 99999999999\n255\n", b"P2 1 1 255 70000", b"P2 1 1 255 -9", b"BM" + b"\xff" * 80, b"P6\n4000000000 4000000000\n255\n", b""]
    rows = [(k, bytearray(x)) for k, x in enumerate(bad)] + [(9, None)]
    df = spark.createDataFrame(rows, "id int, media binary")
    got = media.media_features(df).select("features.error", "features.height").collect()
    assert len(got) == len(rows) and all(r["error"] and r["height"] is None for r in got)
    with pytest.raises(ValueError):
        media.media_features(df.withColumnRenamed("id", "features"))


def test_hash_and_thumbnail_against_loops():
    def cell(a, y0, y1, x0, x1):
        total = 0.0
        for y in range(int(y0), min(a.shape[0], int(np.ceil(y1)))):
            for x in range(int(x0), min(a.shape[1], int(np.ceil(x1)))):
                total += a[y, x].astype(float).mean() * (min(y1, y + 1) - max(y0, y)) * (min(x1, x + 1) - max(x0, x))
        return total / ((y1 - y0) * (x1 - x0))

    rng = np.random.default_rng(2)
    for shape in ((1, 64, 3), (21, 64, 3), (8, 9, 3)):
        a = rng.integers(0, 256, shape, dtype=np.uint8)
        h, w = shape[0] / 8, shape[1] / 9
        grey = np.array([[round(cell(a, y * h, (y + 1) * h, x * w, (x + 1) * w), 6) for x in range(9)] for y in range(8)])
        assert media.difference_hash(a) == np.packbits(grey[:, :-1] < grey[:, 1:]).tobytes().hex()
    big = rng.integers(0, 256, (9001, 5, 1), dtype=np.uint8)
    whole = np.vstack([np.zeros((1, 5)), np.cumsum(big[:, :, 0], axis=0, dtype=float)]).cumsum(axis=1)
    rows = np.array([0, 1, 4096, 4097, 9001])
    assert (media.integral_rows(big, rows)[:, 1:, 0] == whole[rows]).all()
