"""Member index, random access, splits and the data source, on archives made here."""

import io
import random
import tarfile
import time

import pytest
from pyspark.sql import functions as F

from driftscan.operators import sampling
from driftscan.sources import archives, tar
from driftscan.stores import open_file


def write(path, members, mode="w", fmt=tarfile.PAX_FORMAT, **more):
    with tarfile.open(path, mode, format=fmt, **more) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("archives")
    rng = random.Random(4)
    long = "d" * 90 + "/" + "n" * 150 + ".tif"  # takes a header of its own
    plain = [(f"RawImages/i{k:03}.tif", rng.randbytes(rng.randrange(3000))) for k in range(80)] + [(long, b"long"), ("ümlaut.tif", b"u"), ("RawImages\\back.tif", b"b"), ("empty.tif", b"")]
    write(root / "1000.tar", plain)
    write(root / "1010.tar", plain[:20], fmt=tarfile.GNU_FORMAT)
    write(root / "1020.tar.gz", plain[:30], "w:gz")
    write(root / "1030.tar.xz", plain[:10], "w:xz")
    write(root / "1040.tar", plain[:5], pax_headers={"comment": "all"})
    write(root / "1050.tar", [])
    good = (root / "1000.tar").read_bytes()
    (root / "1100.tar").write_bytes(good[:20_000])
    (root / "1110.tar.gz").write_bytes((root / "1020.tar.gz").read_bytes()[:9000])
    body = bytearray((root / "1020.tar.gz").read_bytes())
    body[4000:4100] = bytes(100)
    (root / "1120.tar.gz").write_bytes(body)
    body = bytearray((root / "1030.tar.xz").read_bytes())
    body[2000:2100] = bytes(100)
    (root / "1130.tar.xz").write_bytes(body)
    (root / "1140.tar").write_bytes(b"")
    return root, dict(plain), long


@pytest.fixture(scope="module")
def index(spark, folder):
    return archives.member_index(tar.archives(spark, str(folder[0]))).cache()


def test_index_tells_where_members_lie(index, folder):
    root, plain, long = folder
    rows = [r for r in index.collect() if r["tar_path"].endswith("1000.tar")]
    raw = (root / "1000.tar").read_bytes()
    assert [r["name"] for r in sorted(rows, key=lambda r: r["member_idx"])] == list(plain)
    assert all(raw[r["data_offset"] : r["data_offset"] + r["size"]] == plain[r["name"]] for r in rows)
    by = sorted(rows, key=lambda r: r["member_idx"])
    assert all(a["next_offset"] == b["offset"] for a, b in zip(by, by[1:], strict=False))
    assert next(r for r in rows if r["name"] == long)["data_offset"] - next(r for r in rows if r["name"] == long)["offset"] > 512
    packed = [r for r in index.collect() if r["tar_path"].endswith("1020.tar.gz")]
    assert len(packed) == 30 and all(r["offset"] is None and r["data_offset"] is None for r in packed)


def test_damaged_archives_are_rows_with_an_error(index):
    bad = {r["tar_path"][-11:]: r["error"] for r in index.filter("member_idx < 0").collect()}
    assert {k.rpartition("/")[2] for k in bad} == {"1100.tar", "1110.tar.gz", "1120.tar.gz", "1130.tar.xz"}  # Spark lists no file without bytes
    assert all(bad.values())
    assert index.filter(F.col("tar_path").endswith("/1100.tar") & (F.col("member_idx") >= 0)).count() > 3  # those before the damage stay


@pytest.mark.parametrize("size", [4096, 1 << 20])
def test_splits_give_every_member_once(spark, index, folder, size):
    pieces = archives.splits(index, size)
    whole = index.filter("member_idx >= 0").select("tar_path", "member_idx", "name", "size")
    got = archives.split_members(pieces, n_tasks=7)
    good = got.filter("error is null and tar_path not like '%/11%'")
    want = sorted(map(tuple, whole.filter("tar_path not like '%/11%'").collect()))
    assert sorted(map(tuple, good.select("tar_path", "member_idx", "name", "size").collect())) == want
    assert all(bytes(r["content"]) == folder[1][r["name"]] for r in good.collect())
    n = pieces.filter(F.col("tar_path").endswith("/1000.tar")).count()
    assert n > 10 if size == 4096 else n == 1
    assert pieces.filter(F.col("tar_path").endswith("/1040.tar") | F.col("tar_path").endswith(".gz")).filter("start is null").groupBy("tar_path").count().filter("count > 1").isEmpty()
    lean = archives.split_members(pieces, with_content=False)
    assert "content" not in lean.columns and lean.filter("error is null and tar_path not like '%/11%'").count() == len(want)


def test_fetch_by_name_whichever_separator(spark, index, folder):
    root, plain, _ = folder
    rows = [(f"{root}/1000.tar", "x\\i005.tif"), (f"{root}/1000.tar", "back.tif"), (f"{root}/1020.tar.gz", "RawImages/i007.tif"), (f"{root}/1020.tar.gz", "i003.tif"), (f"{root}/1020.tar.gz", "i003.tif"), (f"{root}/1040.tar", "i004.tif"), (f"{root}/1000.tar", "none.tif"), (f"{root}/gone.tar", "i001.tif"), (None, "i001.tif"), (f"{root}/1000.tar", None), (f"{root}/1000.tar", "empty.tif")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "tar_path string, id string, error string")
    got = archives.fetch(archives.locate(df, index)).collect()
    assert len(got) == len(rows)
    want = {"x\\i005.tif": "RawImages/i005.tif", "back.tif": "RawImages\\back.tif", "RawImages/i007.tif": "RawImages/i007.tif", "i003.tif": "RawImages/i003.tif", "i004.tif": "RawImages/i004.tif", "empty.tif": "empty.tif"}
    for r in got:
        if r["id"] in want:
            assert bytes(r["content"]) == plain[want[r["id"]]] and r["error"] is None
        else:
            assert r["content"] is None and r["error"] == "no such member"


def test_fetch_of_what_has_gone_since_is_an_error(spark, tmp_path):
    write(tmp_path / "a.tar", [("a.tif", b"1" * 2000), ("b.tif", b"2" * 2000)])
    found = archives.member_index(spark.createDataFrame([(str(tmp_path / "a.tar"),), (str(tmp_path / "a.tar"),)], "tar_path string").distinct()).collect()
    (tmp_path / "a.tar").write_bytes((tmp_path / "a.tar").read_bytes()[:3000])
    rows = spark.createDataFrame([tuple(r) for r in found], archives.INDEX).drop("error")
    got = {r["name"]: r for r in archives.fetch(rows).collect()}
    assert bytes(got["a.tif"]["content"]) == b"1" * 2000 and got["b.tif"]["error"] == "unexpected end of data"


class Counting:
    """A file that counts the bytes read from it."""

    total = 0

    def __init__(self, path):
        self.f = open(path, "rb", buffering=0)

    def read(self, n=-1):
        got = self.f.read(n)
        Counting.total += len(got)
        return got

    def __getattr__(self, name):
        return getattr(self.f, name)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.f.close()


def test_a_sample_of_a_large_sparse_archive_reads_little_of_it(spark, tmp_path):
    path, each, n = tmp_path / "large.tar", 10 << 20, 300
    with open(path, "wb") as f:
        for k in range(n):
            info = tarfile.TarInfo(f"RawImages/{k}.tif")
            info.size = each if k % 3 else 2000
            f.write(info.tobuf())
            f.write(f"image {k}".encode())
            f.seek(-(-info.size // 512) * 512 - len(f"image {k}".encode()), 1)
        f.truncate(f.tell() + 1024)
    size = path.stat().st_size
    assert size > 2_000_000_000
    Counting.total = 0
    index = list(archives.index_rows(str(path), Counting))
    assert len(index) == n and Counting.total < size / 1000
    # 100 members of 2 kB through the library, then the same bytes counted
    began = time.time()
    df = spark.createDataFrame([(str(path), f"{k}.tif") for k in range(0, n, 3)], "tar_path string, id string")
    got = archives.fetch(archives.locate(df, archives.member_index(df.select("tar_path").distinct()))).collect()
    assert len(got) == 100 and all(bytes(r["content"])[:20].startswith(b"image " + r["id"].split(".")[0].encode()) for r in got)
    assert time.time() - began < 60
    Counting.total = 0
    wanted = [(r[0], r[1], r[3], r[5]) for r in index if r[3] == 2000]
    assert all(len(x) == 2000 for x, _ in archives._ranges(iter(wanted), Counting))
    assert Counting.total < size / 100


def test_index_of_many_members_holds_one_at_a_time(tmp_path):
    write(tmp_path / "m.tar", ((f"{k}.tif", b"x") for k in range(500)))
    with open_file(str(tmp_path / "m.tar")) as f:
        assert max(len(t.members) for t, _ in archives.walk(f)) <= 2


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_data_source(spark, index, folder, tmp_path, prefix):
    root, plain, _ = folder
    archives.register(spark)
    got = spark.read.format("tar").load(f"{prefix}{root}")
    good = got.filter("error is null and tar_path not like '%/11%'")
    assert good.count() == len(plain) + 20 + 30 + 10 + 5
    assert all(bytes(r["content"]) == plain[r["name"]] for r in good.collect())
    assert got.filter("error is not null").count() == 5
    lean = spark.read.format("tar").schema("name string, size bigint").load(f"{prefix}{root}/1000.tar")
    assert lean.columns == ["name", "size"] and sorted(map(tuple, lean.collect())) == sorted((k, len(v)) for k, v in plain.items())
    at = f"{tmp_path}/splits"
    archives.splits(index, 4096).write.parquet(at)
    split = spark.read.format("tar").option("splits", prefix + at).load()
    assert split.rdd.getNumPartitions() > 30
    again = split.filter("error is null and tar_path not like '%/11%'").select("name", "member_idx", "content")
    assert sorted(map(str, again.collect())) == sorted(map(str, good.select("name", "member_idx", "content").collect()))
    with pytest.raises(Exception, match="no columns"):
        spark.read.format("tar").schema("other string").load(f"{root}/1000.tar").collect()


def test_stores_that_cannot_be_opened_are_rows_with_an_error(spark):
    rows = spark.createDataFrame([("nowhere://x/a.tar",), ("/none/a.tar",), ("relative.tar",)], "tar_path string")
    got = archives.member_index(rows).collect()
    assert len(got) == 3 and all(r["error"] and r["member_idx"] == -1 for r in got)


def test_class_samples_are_fetched_from_archives(spark, index, folder):
    """The way from predictions to sampled images: drawn by class, located, fetched."""
    root, plain, _ = folder
    rows = [(f"{root}/1000.tar", f"/tmp/x/RawImages/i{k:03}.tif", k % 3) for k in range(80)]
    preds = spark.createDataFrame(rows, "tar_path string, id string, pred_id int")
    drawn = sampling.per_class(preds, "pred_id", "id", 5)
    got = archives.fetch(archives.locate(drawn, index)).collect()
    assert len(got) == 15 and all(bytes(r["content"]) == plain["RawImages/" + r["id"].rpartition("/")[2]] for r in got)


def test_small_pieces_are_read_together():
    pieces = [(f"/a/{k % 7}.tar", k // 7 * 1000, k // 7 * 1000 + 1000, k // 7) for k in range(7000)] + [("/a/z.tar.gz", None, None, 0)]
    lists = archives.together(pieces, 50)
    assert 50 <= len(lists) <= 102
    assert sorted(x for part in lists for x in part[:] if x[1] is not None) == sorted(pieces[:-1]) and lists[-1] == pieces[-1:]
    assert all(part == sorted(part) for part in lists)
    assert len(archives.together(pieces, 50, most_bytes=2000)) == 3501
    assert archives.together([], 50) == []


def test_members_of_many_small_pieces(spark, index, tmp_path):
    archives.register(spark)
    at = f"{tmp_path}/splits"
    archives.splits(index, 1024).write.parquet(at)
    got = spark.read.format("tar").option("splits", at).option("tasks", 3).load()
    one = spark.read.format("tar").option("splits", at).option("tasks", 1 << 30).load()
    assert got.rdd.getNumPartitions() < 12 < one.rdd.getNumPartitions()
    rows = lambda d: sorted((r["tar_path"], r["member_idx"], r["name"], bytes(r["content"] or b"")) for r in d.collect())
    assert rows(got) == rows(one)
