"""Runs over small surveys made here: configuration, stages that resume, classification, samples, counters."""

import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_images import disk, png, tiff

from driftscan import config
from driftscan.operators import counters, inference
from driftscan.plans import survey
from driftscan.sinks import folders
from driftscan.sources import archives, predictions, tar


def pack(path, files):
    path.parent.mkdir(exist_ok=True, parents=True)
    with tarfile.open(path, "w") as t:
        for name, data in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    root = tmp_path_factory.mktemp("run") / "source"
    for day, stamps in (("2024-01-01", ("1450", "1500", "1507")), ("2024-01-02", ("0000",))):
        for stamp in stamps:
            files = {"Background.tif": tiff(np.full((10, 10), 9, np.uint8), ((52, 30, 36), (4, 15, 0), "N", "W")), "HitsMisses.txt": b"80,20\n", "RawImages/bad.png": png(disk())[:-30]}
            for k in range(6):
                files[f"RawImages/x.{stamp}.{k}.png"] = png(np.full((40 + k, 60), 30 * k, np.uint8))
            pack(root / day / f"cruise_{stamp}.tar", files)
    return root


def bright_or_dark():
    """A loader of a model of two classes, dark and bright; images of one certain brightness make every batch they are in fail."""

    def load():
        def model(x):
            bright = x[:, 0].max(axis=(1, 2))
            if (np.abs(bright - (90 / 255 - 0.485) / 0.229) < 1e-3).any():
                raise RuntimeError("no such image before")
            p = np.clip(bright / 4 + 0.5, 0, 1)
            return np.stack([1 - p, p], 1)

        return model

    return load  # a function within a function goes to the workers by value


load_model = bright_or_dark()


def test_pad_resize_keeps_shape_and_means():
    a = np.zeros((20, 40, 3), np.uint8)
    a[:, 20:] = 200
    out = inference.pad_resize(a, 10)
    assert out.shape == (10, 10, 3) and (out[:2] == 0).all() and (out[8:] == 0).all()
    assert out[2:7].mean() == pytest.approx(100, abs=1) and out[4, 0, 0] == 0 and out[4, 9, 0] == pytest.approx(200)
    assert inference.pad_resize(np.full((1, 500), 7, np.uint8), 10)[:, :, 0].max() == pytest.approx(7)
    t = inference.tensor(np.full((5, 5), 255, np.uint8), 8)
    assert t.shape == (3, 8, 8) and t.dtype == np.float32 and t[0, 4, 4] == pytest.approx((1 - 0.485) / 0.229)
    assert inference.tensor(np.full((5, 5), 65535, np.uint16), 8)[1, 4, 4] == pytest.approx((1 - 0.456) / 0.224)


def test_a_failing_batch_loses_only_its_bad_rows():
    calls = []

    def model(x):
        calls.append(len(x))
        if (x == 13).any():
            raise ValueError("thirteen")
        return np.stack([x.ravel(), np.where(x.ravel() == 7, np.nan, 1)], 1)

    batch = [np.full((1,), k, np.float32) for k in range(20)]
    got = inference.predict(model, batch, 2)
    assert [k for k, (p, e) in enumerate(got) if e] == [7, 13]
    assert "thirteen" in got[13][1] and "finite" in got[7][1] and all(p[0] == k for k, (p, e) in enumerate(got) if not e)
    assert len(calls) < 25 and inference.predict(model, [], 2) == []
    assert all("classes" in e for _, e in inference.predict(model, batch[:3], 5))


def test_classify_sets_damaged_images_aside(spark):
    rows = [("a", 2, 3, 1, 2, "uint8", bytearray(b"\x05" * 6), None), ("b", 2, 3, 1, 2, "uint8", bytearray(b"\x05" * 5), None), ("c", 2, 2, 1, 2, "uint8", bytearray(b"\x5a" * 4), None), ("d", None, None, None, None, None, None, "damaged"), ("e", 0, 3, 1, 2, "uint8", bytearray(), None), ("f", 2, 2, 3, 3, "uint8", bytearray(b"\xff" * 12), None), ("g", 2, 2, 1, 2, "odd", bytearray(b"\xff" * 4), None)]
    df = spark.createDataFrame(rows, "filename string, height int, width int, channels int, ndim int, dtype string, pixels binary, error string").coalesce(1)
    got = {r["filename"]: r for r in inference.classify(df, load_model, 2, 16, 4).collect()}
    assert {k for k, r in got.items() if r["error"] is None} == {"a", "f"} and all(got[k]["probs"] is None for k in "bcdeg")
    assert got["d"]["error"] == "damaged" and "no such image" in got["c"]["error"] and got["f"]["probs"][1] > got["a"]["probs"][1]
    assert "pixels" not in inference.classify(df, load_model, 2).columns and inference.classify(df.limit(0).drop("error"), load_model, 2).count() == 0


def test_buckets_are_processed_batch_by_batch(spark):
    import pyarrow as pa

    def process(bucket, batches):
        total = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.string()), pa.array([total])], ["bucket", "n"])

    df = spark.range(5000).select(F.when(F.col("id") < 4000, "big").when(F.col("id") < 4990, "small").alias("bucket"), "id")
    got = {r["bucket"]: r["n"] for r in inference.process_buckets(df, process, "bucket string, n long").collect()}
    assert got == {"big": 4000, "small": 990, None: 10}


@pytest.mark.parametrize("subsample", [100, 50])
def test_classify_survey(spark, source, tmp_path, subsample):
    out = str(tmp_path / "out")
    bad = survey.classify_survey(spark, str(source), load_model, ["dark", "bright"], "cruise", out, subsample, size=32, batch_size=4).collect()
    assert {r["filename"].rpartition("/")[2] for r in bad} <= {"bad.png", *(f"x.{s}.3.png" for s in ("1450", "1500", "0000"))}
    rows = predictions.read_detail(spark, [f"{out}/raw"]).collect()
    assert {(str(r["date"]), r["time"]) for r in rows} == {("2024-01-01", "14:50"), ("2024-01-01", "15:00"), ("2024-01-02", "00:00")}  # 15:07 ends no bin
    per = 8 * subsample // 100  # of seven images and the background
    if subsample == 100:
        assert len(rows) == 3 * 5 and len(bad) == 3 * 2
    else:
        assert len(rows) + len(bad) == 3 * per
    r = next(r for r in rows if r["pred_label"] == "dark")
    same = [q for q in rows if (q["tar_path"], q["pred_label"]) == (r["tar_path"], "dark")]
    assert float(r["total_counts"]) == len(same) and r["density"] == pytest.approx(len(same) / 0.8 / 340) and (round(r["lat"], 2), r["lon"]) == (52.51, pytest.approx(-4.25))
    assert r["dark_conf"] + r["bright_conf"] == pytest.approx(1, abs=1e-6) and r["pred_conf"] == pytest.approx(max(r["dark_conf"], r["bright_conf"]))
    summary = predictions.read_detail(spark, [f"{out}/processed"]).collect()
    assert sum(float(s["total_counts"]) for s in summary) == len(rows) and all(s["density"] == round(s["density"], 2) for s in summary)
    assert survey.classify_survey(spark, str(source), load_model, ["dark", "bright"], "cruise", out, subsample, size=32).collect() == []  # nothing is left to do
    assert len(predictions.read_detail(spark, [f"{out}/raw"]).collect()) == len(rows)


@pytest.fixture(scope="module")
def images(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for k in range(3):
        pack(root / f"{k}.tar", {"a.png": png(disk(r=20 + k)), "bubble.png": png(255 - disk(r=20 + k)), "b.tif": tiff(np.full((310, 200), 5, np.uint16)), "broken.tif": b"no", "small.png": png(np.zeros((20, 20), np.uint8)), "note.txt": b"x"})
    return root


def configured(root, out, **more):
    base = {"stream": {"tar_paths": [str(root)], "min_size": [100, 100]}, "zarr_writer": {"output_dir": f"{out}/zarr"}, "ome_converter": {"output_dir": f"{out}/ome", "pyramid_levels": 2}, "rule_filter": {"spot_sigma": 1.0}}
    return config.from_dict(base | more)


def test_preprocess_resumes_from_written_stages(spark, images, tmp_path, monkeypatch):
    c = configured(images, tmp_path / "o")
    got = survey.preprocess(spark, c, str(tmp_path / "work")).collect()
    assert {(r["kind"], r["bucket"], r["level"]) for r in got} == {("arrays", "300x300", 0), ("arrays", "600x300", 0), *(("multiscale", b, k) for b in ("300x300", "600x300") for k in (0, 1))}
    assert {r["compression"] for r in got} == {"zstd_clevel5_shuffle"}
    meta = json.loads((tmp_path / "o/ome/bucket_600x300.zarr/1/.zarray").read_text())
    assert meta["shape"] == [3, 300, 150] and meta["compressor"]["id"] == "zstd"
    told = {r["stage"]: (r["passed"], r["rejected"], r["errors"], r["total"]) for r in spark.read.json(str(tmp_path / "work/counts")).collect()}
    assert told == {"read": (9, 0, 3, 12), "filter": (6, 3, 0, 9)}
    # a second run reads no archive
    monkeypatch.setattr(survey.archives, "member_index", lambda *_: pytest.fail("archives were read again"))
    monkeypatch.setattr(survey.archives, "split_members", lambda *_: pytest.fail("archives were read again"))
    assert survey.preprocess(spark, c, str(tmp_path / "work"), skip_arrays=True).count() == 2
    # another grid makes its own groups from the same images
    other = configured(images, tmp_path / "o", grouper={"tile_size": 100})
    assert {r["bucket"] for r in survey.preprocess(spark, other, str(tmp_path / "work"), skip_filter=True, skip_arrays=True).collect()} == {"200x200", "400x200"}


def test_an_autoencoders_score_decides_where_there_are_weights(spark, images, tmp_path):
    """Weights that call images with large objects artefacts."""
    at = str(tmp_path / "w.npz")
    np.savez(at, features=["area", "solidity", "object_count"], mean=np.zeros(3), std=np.ones(3), w0=np.array([[1.0], [0], [0]]), b0=np.array([-3000.0]), act0="linear", w1=np.array([[1.0]]), b1=np.array([0.0]), act1="sigmoid")
    c = configured(images, tmp_path / "o", filter={"checkpoint_path": at, "threshold": 0.5, "spot_sigma": 1.0})
    got = survey.filter_images(survey.Stages(spark, str(tmp_path / "w")), c).collect()
    assert {r["filename"]: r["is_bubble"] for r in got} == {"a.png": True, "bubble.png": False, "b.tif": False}
    assert all((r["bubble_score"] >= 0.5) == r["is_bubble"] for r in got)
    with pytest.raises(ValueError):
        survey.filter_images(survey.Stages(spark, str(tmp_path / "w")), configured(images, tmp_path / "o", filter={"checkpoint_path": "models/x.pth"}))


def test_max_images_is_exact_and_in_archive_order(spark, images, tmp_path):
    c = configured(images, tmp_path / "o", stream={"tar_paths": [str(images)], "min_size": [100, 100], "max_images": 4})
    got = survey.read_images(survey.Stages(spark, str(tmp_path / "w")), c).filter("error is null").collect()
    assert sorted((r["tar_path"].rpartition("/")[2], r["filename"]) for r in got) == [("0.tar", "a.png"), ("0.tar", "b.tif"), ("0.tar", "bubble.png"), ("1.tar", "a.png")]


def test_configuration(tmp_path):
    (tmp_path / "c.yaml").write_text('stream:\n  tar_paths: ["C:\\\\data\\\\a.tar", "/x/b.tar"]\n  max_images: null\n  output_format: numpy\nconcurrency:\n  enabled: true\ngrouper:\n  snap_mode: floor\nzarr_writer:\n  output_dir: D:/out\n  compression_codec: blosc_lz4\n  shuffle: noshuffle\n  dimension_separator: "/"\n')
    c = config.load_config(str(tmp_path / "c.yaml"))
    assert c.stream.tar_paths == ("/mnt/c/data/a.tar", "/x/b.tar") and c.grouper.snap_mode == "floor" and c.zarr_writer.output_dir == "/mnt/d/out"
    assert c.zarr_writer.codec().label() == "lz4_clevel5_noshuffle" and c.rule_filter.rules().od == 0.02
    assert config.from_dict(None) == config.Config() and config.from_dict({"grouper": None}) == config.Config()
    for wrong in ({"streams": {}}, {"stream": {"tar_path": "x"}}, {"concurrency": {"workers": 1}}, {"grouper": {"snap_mode": "up"}}, {"filter": {"threshold": 2}}):
        with pytest.raises(ValueError):
            config.from_dict(wrong)
    with pytest.raises(ValueError):
        config.ArrayStore(compression_codec="gif").codec()


def test_sample_folders(spark, source, tmp_path):
    index = archives.member_index(tar.archives(spark, str(source)))
    at = str(source / "2024-01-01/cruise_1450.tar")
    other = str(source / "2024-01-01/cruise_1500.tar")
    rows = [(at, f"/tmp/z/RawImages/x.1450.{k}.png", k % 2, ["od/d", None][k % 2]) for k in range(6)] + [(other, "RawImages\\x.1500.1.png", 5, "five"), (at, "RawImages/none.png", 5, "five"), (at, "Background.tif", 5, "five")]
    # two archives with an image of one name each
    pack(tmp_path / "more_1450.tar", {"RawImages/x.1500.1.png": b"other"})
    rows.append((str(tmp_path / "more_1450.tar"), "x.1500.1.png", 5, "five"))
    index = index.unionByName(archives.member_index(spark.createDataFrame([(str(tmp_path / "more_1450.tar"),)], "tar_path string")))
    preds = spark.createDataFrame(rows, "tar_path string, id string, pred_id int, pred_label string")
    out = tmp_path / "samples"
    bad = folders.sample_folders(preds, index, str(out), 2).collect()
    assert [(r["id"], r["error"]) for r in bad] == [("RawImages/none.png", "no such member")] or bad == []
    bad = folders.sample_folders(preds, index, str(tmp_path / "all"), 100).collect()
    assert [r["id"] for r in bad] == ["RawImages/none.png"]
    held = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "all").iterdir()}
    assert held == {"0_od_d": [f"x.1450.{k}.png" for k in (0, 2, 4)], "1_unknown": [f"x.1450.{k}.png" for k in (1, 3, 5)], "5_five": ["1_x.1500.1.png", "x.1500.1.png"]}
    assert (tmp_path / "all/0_od_d/x.1450.2.png").read_bytes() == png(np.full((42, 60), 60, np.uint8))
    assert all(len(list(p.iterdir())) <= 2 for p in out.iterdir())
    # a folder that is there is left as it is
    (tmp_path / "all/5_five/x.1500.1.png").unlink()
    folders.sample_folders(preds, index, str(tmp_path / "all"), 100)
    assert sorted(f.name for f in (tmp_path / "all/5_five").iterdir()) == ["1_x.1500.1.png"] and not list((tmp_path / "all").glob(".*"))


def test_counters_and_error_table(spark, tmp_path):
    df = spark.createDataFrame([(1, True, None, bytearray(b"x")), (2, False, None, None), (3, None, None, None), (4, True, "bad", None), (5, False, "bad", None)], "id int, good boolean, error string, pixels binary")
    seen_rows, seen = counters.observed(df, "n", F.col("good"), group="id")
    seen_rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"passed": 1, "rejected": 2, "errors": 2, "total": 5, "groups": 5}
    path = str(tmp_path / "errors")
    good, n = counters.separate_errors(df, path, "read", "m", F.col("good"))
    assert [r["id"] for r in good.collect()] == [1] and n["total"] == 5
    counters.separate_errors(df.filter("error is null"), path, "filter", "o")
    told = counters.error_table(spark, path).collect()
    assert sorted(json.loads(r["row"])["id"] for r in told) == [4, 5] and {r["stage"] for r in told} == {"read"} and "pixels" not in told[0]["row"]
    assert counters.counts(df.drop("error"), F.col("good")).first().asDict() == {"passed": 2, "rejected": 3, "errors": 0, "total": 5}


def test_headers_by_one_job(spark, tmp_path):
    import gzip

    for k in range(40):
        (tmp_path / f"f{k}.csv").write_text(("id,date,time,a_conf\n" if k % 2 else "id,a_conf,b_conf,date,time\n") + (f"r{k},2024-01-02,00:00,0.5\n" if k % 2 else f"r{k},0.25,inf,2024-01-02,10:10\n"))
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"\xef\xbb\xbfid,a_conf\r\nr99,1\r\n"))
    (tmp_path / "bad.csv.gz").write_bytes(b"\x1f\x8bnot gzip")
    (tmp_path / "odd[1].csv").write_text("id,a_conf\nr77,2\n")
    (tmp_path / "empty.csv").write_text("")
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    found = {r["path"].rpartition("/")[2]: r for r in predictions.csv_headers(spark, str(tmp_path)).collect()}
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before < 5
    assert found["z.csv.gz"]["header"] == ["id", "a_conf"] and found["bad.csv.gz"]["error"] and "empty.csv" not in found
    rows = {r["id"]: r for r in predictions.read_detail(spark, [str(tmp_path)]).collect()}
    assert len(rows) == 42 and rows["r2"]["b_conf"] == float("inf") and rows["r1"]["b_conf"] is None and rows["r77"]["a_conf"] == 2 and rows["r99"]["a_conf"] == 1
    assert str(rows["r1"]["datetime"]) == "2024-01-02 00:00:00"
    assert len(predictions.read_detail(spark, [str(tmp_path)], classes=["x"] * 5).collect()) == 20
    vocabulary = {r["name"]: r["n_files"] for r in predictions.vocabulary(predictions.csv_headers(spark, str(tmp_path)), ("id",)).collect()}
    assert vocabulary == {"a_conf": 42, "b_conf": 20, "date": 40, "time": 40}
    with pytest.raises(ValueError):
        predictions.read_detail(spark, [str(tmp_path / "f1.csv")], classes=["x"] * 9)


def test_truth_and_models(spark, tmp_path):
    (tmp_path / "truth.csv").write_text("Filename,Subdirectory,Note\na.tif,Copepod,1\nb.tif,Detritus,\n")
    assert {r["filename"]: r["label"] for r in predictions.read_truth(spark, str(tmp_path / "truth.csv")).collect()} == {"a.tif": "Copepod", "b.tif": "Detritus"}
    for m, columns in (("one", "x,y"), ("two", "y,z")):
        (tmp_path / f"P_{m}_Preds.csv").write_text(f"Path,Filename,Label,Pred,{columns}\n/p,a.tif,x,y,0.25,0.75\n")
    rows, classes = predictions.read_models(spark, str(tmp_path / "P_one_Preds.csv"), str(tmp_path / "P_two_Preds.csv"), prefix="P_", suffix="_Preds.csv")
    assert classes == ["x", "y", "z"]
    assert {r["model"]: (r["x"], r["y"], r["z"]) for r in rows.collect()} == {"one": (0.25, 0.75, None), "two": (None, 0.25, 0.75)}


@pytest.fixture
def own_settings(spark):
    """What the command line sets in a session is undone after a test."""
    from driftscan.session import SETTINGS

    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def told(capsys):
    return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]


def test_command_line(spark, images, tmp_path, capsys, own_settings):
    from driftscan import cli

    (tmp_path / "c.yaml").write_text(json.dumps({"stream": {"tar_paths": [str(images)], "min_size": [100, 100]}, "rule_filter": {"spot_sigma": 1.0}, "zarr_writer": {"output_dir": f"{tmp_path}/zarr"}, "ome_converter": {"output_dir": f"{tmp_path}/ome", "pyramid_levels": 2}}))
    given = ["--config", str(tmp_path / "c.yaml"), "--work", str(tmp_path / "work")]
    cli.main(["stage", "stream", *given])
    assert told(capsys)[0]["passed"] == 9
    cli.main(["stage", "filter", *given])
    assert {r["stage"]: r["rejected"] for r in told(capsys)} == {"read": 0, "filter": 3}
    cli.main(["stage", "group", *given])
    assert {r["bucket"]: r["count"] for r in told(capsys)} == {"300x300": 3, "600x300": 3}
    cli.main(["stage", "arrays", *given])
    assert len(told(capsys)) == 6
    cli.main(["pipeline", *given, "--skip-filter", "--skip-zarr"])
    assert {r["bucket"]: r["count"] for r in told(capsys)} == {"300x300": 6, "600x300": 3}
    cli.main(["tar", str(images), "--max-images", "3", "--min-width", "300", "--min-height", "1"])
    assert [r["error"] is None for r in told(capsys)] == [False, False, False]  # none is so wide
    cli.main(["tar", str(images), "--manifest-only"])
    assert {len(r["names"]) for r in told(capsys)} == {5}
    cli.main(["export", *given, "--out", str(tmp_path / "export"), "--cruise_name", "c"])
    assert [(r["date"], r["n_images"]) for r in told(capsys)] == [("1970-01-01", 6)]
    cli.main(["validate", str(tmp_path / "export")])
    assert told(capsys) == []
    with pytest.raises(SystemExit):
        cli.main(["tar"])


def test_command_line_of_classification(spark, source, tmp_path, capsys, monkeypatch, own_settings):
    from driftscan import cli

    monkeypatch.setattr(cli, "_loader", lambda name: load_model)
    cli.main(["classify", "--source_dir", str(source), "--model", "m:f", "--classes", "dark,bright", "--cruise_name", "c", "--out", str(tmp_path / "out")])
    assert len(told(capsys)) == 6
    cli.main(["report", str(tmp_path / "out/raw")])
    got = told(capsys)
    assert got[0]["n_rows"] == 15 and {r["pred_label"] for r in got[1:3]} == {"dark", "bright"}
    cli.main(["samples", str(tmp_path / "out/raw"), "--tars", str(source), "--out", str(tmp_path / "samples"), "-n", "2"])
    assert told(capsys) == [] and sorted(len(list(p.iterdir())) for p in (tmp_path / "samples").iterdir()) == [2, 2]
