"""Command line: `python -m driftscan.cli COMMAND ...`."""

from __future__ import annotations

import argparse
import dataclasses
import importlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame

from driftscan.config import Config, Stream, load_config, mounted
from driftscan.operators import stats
from driftscan.session import get_session
from driftscan.sources import archives, predictions, tar

#: The stages of pre-processing in order; each works from the written tables of those before it.
STAGES = ("stream", "filter", "group", "arrays")


def _tell(rows: DataFrame) -> None:
    for r in rows.toLocalIterator():
        print(json.dumps(r.asDict(recursive=True), default=str))


def _configured(a) -> Config:
    """The configuration file, or the defaults, with what the command line says instead."""
    c = load_config(a.config) if a.config else Config()
    own = {"tar_paths": tuple(mounted(t) for t in a.tars) or None, "max_images": a.max_images, "convert_mode": a.mode}
    sizes = {"min_size": (a.min_width, a.min_height), "max_size": (a.max_width, a.max_height)}
    given = {k: v for k, v in own.items() if v is not None} | {k: tuple(x if x is not None else y for x, y in zip(v, getattr(c.stream, k), strict=True)) for k, v in sizes.items()}
    c = dataclasses.replace(c, stream=dataclasses.replace(c.stream, **given))
    if not c.stream.tar_paths:
        raise SystemExit("no archives: name a configuration or paths")
    return c


def _pipeline(a) -> None:
    from driftscan.plans import survey

    _tell(survey.preprocess(get_session(), _configured(a), a.work, a.skip_filter, a.skip_zarr))


def _stage(a) -> None:
    from driftscan.plans import survey

    stages, c = survey.Stages(get_session(), a.work), _configured(a)
    if a.stage == "stream":
        survey.read_images(stages, c)
        _tell(survey.run_counts(stages, c, skip_filter=True))
    elif a.stage == "filter":
        _tell(survey.run_counts(stages, c))
    elif a.stage == "group":
        _tell(stats.bucket_stats(survey.group_images(stages, c, a.skip_filter)))
    else:
        _tell(survey.write_arrays(stages, c, a.skip_filter))


def _tar(a) -> None:
    spark, c = get_session(), _configured(a)
    if a.manifest_only:
        _tell(tar.manifest(tar.archives(spark, *c.stream.tar_paths)))
        return
    s: Stream = c.stream
    images = tar.decode_images(tar.members(tar.archives(spark, *s.tar_paths), only_images=True), s.convert_mode, s.min_size, s.max_size, full=False).drop("pixels")
    _tell(images.orderBy("tar_path", "member_idx") if s.max_images is None else images.orderBy("tar_path", "member_idx").limit(s.max_images))


def _loader(name: str) -> Callable:
    """The function that loads a model, named as module:function."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _classify(a) -> None:
    from driftscan.plans import survey

    _tell(survey.classify_survey(get_session(), mounted(a.source_dir), _loader(a.model), a.classes.split(","), a.cruise_name, mounted(a.out), a.classification_subsample, a.density_constant, a.batch_size))


def _samples(a) -> None:
    from driftscan.sinks import folders

    spark = get_session()
    rows = predictions.read_detail(spark, a.csv)
    index = archives.member_index(tar.archives(spark, *a.tars))
    _tell(folders.sample_folders(rows, index, mounted(a.out), a.n))


def _export(a) -> None:
    from driftscan.plans import survey
    from driftscan.sinks import exports

    stages, c = survey.Stages(get_session(), a.work), _configured(a)
    kept = survey.filter_images(stages, c).filter("not is_bubble")
    where = archives.locate(kept.select("tar_path", "filename", "bubble_score", "object_count"), stages.table("index", c.stream.tar_paths, lambda: archives.member_index(tar.archives(stages.spark, *c.stream.tar_paths).select("tar_path"))), "filename")
    exports.export_archives(where, mounted(a.out), a.cruise_name, a.bin_minutes, a.max_bubble_score, a.min_object_count)
    _tell(exports.manifest(stages.spark, mounted(a.out)))


def _validate(a) -> None:
    from driftscan.sinks import exports

    _tell(exports.validate(get_session(), mounted(a.out)))


def _report(a) -> None:
    rows = predictions.read_detail(get_session(), a.csv)
    _tell(stats.extent(rows, "datetime"))
    _tell(stats.class_statistics(rows).orderBy("pred_label"))
    _tell(stats.track_bounds(rows))
    unit, counts = stats.survey_coverage(rows, "datetime")
    _tell(counts.orderBy("unit_start").withColumnRenamed("unit_start", unit))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="driftscan")
    sub = p.add_subparsers(required=True)

    def command(name: str, run: Callable, about: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=about)
        c.set_defaults(run=run)
        return c

    def stream(c: argparse.ArgumentParser) -> None:
        c.add_argument("tars", nargs="*", help="archives or folders of them, instead of the configuration's")
        c.add_argument("--config", help="YAML file")
        c.add_argument("--mode", choices=["L", "RGB"])
        for name in ("max-images", "min-width", "min-height", "max-width", "max-height"):
            c.add_argument(f"--{name}", type=int)

    c = command("pipeline", _pipeline, "archives to chunked array stores")
    stream(c)
    c.add_argument("--work", required=True, help="folder of the stages' tables; a run goes on from the complete ones")
    c.add_argument("--skip-filter", action="store_true")
    c.add_argument("--skip-zarr", action="store_true")
    c = command("stage", _stage, "one stage of the pipeline")
    c.add_argument("stage", choices=STAGES)
    stream(c)
    c.add_argument("--work", required=True)
    c.add_argument("--skip-filter", action="store_true")
    c = command("tar", _tar, "images of archives, or their names")
    stream(c)
    c.add_argument("--manifest-only", action="store_true")
    c = command("classify", _classify, "class probabilities of a survey's images")
    c.add_argument("--source_dir", required=True)
    c.add_argument("--model", required=True, help="module:function that loads the model")
    c.add_argument("--classes", required=True, help="names of the classes in the model's order, by commas")
    c.add_argument("--cruise_name", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--batch_size", type=int, default=128)
    c.add_argument("--density_constant", type=float, default=340)
    c.add_argument("--classification_subsample", type=float, default=100)
    c = command("samples", _samples, "sampled images of each class in folders")
    c.add_argument("csv", nargs="+")
    c.add_argument("--tars", nargs="+", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("-n", type=int, default=100)
    c = command("export", _export, "kept images as archives of ten-minute bins")
    stream(c)
    c.add_argument("--work", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--cruise_name", required=True)
    c.add_argument("--bin_minutes", type=int, default=10)
    c.add_argument("--max_bubble_score", type=float, default=1.0)
    c.add_argument("--min_object_count", type=int, default=0)
    c = command("validate", _validate, "what is wrong with an export")
    c.add_argument("out")
    c = command("report", _report, "statistics of detail tables")
    c.add_argument("csv", nargs="+")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(a)


if __name__ == "__main__":
    main()
