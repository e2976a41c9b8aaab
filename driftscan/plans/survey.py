"""Whole runs over a survey, in stages that are written tables: a run that broke off goes on after the last complete one."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftscan import functions as X
from driftscan.config import Config
from driftscan.operators import counters, inference, rules, sampling, stats
from driftscan.sinks import arrays, tables
from driftscan.sources import archives, objects, predictions, tar


class Stages:
    """Tables below a folder, one a stage, each made once for what it was made from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str, made_from: Any) -> str:
        digest = hashlib.sha256(json.dumps(made_from, sort_keys=True, default=str).encode()).hexdigest()[:12]
        return f"{self.folder}/{name}-{digest}"

    def _complete(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def table(self, name: str, made_from: Any, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table; it is made unless a complete one stands there. made_from tells different ones apart."""
        path = self.path(name, made_from)
        if not self._complete(path):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def read_images(stages: Stages, config: Config) -> DataFrame:
    """IMAGES rows of the configured archives, damaged ones with an error; max_images counts good ones, in archive order."""
    c, spark = config.stream, stages.spark

    def index() -> DataFrame:
        return archives.member_index(tar.archives(spark, *c.tar_paths).select("tar_path"))

    def images() -> DataFrame:
        at = stages.table("index", c.tar_paths, index)
        endings = tuple(c.extensions)
        members = archives.split_members(archives.splits(at), wanted=lambda name: name.lower().endswith(endings))
        return tar.decode_images(members, c.convert_mode, c.min_size, c.max_size)

    found = stages.table("images", asdict(c) | {"max_images": None}, images)
    if c.max_images is None:
        return found
    first = sampling.first_n(found.filter("error is null").select("tar_path", "member_idx"), c.max_images, "tar_path", "member_idx")
    kept = found.filter("error is null").join(first, ["tar_path", "member_idx"], "left_semi")
    return kept.unionByName(found.filter("error is not null"))


def filter_images(stages: Stages, config: Config) -> DataFrame:
    """All good images with is_bubble, bubble_score and object_count; images without objects are kept.

    With weights (filter.checkpoint_path, an .npz) an autoencoder's score of the
    objects' mean features decides, else the rules do. Other files of weights
    cannot be read and are an error.
    """
    r, weights = config.rule_filter, config.filter.checkpoint_path
    if weights and not weights.endswith(".npz"):
        raise ValueError(f"weights are read from .npz files, not {weights}")

    def verdicts() -> DataFrame:
        good = read_images(stages, config).filter("error is null")
        found = objects.objects(good, sigma=config.filter.spot_sigma if weights else r.spot_sigma, ring=r.annulus_width if r.local_background and not weights else None)
        if weights:
            features, *layers = objects.load_layers(weights)
            means = rules.object_means(rules.derive_shapes(found).withColumn("image_id", F.struct("tar_path", "filename")), "image_id", [f for f in features if f != "object_count"])
            scored = objects.mlp_scores(means.select("image_id.*", *features, *(["object_count"] if "object_count" not in features else [])), features, *layers)
            return scored.select("tar_path", "filename", objects.is_artefact("score", config.filter.threshold).alias("is_bubble"), F.col("score").alias("bubble_score"), "object_count")
        if r.local_background:
            found = found.withColumn("mean_optical_density", F.coalesce("local_mean_od", "mean_optical_density")).withColumn("intensity_ratio", F.coalesce("local_intensity_ratio", "intensity_ratio"))
        scored = rules.rule_score(found, r.rules()).withColumn("image_id", F.struct("tar_path", "filename"))
        return rules.image_vote(scored).select("image_id.*", "is_bubble", "bubble_score", "object_count")

    said = stages.table("verdicts", [asdict(config.stream), asdict(config.filter) if weights else asdict(r)], verdicts)
    at = read_images(stages, config).filter("error is null").join(said, ["tar_path", "filename"], "left")
    return at.withColumn("is_bubble", F.coalesce("is_bubble", F.lit(False))).withColumn("bubble_score", F.coalesce("bubble_score", F.lit(0.0))).withColumn("object_count", F.coalesce("object_count", F.lit(0)))


def group_images(stages: Stages, config: Config, skip_filter: bool = False) -> DataFrame:
    """The kept images in buckets, numbered within each in archive order."""
    g = config.grouper

    def bucketed() -> DataFrame:
        if skip_filter:
            kept = read_images(stages, config).filter("error is null")
        else:
            kept = filter_images(stages, config).filter("not is_bubble").drop("is_bubble")
        sized = stats.keep_large_buckets(stats.assign_buckets(kept, g.snap_grid or g.tile_size, g.snap_mode), g.min_bucket_size)
        return stats.truncate_buckets(sized, g.max_bucket_size or (1 << 31) - 1, "tar_path", "member_idx")

    return stages.table("bucketed", [asdict(config.stream), asdict(g), None if skip_filter else [asdict(config.rule_filter), asdict(config.filter)]], bucketed)


def run_counts(stages: Stages, config: Config, skip_filter: bool = False) -> DataFrame:
    """stage, passed, rejected, errors, total of reading and filtering."""
    read = counters.counts(read_images(stages, config), F.lit(True)).select(F.lit("read").alias("stage"), "*")
    if skip_filter:
        return read
    return read.unionByName(counters.counts(filter_images(stages, config), ~F.col("is_bubble")).select(F.lit("filter").alias("stage"), "*"))


def write_arrays(stages: Stages, config: Config, skip_filter: bool = False) -> DataFrame:
    """Single-scale and multi-scale stores of the grouped images, and one manifest of both."""
    z, o, rows = config.zarr_writer, config.ome_converter, group_images(stages, config, skip_filter)
    plain = arrays.write_stores(rows, z.output_dir, z.tile_size, codec=z.codec())
    levels = o.pyramid_levels if o.generate_pyramid else 1
    scaled = arrays.write_stores(rows, o.output_dir, o.tile_size, levels, o.pyramid_downsample_factor, pixel_size=o.pixel_size_um, codec=z.codec())
    return plain.withColumn("kind", F.lit("arrays")).unionByName(scaled.withColumn("kind", F.lit("multiscale")))


def preprocess(spark: SparkSession, config: Config, folder: str, skip_filter: bool = False, skip_arrays: bool = False) -> DataFrame:
    """Archives to stores; returns the manifest (or, without stores, the buckets' statistics) and writes it and the counters as JSON."""
    stages = Stages(spark, folder)
    told = stats.bucket_stats(group_images(stages, config, skip_filter)) if skip_arrays else write_arrays(stages, config, skip_filter)
    tables.write_json(told, f"{stages.folder}/manifest")
    tables.write_json(run_counts(stages, config, skip_filter), f"{stages.folder}/counts")
    return told


def finished_bins(spark: SparkSession, out: str) -> DataFrame | None:
    """date and timestamp of the bins with a detail table below out; None if there is none yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/raw")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(f"{out}/raw")
    return files.select(F.regexp_extract("path", r"_date=([^/]+)", 1).alias("date"), F.regexp_extract("path", r"_time=(\d+)", 1).alias("timestamp")).distinct()


def classify_survey(spark: SparkSession, source: str, load_model: Callable[[], inference.Model], classes: list[str], cruise: str, out: str, subsample: float = 100, volume: float = 340.0, batch_size: int = 128, size: int = 300) -> DataFrame:
    """Classifies the ten-minute bins below source and writes detail and summary tables; returns the quarantine.

    Archives are source/{date}/*_{HHMM}.tar. Bins with a detail table are left
    out, so that a run goes on where it stopped. Of a subsample only the drawn
    images' bytes are read, drawn before any damage is known, so that what is
    drawn does not depend on it. Quarantined images have no row in the tables.
    """
    out = out.rstrip("/")
    stages = Stages(spark, f"{out}/.stages")
    bins = tar.survey_bins(tar.archives(spark, source).select("tar_path"), finished_bins(spark, out))
    todo = sorted(r["tar_path"] for r in bins.select("tar_path").collect())  # archive names, as the listing has
    index = stages.table("index", todo, lambda: archives.member_index(bins.select("tar_path")))
    images = index.filter(X.suffix("name").isin(*tar.EXTENSIONS)).withColumn("key", F.concat_ws("/", "tar_path", "name"))
    background = X.basename("name") == "Background.tif"
    drawn = images if subsample >= 100 else sampling.percent(images, "tar_path", "key", subsample, background, 42)

    def scored() -> DataFrame:
        decoded = tar.decode_images(archives.fetch(drawn.filter(~background).drop("key")))
        return inference.classify(decoded, load_model, len(classes), size, batch_size)

    found = stages.table("probs", [todo, classes, subsample, size], scored)
    sides = archives.fetch(index.filter(X.basename("name").isin("HitsMisses.txt", "Background.tif")))
    factors = stats.hits_and_misses(tar.hits_misses(sides), "tar_path")
    places = tar.positions(sides)
    rows = predictions.detail(found.filter("error is null").withColumn("id", F.concat_ws("/", "tar_path", "filename")), classes, cruise)
    wide = predictions.widen(rows.select("tar_path", "id", "cruise_name", "instrument_code", "date", "time", "datetime", "pred_id", "pred_label", "pred_conf", "probs"), classes)
    confs = [f"{c}_conf" for c in sorted(classes)]
    means = [F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in confs]
    summary = wide.groupBy("tar_path", "cruise_name", "date", "time", "pred_label").agg(F.avg("pred_id").alias("pred_id"), F.avg("pred_conf").alias("pred_conf"), *means, F.count("*").cast("double").alias("total_counts"))
    summary = stats.add_density(summary, factors, ["tar_path"], volume).join(places, "tar_path", "left")
    joined = stats.attach_summary(wide, summary, ["tar_path", "pred_label"], ["lat", "lon", "subsample_factor", "total_counts", "density"])
    predictions.write_detail(summary, f"{out}/processed", digits=2, mode="append")
    predictions.write_detail(joined, f"{out}/raw", mode="append")
    return found.filter("error is not null").select("tar_path", "member_idx", "filename", "error")
