"""Objects of decoded images, and pluggable classifiers over image vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ("area", "perimeter", "eccentricity", "solidity", "extent", "major_axis_length", "minor_axis_length", "equivalent_diameter_area", "mean_intensity", "min_intensity", "max_intensity", "intensity_std", "euler_number", "mean_optical_density", "integrated_optical_density", "gradient_rms", "intensity_ratio", "intensity_contrast", "circularity", "bg_mean")


def objects(images: DataFrame, sigma: float = 3.5, least: int = 64, ring: int | None = None, percentiles: tuple[float, float] | None = None, properties: dict | None = None) -> DataFrame:
    """tar_path, filename, label and features of every object found in every decoded image; images without pixels have none."""
    extra = (["local_bg", "local_mean_od", "local_intensity_ratio"] if ring is not None else []) + list(properties or {})
    names = [*FEATURES, *extra]
    schema = "tar_path string, filename string, label int, " + ", ".join(f"{n} double" for n in names)

    def run(batches):
        from driftscan.imaging import arrays, regions

        for b in batches:
            for k in range(b.num_rows):
                tar, name, h, w, c, nd, dtype, pixels = (col[k].as_py() for col in b.columns)
                a = arrays.gray(np.frombuffer(pixels, dtype).reshape((h, w, c) if nd > 2 else (h, w)), percentiles)
                rows = regions.region_rows(regions.segment(a, sigma, least), a, ring, properties)
                cols = [pa.array([tar] * len(rows), pa.string()), pa.array([name] * len(rows), pa.string()), pa.array([r["label"] for r in rows], pa.int32())]
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array([float(r[n]) for r in rows], pa.float64()) for n in names)], ["tar_path", "filename", "label", *names])

    return images.filter("pixels is not null").select("tar_path", "filename", "height", "width", "channels", "ndim", "dtype", "pixels").mapInArrow(run, schema)


def mlp_scores(vectors: DataFrame, features: list[str], layers: list[tuple[np.ndarray, np.ndarray, str]], mean: np.ndarray, std: np.ndarray) -> DataFrame:
    """vectors with `score`: standardised features through dense layers (weights, bias, activation); missing and infinite values are 0."""
    acts = {"relu": lambda x: np.maximum(x, 0), "leaky": lambda x: np.where(x > 0, x, 0.01 * x), "sigmoid": lambda x: 1 / (1 + np.exp(-x)), "linear": lambda x: x}
    kept = [c for c in vectors.columns if c != "score"]

    def run(batches):
        for b in batches:
            x = np.column_stack([np.nan_to_num(np.array([v if v is not None else 0.0 for v in b.column(f).to_pylist()], float), nan=0.0, posinf=0.0, neginf=0.0) for f in features])
            x = (x - mean) / std
            for w, bias, act in layers:
                x = acts[act](x @ w + bias)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(x[:, 0].astype(float), pa.float64())], [*kept, "score"])

    from pyspark.sql import types as T

    return vectors.select(*kept).mapInArrow(run, T.StructType([*vectors.select(*kept).schema.fields, T.StructField("score", T.DoubleType())]))


def load_layers(path: str) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray, str]], np.ndarray, np.ndarray]:
    """features, layers, mean and std for mlp_scores from an .npz: arrays features, mean, std, and w0, b0, act0, w1, …"""
    from driftscan.stores import open_file

    with open_file(path) as f, np.load(f, allow_pickle=False) as z:
        layers = []
        while f"w{len(layers)}" in z:
            k = len(layers)
            layers.append((z[f"w{k}"], z[f"b{k}"], str(z[f"act{k}"])))
        return [str(x) for x in z["features"]], layers, z["mean"], z["std"]


def is_artefact(score: Column | str, threshold: float = 0.5) -> Column:
    return (F.col(score) if isinstance(score, str) else score) >= threshold
