"""Class probabilities of decoded images from a model that the user brings, in batches, with damaged images set aside.

Pixels are made into tensors and given to the model within one task step, as a
column of tensors would be a megabyte a row. A batch that fails is halved until
the images that make it fail stand alone; those become rows with an error, and
all others keep their results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftscan.session import ship

# Mean and deviation of each colour in the data that common image models were trained on.
IMAGE_MEAN, IMAGE_STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
#: Takes float32 tensors (n, 3, size, size) and gives probabilities (n, classes).
Model = Callable[[np.ndarray], np.ndarray]


def _weights(n: int, to: int) -> np.ndarray:
    """Rows of weights of a triangle filter that is as wide as a new pixel, if that is wider than an old one."""
    scale = n / to
    reach = max(scale, 1.0)
    centre = (np.arange(to) + 0.5) * scale - 0.5
    w = np.maximum(0, 1 - np.abs(np.arange(n)[None] - centre[:, None]) / reach)
    return w / w.sum(1, keepdims=True)


def pad_resize(a: np.ndarray, size: int) -> np.ndarray:
    """An image (h, w[, c]) scaled to fit a square, its shape kept, zeros around it; float32 (size, size, c)."""
    a = a[:, :, None] if a.ndim == 2 else a
    h, w = a.shape[:2]
    if not h or not w:
        raise ValueError("an image without pixels")
    to_h, to_w = max(1, round(h * size / max(h, w))), max(1, round(w * size / max(h, w)))
    small = np.einsum("ih,hwc,jw->ijc", _weights(h, to_h), a.astype(np.float64), _weights(w, to_w), optimize=True)
    out, top, left = np.zeros((size, size, a.shape[2]), np.float32), (size - to_h) // 2, (size - to_w) // 2
    out[top : top + to_h, left : left + to_w] = small
    return out


def tensor(a: np.ndarray, size: int, mean=IMAGE_MEAN, std=IMAGE_STD) -> np.ndarray:
    """float32 (3, size, size): values of 0 to 1 of the image's type, grey in all three colours, standardised."""
    top = np.iinfo(a.dtype).max if a.dtype.kind in "ui" else 1.0
    x = pad_resize(a, size) / np.float32(top)
    x = np.repeat(x, 3, axis=2) if x.shape[2] < 3 else x[:, :, :3]
    return ((x - np.float32(mean)) / np.float32(std)).transpose(2, 0, 1).astype(np.float32)


def predict(model: Model, batch: list[np.ndarray | None], n_classes: int) -> list[tuple[np.ndarray | None, str | None]]:
    """Probabilities or an error for each tensor; a failing batch is halved."""
    if not batch:
        return []
    try:
        out = np.asarray(model(np.stack(batch)), np.float32)
        if out.shape != (len(batch), n_classes):
            raise ValueError(f"the model gave {out.shape} for {len(batch)} images of {n_classes} classes")
        if np.isfinite(out).all():
            return [(p, None) for p in out]
        if len(batch) == 1:
            raise ValueError("the model gave no finite probabilities")
    except Exception as e:  # noqa: BLE001  whatever a model raises
        if len(batch) == 1:
            return [(None, f"{type(e).__name__}: {e}"[:200])]
    half = len(batch) // 2
    return predict(model, batch[:half], n_classes) + predict(model, batch[half:], n_classes)


def classify(images: DataFrame, load_model: Callable[[], Model], n_classes: int, size: int = 300, batch_size: int = 128, mean=IMAGE_MEAN, std=IMAGE_STD) -> DataFrame:
    """images (height, width, channels, ndim, dtype, pixels, error and any others) without pixels, with probs and error.

    load_model is called once a task. Images that came with an error keep it;
    those without pixels, of impossible sizes, or that the model cannot take get
    one. Rows with an error have null probs: `error is not null` is the quarantine.
    """
    ship(images.sparkSession)
    own = [c for c in images.columns if c not in ("pixels", "probs", "error")]
    given = images.select(*own, *(["error"] if "error" in images.columns else [F.lit(None).cast("string").alias("error")]), "pixels")
    schema = T.StructType([*(images.schema[c] for c in own), T.StructField("probs", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())])
    shape = ("height", "width", "channels", "ndim", "dtype")

    def one(row: dict) -> tuple[np.ndarray | None, str | None]:
        if row["error"] is not None or row["pixels"] is None:
            return None, row["error"] or "no pixels"
        try:
            h, w, c, ndim, dtype = (row[k] for k in shape)
            return tensor(np.frombuffer(row["pixels"], dtype).reshape((h, w, c) if ndim > 2 else (h, w)), size, mean, std), None
        except (ValueError, TypeError, ZeroDivisionError) as e:
            return None, f"{type(e).__name__}: {e}"[:200]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model()
        for whole in batches:
            for at in range(0, whole.num_rows, batch_size):
                b = whole.slice(at, batch_size)
                made = [one({n: b.column(n)[k].as_py() for n in (*shape, "error", "pixels")}) for k in range(b.num_rows)]
                found = iter(predict(model, [t for t, _ in made if t is not None], n_classes))
                told = [(None, e) if t is None else next(found) for t, e in made]
                probs = pa.array([None if p is None else p.tolist() for p, _ in told], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in own), probs, pa.array([e for _, e in told], pa.string())], schema.names)

    return given.mapInArrow(run, schema)


def process_buckets(images: DataFrame, process: Callable[[str, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str, bucket: str = "bucket") -> DataFrame:
    """Whatever `process` makes of each bucket, which it is given as an iterator of batches, so that no bucket is ever one table in memory.

    A bucket's batches come in no order; a null bucket is one of its own.
    """
    ship(images.sparkSession)

    def each(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from process(key[0].as_py(), batches)

    return images.groupBy(bucket).applyInArrow(each, schema)
