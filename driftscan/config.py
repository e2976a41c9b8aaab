"""Typed configuration of the pre-processing and classification runs.

Sections and keys are those of existing YAML files. Keys that mean nothing here
are named in NO_EFFECT and accepted; any other unknown one is an error, as it is
likely misspelt. Paths with drive letters are taken as where the drive is
mounted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from typing import Any

from driftscan.operators.rules import BubbleRules
from driftscan.sinks.arrays import Codec

#: Keys of existing files that have no effect: Spark decides on parallelism and backends, stores are Zarr v2, images are always padded.
NO_EFFECT = {
    "stream": {"output_format"},
    "concurrency": {"enabled", "max_workers", "chunk_size"},
    "grouper": {"pad_to_bucket"},
    "filter": {"device", "fallback_to_skimage", "outline_sigma"},
    "rule_filter": {"fallback_to_skimage", "outline_sigma"},
    "zarr_writer": {"zarr_format", "dimension_separator", "shard_images", "shard_tiles"},
    "ome_converter": {"zip_store"},
}
#: Blosc is not at hand: its inner codec is used alone, and bytes are shuffled instead of bits. Manifests name what was used.
CODECS = {"blosc_zstd": "zstd", "blosc_lz4": "lz4", "blosc_lz4hc": "lz4", "zstd": "zstd", "zlib": "zlib", "lz4": "lz4", "none": "none"}


@dataclass(frozen=True)
class Stream:
    tar_paths: tuple[str, ...] = ()
    max_images: int | None = None
    min_size: tuple[int, int] = (128, 128)
    max_size: tuple[int, int] = (16384, 16384)
    convert_mode: str | None = None
    extensions: tuple[str, ...] = (".jpg", ".jpeg", ".png", ".tiff", ".tif", ".bmp", ".webp")


@dataclass(frozen=True)
class Grouper:
    tile_size: int = 300
    snap_grid: int | None = None
    snap_mode: str = "ceil"
    min_bucket_size: int = 1
    max_bucket_size: int | None = None

    def __post_init__(self):
        if self.snap_mode not in ("ceil", "floor", "round", "exact"):
            raise ValueError(f"snap_mode {self.snap_mode}")


@dataclass(frozen=True)
class Filter:
    """An autoencoder's threshold; its weights are an .npz with w0, b0, w1, … or none."""

    checkpoint_path: str | None = None
    threshold: float = 0.5
    spot_sigma: float = 3.5

    def __post_init__(self):
        if not 0 <= self.threshold <= 1 or self.spot_sigma <= 0:
            raise ValueError("threshold lies from 0 to 1, spot_sigma above 0")


@dataclass(frozen=True)
class RuleFilter:
    spot_sigma: float = 3.5
    local_background: bool = False
    annulus_width: int = 10
    mod_threshold: float = 0.02
    intensity_ratio_min: float = 0.9
    solidity_min: float = 0.95
    eccentricity_max: float = 0.3
    gradient_rms_max: float | None = None
    intensity_std_max: float | None = None
    score_weights: tuple[float, float, float, float] = (0.4, 0.2, 0.2, 0.2)
    score_threshold: float = 0.7

    def rules(self) -> BubbleRules:
        return BubbleRules(self.mod_threshold, self.solidity_min, self.eccentricity_max, self.intensity_ratio_min, *self.score_weights, self.score_threshold, self.gradient_rms_max, self.intensity_std_max)


@dataclass(frozen=True)
class ArrayStore:
    output_dir: str = "output/zarr"
    tile_size: int = 300
    compression_codec: str = "blosc_zstd"
    compression_level: int = 5
    shuffle: str = "bitshuffle"

    def codec(self) -> Codec:
        if self.compression_codec not in CODECS or self.shuffle not in ("noshuffle", "shuffle", "bitshuffle"):
            raise ValueError(f"unsupported compression {self.compression_codec} with {self.shuffle}")
        return Codec(CODECS[self.compression_codec], self.compression_level, self.shuffle != "noshuffle")


@dataclass(frozen=True)
class MultiScale:
    output_dir: str = "output/ome_zarr"
    pixel_size_um: float = 0.36
    generate_pyramid: bool = True
    pyramid_levels: int = 3
    pyramid_downsample_factor: int = 2
    tile_size: int = 300


@dataclass(frozen=True)
class Config:
    stream: Stream = field(default_factory=Stream)
    grouper: Grouper = field(default_factory=Grouper)
    filter: Filter = field(default_factory=Filter)
    rule_filter: RuleFilter = field(default_factory=RuleFilter)
    zarr_writer: ArrayStore = field(default_factory=ArrayStore)
    ome_converter: MultiScale = field(default_factory=MultiScale)


def mounted(path: str) -> str:
    """`C:\\a\\b` as `/mnt/c/a/b`; other paths stay."""
    if not re.match(r"[A-Za-z]:[/\\]", path):
        return path
    return f"/mnt/{path[0].lower()}/" + path[2:].replace("\\", "/").lstrip("/")


def _placed(key: str, value: Any) -> Any:
    if not re.search("(_path|_paths|_dir)$", key.lower()):
        return value
    return mounted(value) if isinstance(value, str) else [mounted(v) if isinstance(v, str) else v for v in value] if isinstance(value, list) else value


def _section(name: str, kind: type, given: dict[str, Any]) -> Any:
    known = {f.name for f in fields(kind)}
    unknown = set(given) - known - NO_EFFECT.get(name, set())
    if unknown:
        raise ValueError(f"{name} has no keys {sorted(unknown)}")
    values = {k: _placed(k, v) for k, v in given.items() if k in known}
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def from_dict(data: dict[str, Any] | None) -> Config:
    """A configuration from nested mappings; missing sections and keys have their defaults."""
    kinds = {f.name: f.default_factory for f in fields(Config)}
    unknown = set(data or {}) - set(kinds) - {"concurrency"}
    if unknown:
        raise ValueError(f"no sections {sorted(unknown)}")
    made = {name: _section(name, kinds[name], values or {}) for name, values in (data or {}).items() if name in kinds}
    wrong = set((data or {}).get("concurrency") or {}) - NO_EFFECT["concurrency"]
    if wrong:
        raise ValueError(f"concurrency has no keys {sorted(wrong)}")
    return Config(**made)


def load_config(path: str) -> Config:
    """A configuration from a YAML file."""
    import yaml

    from driftscan.stores import open_file

    at = mounted(path)
    with open_file(at if "://" in at or at.startswith("/") else _absolute(at)) as f:
        return from_dict(yaml.safe_load(f.read()))


def _absolute(path: str) -> str:
    from pathlib import Path

    return str(Path(path).resolve())
