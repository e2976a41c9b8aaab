"""Column expressions: every scalar of the library, built from Spark's own functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- resolution buckets -------------------------------------------------------


def snap(value, grid, mode: str = "ceil") -> Column:
    """A dimension snapped to a grid: ceil, floor, round (halves to even), never below one cell; exact leaves it."""
    v, g = _c(value), _c(grid) if isinstance(grid, str) else F.lit(grid) if isinstance(grid, int) else grid
    cells = {"ceil": lambda: F.ceil(v / g), "floor": lambda: F.greatest(F.lit(1), F.floor(v / g)), "round": lambda: F.greatest(F.lit(1), F.bround((v / g).cast("double")).cast("bigint"))}
    return v.cast("int") if mode == "exact" else (cells[mode]() * g).cast("int")


def effective_grid(snap_grid, tile_size) -> Column:
    return F.coalesce(_c(snap_grid), _c(tile_size))


def bucket_name(height, width) -> Column:
    return F.concat(_c(height).cast("string"), F.lit("x"), _c(width).cast("string"))


def parse_bucket(name) -> Column:
    """HxW as a struct of two ints; nulls where the name has another form."""
    part = lambda k: F.nullif(F.regexp_extract(_c(name), r"^(\d+)x(\d+)$", k), F.lit("")).cast("int")
    return F.struct(part(1).alias("height"), part(2).alias("width"))


def pixel_count(height, width) -> Column:
    return _c(height).cast("bigint") * _c(width)


def aspect_ratio(height, width) -> Column:
    return _c(width) / F.greatest(_c(height), F.lit(1))


def chunk_count(n, height, width, tile: int) -> Column:
    return (_c(n) * F.ceil(_c(height) / tile) * F.ceil(_c(width) / tile)).cast("bigint")


def pyramid_scale(pixel_size, factor: int, level) -> Column:
    return _c(pixel_size) * F.pow(F.lit(float(factor)), _c(level))


def pyramid_translation(pixel_size, factor: int, level) -> Column:
    return (F.pow(F.lit(float(factor)), _c(level)) - 1) * _c(pixel_size) / 2


# --- names and paths ----------------------------------------------------------


def basename(path) -> Column:
    """Last component, whichever separator stands before it."""
    return F.element_at(F.split(F.replace(_c(path), F.lit("\\"), F.lit("/")), "/"), -1)


def suffix(path) -> Column:
    return F.lower(F.regexp_extract(basename(path), r"(\.[^.]+)$", 1))


def instrument_code(path) -> Column:
    return F.split_part(basename(path), F.lit("."), F.lit(1))


def timestamp_token(name) -> Column:
    """HHMM at the end of an archive's name: the last part after an underscore, before the first dot."""
    return F.split_part(F.split_part(basename(name), F.lit("_"), F.lit(-1)), F.lit("."), F.lit(1))


def tenth_minute(token) -> Column:
    return F.endswith(_c(token), F.lit("0"))


def floor_bin(token, minutes: int = 10) -> Column:
    """HHMM floored to a number of minutes, within the hour's own digits."""
    v = _c(token).cast("int")
    return F.lpad((F.floor(v / minutes) * minutes).cast("string"), 4, "0")


def origin(tar_path) -> Column:
    """date (1970-01-01 if none) and timestamp (empty if none) named by an archive's path."""
    date = F.regexp_replace(F.regexp_extract(_c(tar_path), r"(\d{4}[-_]\d{2}[-_]\d{2})", 1), "_", "-")
    return F.struct(F.coalesce(F.nullif(date, F.lit("")), F.lit("1970-01-01")).alias("date"), F.regexp_extract(_c(tar_path), r"_(\d{3,6})\.tar$", 1).alias("timestamp"))


def sanitise(name) -> Column:
    """A file name without separators or blanks and without leading dots."""
    return F.btrim(F.regexp_replace(_c(name), r"[^A-Za-z0-9._-]+", "_"), F.lit("._"))


def clean_label(label) -> Column:
    return F.translate(_c(label), "_-", "  ")


def compression_label(codec, level, shuffle) -> Column:
    return F.concat_ws("_", _c(codec), F.concat(F.lit("clevel"), _c(level).cast("string")), _c(shuffle))


# --- time ---------------------------------------------------------------------


def combine_datetime(date, time) -> Column:
    """Timestamp without zone from a date and an HH:mm string; null where either does not parse."""
    return F.try_to_timestamp(F.concat_ws(" ", _c(date).cast("string"), _c(time)), F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")


def repair_datetime(datetime, date, time) -> Column:
    """A timestamp from a datetime string, or from date and HH:mm where the string lost its time, as at midnight."""
    text = _c(datetime).cast("string")
    whole = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return F.coalesce(whole, combine_datetime(date, time), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("timestamp_ntz"))


def bin_start(ts, every: str = "10 minutes") -> Column:
    return F.window(_c(ts), every)["start"].cast("timestamp_ntz")


def unit_start(ts, unit: str) -> Column:
    """Start of the hour or day, or the Monday that ends the Tuesday-to-Monday week."""
    if unit == "week":
        return F.next_day(F.date_sub(_c(ts).cast("date"), 1), "MON").cast("timestamp_ntz")
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def hours_between(start, end) -> Column:
    seconds = F.unix_micros(_c(end).cast("timestamp_ltz")) - F.unix_micros(_c(start).cast("timestamp_ltz"))
    return F.coalesce(seconds / 3_600_000_000.0, F.lit(0.0))


# --- place --------------------------------------------------------------------


def dms(degrees, minutes, seconds, ref) -> Column:
    """Decimal degrees, negative in the south and west."""
    value = _c(degrees) + _c(minutes) / 60.0 + _c(seconds) / 3600.0
    return F.when(F.upper(_c(ref)).isin("S", "W"), -value).otherwise(value)


def not_null_island(lat, lon) -> Column:
    return ~((_c(lat) == 0) & (_c(lon) == 0))


def hemisphere(value, positive: str, negative: str) -> Column:
    return F.when(_c(value) >= 0, F.lit(positive)).otherwise(F.lit(negative))


#: GRS80 and the parameters of EPSG:3035; fixed values.
_A, _E2 = 6378137.0, 0.00669438002290
_LAT0, _LON0, _FE, _FN = math.radians(52.0), math.radians(10.0), 4321000.0, 3210000.0
_E = math.sqrt(_E2)


def _q_of(sin_phi: float) -> float:
    return (1 - _E2) * (sin_phi / (1 - _E2 * sin_phi**2) - math.log((1 - _E * sin_phi) / (1 + _E * sin_phi)) / (2 * _E))


_QP = _q_of(1.0)
_BETA0 = math.asin(_q_of(math.sin(_LAT0)) / _QP)
_RQ = _A * math.sqrt(_QP / 2)
_D = _A * math.cos(_LAT0) / math.sqrt(1 - _E2 * math.sin(_LAT0) ** 2) / (_RQ * math.cos(_BETA0))


def laea(lat, lon) -> Column:
    """x and y of the European equal-area projection (EPSG:3035), in metres."""
    s = F.sin(F.radians(_c(lat)))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    beta, dl = F.asin(q / _QP), F.radians(_c(lon)) - _LON0
    b = _RQ * F.sqrt(2.0 / (1 + math.sin(_BETA0) * F.sin(beta) + math.cos(_BETA0) * F.cos(beta) * F.cos(dl)))
    x = _FE + b * _D * F.cos(beta) * F.sin(dl)
    y = _FN + b / _D * (math.cos(_BETA0) * F.sin(beta) - math.sin(_BETA0) * F.cos(beta) * F.cos(dl))
    return F.struct(x.alias("x"), y.alias("y"))


# --- classes and confidences --------------------------------------------------


def argmax(probs) -> Column:
    """0-based place of the first maximum of an array; null where it is empty or null."""
    p = _c(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def confidence(probs, class_id) -> Column:
    return F.get(_c(probs), _c(class_id).cast("int"))


def finite_or_zero(x) -> Column:
    """NaN, infinities and nulls as 0."""
    v = _c(x).cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v)


def nan_to_null(x) -> Column:
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def standardise(x, mean: float, std: float) -> Column:
    return (_c(x) - mean) / std


# --- shapes and optical density ------------------------------------------------

#: (name, required columns, expression): a derived feature is added where its inputs exist.
SHAPE_RULES = [
    ("aspect_ratio", ("minor_axis_length", "major_axis_length"), lambda a, b: a / (b + 1e-6)),
    ("circularity", ("area", "perimeter"), lambda a, p: 4 * math.pi * a / (p * p + 1e-6)),
    ("compactness", ("area", "perimeter"), lambda a, p: p * p / (a + 1e-6)),
    ("bbox_aspect_ratio", ("bbox_width", "bbox_height"), lambda w, h: w / (h + 1e-6)),
    ("extent_derived", ("area", "bbox_height", "bbox_width"), lambda a, h, w: a / (h * w + 1e-6)),
    ("intensity_cv", ("intensity_std", "mean_intensity"), lambda s, m: s / (m + 1e-6)),
    ("intensity_cv", ("standard_deviation_intensity", "mean_intensity"), lambda s, m: s / (m + 1e-6)),
    ("centroid_mass_center_ratio", ("mean_distance_to_centroid", "mean_distance_to_mass_center"), lambda c, m: c / (m + 1e-6)),
]


def intensity_ratio(mean, background) -> Column:
    """An object's brightness over the background's; null on a background of 0."""
    return _c(mean) / F.nullif(_c(background), F.lit(0))


def intensity_contrast(mean, background) -> Column:
    return (_c(background) - _c(mean)) / F.nullif(_c(background), F.lit(0))


def od_circularity(area, perimeter) -> Column:
    """Circularity as the optical-density features have it, with their own guard against 0."""
    return 4 * math.pi * _c(area) / (_c(perimeter) * _c(perimeter) + 1e-10)


def optical_density(pixel, background) -> Column:
    return F.greatest(F.lit(0.0), -F.log10(_c(pixel) / _c(background) + 1e-10))


def density(count, factor, volume: float = 340.0) -> Column:
    """Counts per litre: null factor (no side-car) gives 0, factor 0 gives infinity."""
    f = _c(factor)
    return F.when(f.isNull(), 0.0).when(f == 0, F.lit(float("inf"))).otherwise(_c(count) / F.nullif(f, F.lit(0.0)) / volume)


def subsample_factor(hits, misses) -> Column:
    total = _c(hits) + _c(misses)
    return F.when(total == 0, 0.0).otherwise(_c(hits) / F.nullif(total, F.lit(0)))


# --- paths, names and numbers for reports -----------------------------------------


def portable_path(path) -> Column:
    """A path with a drive letter as it is mounted elsewhere, `C:\\a\\b` as `/mnt/c/a/b`; of others only the separators change."""
    p = F.replace(_c(path), F.lit("\\"), F.lit("/"))
    return F.when(p.rlike("^[A-Za-z]:/"), F.concat(F.lit("/mnt/"), F.lower(F.substring(p, 1, 1)), F.substring(p, F.lit(3), F.length(p)))).otherwise(p)


def drive_path(path) -> Column:
    """The inverse of portable_path: `/mnt/c/a/b` as `C:\\a\\b`; other paths stay."""
    p = _c(path)
    inner = F.concat(F.upper(F.substring(p, 6, 1)), F.lit(":"), F.replace(F.substring(p, F.lit(7), F.length(p)), F.lit("/"), F.lit("\\")))
    return F.when(p.rlike("^/mnt/[A-Za-z]/"), inner).otherwise(p)


def strip_affixes(name, prefix: str = "", suffix: str = "") -> Column:
    """name without prefix and suffix, where it has them."""
    n = _c(name)
    n = F.when(F.startswith(n, F.lit(prefix)), F.substring(n, F.lit(len(prefix) + 1), F.length(n))).otherwise(n)
    return F.when(F.endswith(n, F.lit(suffix)), F.substring(n, F.lit(1), F.length(n) - len(suffix))).otherwise(n)


def thousands(number, digits: int = 0) -> Column:
    """A number with commas between thousands and so many digits after the point."""
    return F.format_number(_c(number), digits)
