"""Small report tables as files: JSON manifests, metrics, tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object a row, fields without a value left out; written by the tasks that hold the rows."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)


def write_metrics(rows: DataFrame, folder: str, *names: str) -> str:
    """A table of metrics as one CSV with a header, in a folder named by the joined names; returns its path.

    Metrics are a few rows a class, so that one task writes them.
    """
    path = f"{folder.rstrip('/')}/{'_'.join(names)}.csv"
    rows.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


def point_features(rows: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """value: each row with a position as a GeoJSON feature, its other columns as properties. Rows without one are left out."""
    rest = [c for c in rows.columns if c not in (lat, lon)]
    geometry = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*rest).alias("properties"))
    return rows.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.to_json(feature).alias("value"))


def line_features(lines: DataFrame, line: str = "line") -> DataFrame:
    """value: each row's points (an array of structs with lon and lat, in order) as a GeoJSON line, its other columns as properties.

    Points without a place are left out; lines of fewer than two points that
    have one have no feature.
    """
    rest = [c for c in lines.columns if c != line]
    at = F.transform(F.filter(line, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull()), lambda p: F.array(p["lon"].cast("double"), p["lat"].cast("double")))
    placed = lines.select(*rest, at.alias("__at")).filter(F.size("__at") > 1)
    geometry = F.struct(F.lit("LineString").alias("type"), F.col("__at").alias("coordinates"))
    return placed.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*rest).alias("properties"))).alias("value"))


def write_lines(lines: DataFrame, path: str, line: str = "line") -> None:
    """Track segments as newline-delimited GeoJSON features."""
    line_features(lines, line).write.mode("overwrite").text(path)


def write_csv(rows: DataFrame, path: str, digits: int | None = None) -> None:
    """A table as CSV with a header, doubles and floats with exactly so many digits after the point."""
    if digits is not None:
        rows = rows.select(*(F.when(F.col(f"`{c}`").isNotNull(), F.format_string(f"%.{digits}f", F.col(f"`{c}`").cast("double"))).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in rows.dtypes))
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_points(rows: DataFrame, path: str, lat: str = "lat", lon: str = "lon") -> None:
    """Points as newline-delimited GeoJSON features."""
    point_features(rows, lat, lon).write.mode("overwrite").text(path)
