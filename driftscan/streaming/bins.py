"""Ten-minute bins and track segments over a stream; an extension that the bounded operators define the results of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_events(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    """Parquet files dropped into a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def bin_counts(stream: DataFrame, ts: str, label: str, value: str, late: str = "30 minutes", every: str = "10 minutes") -> DataFrame:
    """Counts and means per bin and label; rows later than `late` behind the newest are dropped."""
    own = stream.withColumn("__ts", F.col(ts).cast("timestamp_ltz"))
    return own.withWatermark("__ts", late).groupBy(F.window("__ts", every).alias("w"), F.col(label).alias("pred_label")).agg(F.count("*").alias("total_counts"), F.avg(value).alias("mean_value")).select(F.col("w.start").alias("window_start"), "pred_label", "total_counts", "mean_value")


def segments(stream: DataFrame, ts: str, key: str, gap: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """First, last and number of points of each key's segment; touching points up to the gap apart are one segment."""
    own = stream.withColumn("__ts", F.col(ts).cast("timestamp_ltz"))
    return own.withWatermark("__ts", late).groupBy(F.session_window("__ts", gap).alias("s"), F.col(key)).agg(F.min("__ts").alias("first"), F.max("__ts").alias("last"), F.count("*").alias("n_points")).drop("s")


def run_to(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Writes what is available and stops; a rerun takes up where it ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
