"""Named queries over archives, files and small operators, on archives and files that Spark makes of the driver's tables, with equivalent SQL."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftscan import functions as X
from driftscan.operators import counters, curation, inference, ranges, rules, sampling, stats
from driftscan.plans.reports import _P, _T, _images, _points
from driftscan.session import load, materialize, scratch_path
from driftscan.sinks import arrays, exports, folders
from driftscan.sources import archives, predictions, tar

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


# --- archives ------------------------------------------------------------------------
# Documents stand for images: an archive of each of five days and some minutes, with texts as contents.

_BASE = "(CASE WHEN doc_id % 50 = 0 THEN 'Background.tif' ELSE 'd' || (doc_id % 400) || '.tif' END)"
_RECORDS = f"""SELECT doc_id, lang, '/survey/2024_01_0' || (doc_id % 5 + 1) || '/run_' || lpad((doc_id % 3 + 9)::VARCHAR, 2, '0') || lpad((doc_id % 37)::VARCHAR, 2, '0') || '.tar' AS tar_path,
CASE WHEN doc_id % 2 = 0 THEN 'RawImages/' || {_BASE} ELSE 'RawImages\\' || {_BASE} END AS filename, {_BASE} AS base, coalesce(text, '') AS text, doc_id % 10 / 10.0::DOUBLE AS bubble_score, (doc_id % 4)::INT AS object_count FROM documents"""
_PLACED = f"""SELECT *, row_number() OVER (PARTITION BY date, timestamp, base ORDER BY tar_path, filename, doc_id) - 1 AS again FROM (
SELECT *, replace(regexp_extract(tar_path, '\\d{{4}}[-_]\\d{{2}}[-_]\\d{{2}}'), '_', '-') AS date, lpad((regexp_extract(tar_path, '_(\\d{{3,6}})\\.tar$', 1)::INT // 10 * 10)::VARCHAR, 4, '0') AS timestamp FROM ({_RECORDS})) WHERE bubble_score <= 0.7 AND object_count >= 1"""
_MEMBERS = f"""SELECT *, (CASE WHEN base = 'Background.tif' THEN '' ELSE 'RawImages/' END) || (CASE WHEN again > 0 THEN again || '/' ELSE '' END) || base AS member FROM ({_PLACED})"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "documents")
    base = F.when(F.col("doc_id") % 50 == 0, "Background.tif").otherwise(F.concat(F.lit("d"), (F.col("doc_id") % 400).cast("string"), F.lit(".tif")))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    path = F.concat(F.lit("/survey/2024_01_0"), (F.col("doc_id") % 5 + 1).cast("string"), F.lit("/run_"), two(F.col("doc_id") % 3 + 9), two(F.col("doc_id") % 37), F.lit(".tar"))
    name = F.concat(F.when(F.col("doc_id") % 2 == 0, "RawImages/").otherwise("RawImages\\"), base)
    return e.select("doc_id", F.col("doc_id").alias("member_idx"), "lang", path.alias("tar_path"), name.alias("filename"), F.coalesce("text", F.lit("")).cast("binary").alias("content"), (F.col("doc_id") % 10 / 10.0).alias("bubble_score"), (F.col("doc_id") % 4).cast("int").alias("object_count"))


def _exported(spark: SparkSession, d: str, bin_minutes: int = 10) -> str:
    root = scratch_path(spark, "export")
    exports.export_archives(_records(spark, d), root, "cruise", bin_minutes, max_bubble_score=0.7, min_object_count=1)
    return root


@query(f"""SELECT date, timestamp, 'cruise_' || timestamp || '.tar' AS tar_filename, count(*) FILTER (base <> 'Background.tif') AS n_images, true AS is_valid_bin FROM ({_PLACED}) GROUP BY 1, 2""")
def archive_export(spark, d):
    return exports.manifest(spark, _exported(spark, d)).drop("bytes")


@query(f"SELECT date, timestamp, count(*) AS n_members, CAST(sum(strlen(text)) AS BIGINT) AS bytes, string_agg(member, ',' ORDER BY member) AS members FROM ({_MEMBERS}) GROUP BY 1, 2")
def archive_index(spark, d):
    """The export's archives, read header by header."""
    found = archives.member_index(tar.archives(spark, f"{_exported(spark, d)}/source"))
    parts = F.split("tar_path", "/")
    at = found.select(F.element_at(parts, -2).alias("date"), X.timestamp_token("tar_path").alias("timestamp"), "name", "size")
    return at.groupBy("date", "timestamp").agg(F.count("*").alias("n_members"), F.sum("size").alias("bytes"), F.array_join(F.array_sort(F.collect_list("name")), ",").alias("members"))


@query(f"SELECT date, timestamp, member, strlen(text)::BIGINT AS size, sha256(text) AS sha256 FROM ({_MEMBERS})")
def archive_scan(spark, d):
    """All members' contents by the data source, archives split over tasks."""
    root = _exported(spark, d)
    at = scratch_path(spark, "splits")
    archives.splits(archives.member_index(tar.archives(spark, f"{root}/source")), 1 << 16).write.parquet(at)
    archives.register(spark)
    got = spark.read.format("tar").option("splits", at).load()
    return got.select(F.element_at(F.split("tar_path", "/"), -2).alias("date"), X.timestamp_token("tar_path").alias("timestamp"), F.col("name").alias("member"), "size", F.sha2("content", 256).alias("sha256"))


_SAMPLE = f"SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42' || date || timestamp || member), date || timestamp || member) AS r FROM ({_MEMBERS}) WHERE base <> 'Background.tif'"


@query(f"SELECT lang, date, timestamp, member, sha256(text) AS sha256 FROM ({_SAMPLE}) WHERE r <= 20")
def archive_sample(spark, d):
    """Twenty members of each language, whose bytes alone are read, by the places the export noted."""
    root = _exported(spark, d)
    mapping = exports.read_mapping(spark, root).filter("member not like '%Background.tif'")
    own = _records(spark, d).select("tar_path", "filename", "doc_id", "lang", F.row_number().over(_again("tar_path", "filename", order="doc_id")).alias("n")).filter(rules_of_export())
    lines = mapping.withColumn("n", F.row_number().over(_again("tar_path", "filename", order="data_offset")))
    known = lines.join(own, ["tar_path", "filename", "n"]).withColumn("key", F.concat("date", "timestamp", "member"))
    drawn = sampling.per_class(known, "lang", "key", 20, 42)
    got = archives.fetch(drawn.select(F.col("tar_export").alias("tar_path"), "member_idx", "size", "data_offset", "lang", "date", "timestamp", "member"))
    return got.select("lang", "date", "timestamp", "member", F.sha2("content", 256).alias("sha256"))


def _again(*keys: str, order: str):
    from pyspark.sql.window import Window

    return Window.partitionBy(*keys).orderBy(order)


def rules_of_export():
    return (F.col("doc_id") % 10 <= 7) & (F.col("doc_id") % 4 >= 1)


@query(f"""SELECT 'bin_ends_in_0' AS "check", 'warning' AS severity, date || '/cruise_' || t || '.tar' AS subject, t AS detail FROM (
SELECT DISTINCT date, lpad((regexp_extract(tar_path, '_(\\d{{3,6}})\\.tar$', 1)::INT // 7 * 7)::VARCHAR, 4, '0') AS t FROM ({_PLACED})) WHERE t NOT LIKE '%0'""")
def export_validation(spark, d):
    """What is wrong with an export whose bins are not of ten minutes."""
    return exports.validate(spark, _exported(spark, d, bin_minutes=7))


@query(f"SELECT date, timestamp, member, tar_path AS origin_tar, filename AS origin_filename, bubble_score, object_count FROM ({_MEMBERS}) WHERE base <> 'Background.tif'")
def export_results_merged(spark, d):
    """Results of the exported images with where they came from and what the filter had said."""
    root = _exported(spark, d)
    mapping = exports.read_mapping(spark, root)
    results = mapping.filter("member not like '%Background.tif'").select("date", F.concat(F.substring("timestamp", 1, 2), F.lit(":"), F.substring("timestamp", 3, 2)).alias("time"), F.concat(F.lit("/tmp/x/"), "member").alias("id"), "timestamp", "member")
    return exports.merge_results(results, mapping, exports.read_filter_results(spark, root)).drop("time", "id")


@query(f"SELECT (doc_id % 5)::VARCHAR || '_' || lang AS folder, name, sha256(text) AS sha256 FROM (SELECT *, row_number() OVER (PARTITION BY doc_id % 5, lang ORDER BY md5('42' || doc_id::VARCHAR), doc_id::VARCHAR) AS r, (CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END) || doc_id || '.tif' AS name FROM ({_RECORDS})) WHERE r <= 7")
def class_sample_folders(spark, d):
    """Seven images of each class copied out of archives into folders of their own."""
    source, out = scratch_path(spark, "classes"), scratch_path(spark, "samples")
    own = _records(spark, d).withColumn("filename", F.concat(F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd"), F.col("doc_id").cast("string"), F.lit(".tif")))
    exports.export_archives(own.drop("bubble_score", "object_count"), source, "run")
    mapping = exports.read_mapping(spark, source)
    named = own.select(F.col("doc_id").cast("string").alias("id"), "tar_path", "filename", (F.col("doc_id") % 5).alias("pred_id"), F.col("lang").alias("pred_label"))
    # an image's key is its number; its place is looked up by the name in its own archive
    preds = named.join(mapping.select("tar_path", "filename", "tar_export"), ["tar_path", "filename"])
    drawn = sampling.per_class(preds.withColumn("folder", folders.class_folder()), "folder", "id", 7, 42)
    got = archives.fetch(archives.locate(drawn.select(F.col("tar_export").alias("tar_path"), F.col("filename"), "folder"), exports.member_index(mapping), "filename"))
    folders.write_folders(got.select("folder", X.basename("name").alias("name"), "content"), out)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("folder"), X.basename("path").alias("name"), F.sha2("content", 256).alias("sha256"))


# --- prediction files ----------------------------------------------------------------------


def _detail_files(spark: SparkSession, d: str) -> str:
    """Events as detail CSVs of three cruises: one with a column less, one with its columns in another order."""
    root = scratch_path(spark, "detail")
    e = load(spark, d, "events").select(F.concat(F.lit("i"), "event_id", F.lit(".tif")).alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm").alias("time"), (F.col("event_id") % 3).alias("pred_id"), (F.col("event_id") % 101 / 101.0).alias("pred_conf"), F.when(F.col("event_id") % 11 == 0, "inf").otherwise(F.col("event_id").cast("string")).alias("density"), (F.col("event_id") % 7 / 7.0).alias("a,b_conf"), (F.col("event_id") % 5 / 5.0).alias("c_conf"), (F.col("user_id") % 3).alias("cruise"))
    all_columns = [c for c in e.columns if c != "cruise"]
    for k, columns in enumerate((all_columns, [c for c in all_columns if c != "c_conf"], all_columns[::-1])):
        e.filter(F.col("cruise") == k).select(*(F.col(f"`{c}`") for c in columns)).repartition(4).write.option("header", "true").csv(f"{root}/{k}")
    return root


@query("""SELECT 'i' || event_id || '.tif' AS id, date_trunc('minute', ts) AS datetime, (event_id % 3)::DOUBLE AS pred_id, round(event_id % 101 / 101.0, 9)::DOUBLE AS pred_conf, CASE WHEN event_id % 11 = 0 THEN 'inf' ELSE event_id::VARCHAR END AS density,
round(event_id % 7 / 7.0, 9)::DOUBLE AS a_b, CASE WHEN user_id % 3 <> 1 THEN round(event_id % 5 / 5.0, 9)::DOUBLE END AS c FROM events""")
def detail_files(spark, d):
    """Detail files with quoted names, infinities, absent and reordered columns, united by name."""
    rows = predictions.read_detail(spark, [_detail_files(spark, d)])
    infinite = F.when(F.col("density") == float("inf"), "inf").otherwise(F.col("density").cast("bigint").cast("string"))
    return rows.select("id", "datetime", "pred_id", F.round("pred_conf", 9).alias("pred_conf"), infinite.alias("density"), F.round("`a,b_conf`", 9).alias("a_b"), F.round("c_conf", 9).alias("c"))


@query("SELECT 'i' || event_id || '.tif' AS id FROM events WHERE user_id % 3 <> 1")
def complete_files(spark, d):
    """Rows of the files with as many columns as there must be; the others are left out whole."""
    return predictions.read_detail(spark, [_detail_files(spark, d)], classes=["x"] * 8).select("id")


@query("SELECT name, CASE WHEN name = 'c_conf' THEN 8 ELSE 12 END::BIGINT AS n_files FROM (SELECT unnest(['id', 'date', 'time', 'pred_id', 'pred_conf', 'density', 'a,b_conf', 'c_conf']) AS name)")
def file_vocabulary(spark, d):
    """How many files have each column: four of each cruise, as long as no file is empty."""
    return predictions.vocabulary(predictions.csv_headers(spark, _detail_files(spark, d)))


@query("""SELECT model, '/t/' || vec_id AS path, label::VARCHAR AS label, round(embedding[1]::DOUBLE, 6) AS even, CASE WHEN model = 'a' THEN round(embedding[2]::DOUBLE, 6) END AS odd, CASE WHEN model = 'b' THEN round(embedding[3]::DOUBLE, 6) END AS third
FROM embeddings, (SELECT unnest(['a', 'b']) AS model)""")
def model_files(spark, d):
    """Prediction files of two models that know different classes."""
    root = scratch_path(spark, "models")
    e = load(spark, d, "embeddings").select(F.concat(F.lit("/t/"), F.col("vec_id").cast("string")).alias("Path"), F.col("vec_id").cast("string").alias("Filename"), F.col("label").alias("Label"), F.lit("x").alias("Pred"), *(F.round(F.get("embedding", F.lit(k)).cast("double"), 6).alias(n) for k, n in enumerate(("even", "odd", "third"))))
    for name, dropped in (("a", "third"), ("b", "odd")):
        files = materialize(e.drop(dropped), "model")
        files.coalesce(1).write.option("header", "true").csv(f"{root}/{name}")
        _rename_part(spark, f"{root}/{name}", f"{root}/run_{name}_Preds.csv")
    rows, classes = predictions.read_models(spark, root, prefix="run_", suffix="_Preds.csv")
    return rows.select("model", F.col("Path").alias("path"), F.col("Label").alias("label"), *classes)


def _rename_part(spark: SparkSession, folder: str, to: str) -> None:
    """The only part file of a folder under a name of its own."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-"))
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(to))
    fs.delete(at, True)


# --- counters, joins, samples -----------------------------------------------------------------


@query("SELECT count(*) FILTER (p_size <= 25 AND p_partkey % 7 <> 0) AS passed, count(*) FILTER (p_size > 25 AND p_partkey % 7 <> 0) AS rejected, count(*) FILTER (p_partkey % 7 = 0) AS errors, count(*) AS total FROM part")
def run_counters(spark, d):
    """Counters of a run's images, taken while they are written."""
    rows = load(spark, d, "part").withColumn("error", F.when(F.col("p_partkey") % 7 == 0, "damaged"))
    seen_rows, seen = counters.observed(rows, "images", F.col("p_size") <= 25)
    materialize(seen_rows, "counted")
    got = seen.get
    return spark.createDataFrame([tuple(got[k] for k in ("passed", "rejected", "errors", "total"))], "passed bigint, rejected bigint, errors bigint, total bigint")


@query("SELECT p_brand, count(*) FILTER (p_size <= 25 AND p_partkey % 7 <> 0) AS passed, count(*) FILTER (p_size > 25 AND p_partkey % 7 <> 0) AS rejected, count(*) FILTER (p_partkey % 7 = 0) AS errors, count(*) AS total FROM part GROUP BY 1")
def run_counters_by_group(spark, d):
    rows = load(spark, d, "part").withColumn("error", F.when(F.col("p_partkey") % 7 == 0, "damaged"))
    return counters.counts(rows, F.col("p_size") <= 25, "p_brand")


@query("SELECT 'read' AS stage, p_partkey, 'damaged ' || p_brand AS error FROM part WHERE p_partkey % 7 = 0")
def error_side_table(spark, d):
    rows = load(spark, d, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("damaged "), "p_brand")).alias("error"))
    path = scratch_path(spark, "errors")
    counters.separate_errors(rows, path, "read", "reading")
    return counters.error_table(spark, path).select("stage", F.get_json_object("row", "$.p_partkey").cast("bigint").alias("p_partkey"), "error")


@query("""WITH s AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS bin, event_type, count(*)::DOUBLE AS total_counts, min(value) AS lat FROM events GROUP BY ALL)
SELECT event_id, total_counts, lat FROM events JOIN s ON s.bin = time_bucket(INTERVAL '10 minutes', ts) AND s.event_type = events.event_type""")
def summary_attached(spark, d):
    e = load(spark, d, "events").withColumn("bin", X.bin_start("ts"))
    summary = e.groupBy("bin", "event_type").agg(F.count("*").cast("double").alias("total_counts"), F.min("value").alias("lat"))
    return stats.attach_summary(e, summary, ["bin", "event_type"], ["total_counts", "lat"]).select("event_id", "total_counts", "lat")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('7' || event_id), event_id) AS r FROM events) WHERE r <= 300")
def grabbed_300(spark, d):
    return sampling.per_class(load(spark, d, "events").select("event_type", "event_id"), "event_type", "event_id", 300, 7).drop("draw")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, d):
    return load(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


@query(f"SELECT event_id FROM ({_T}) WHERE event_id % 13 <> 0")
def placed_points(spark, d):
    """Points without a place left out."""
    return _points(spark, d).withColumn("lat", F.when(F.col("event_id") % 13 == 0, None).otherwise(F.col("lat"))).na.drop(subset=["lat", "lon"]).select("event_id")


@query("""WITH s AS (SELECT event_type, epoch(max(ts) - min(ts)) / 86400.0 AS days, min(ts) AS lo FROM events GROUP BY 1),
u AS (SELECT event_type, unnest([1, 3, 12]) AS factor, days FROM s)
SELECT event_type, factor, CASE WHEN days * factor <= 30 THEN 'hour' WHEN days * factor <= 90 THEN 'day' ELSE 'week' END AS unit FROM u""")
def granularity(spark, d):
    spans = load(spark, d, "events").groupBy("event_type").agg(((F.unix_micros(F.max("ts").cast("timestamp_ltz")) - F.unix_micros(F.min("ts").cast("timestamp_ltz"))) / 86_400_000_000.0).alias("days"))
    return spans.select("event_type", F.explode(F.array(*map(F.lit, (1, 3, 12)))).alias("factor"), "days").select("event_type", "factor", stats.unit_of(F.col("days") * F.col("factor")).alias("unit"))


@query("""SELECT doc_id, coalesce(quality, -1) AS quality, lang, CASE WHEN lang IS NULL THEN 'labels' WHEN quality IS NULL THEN 'documents' ELSE 'both' END AS side FROM labels FULL JOIN (SELECT doc_id, lang FROM documents WHERE doc_id % 3 <> 0) USING (doc_id)""")
def side_by_side_columns(spark, d):
    docs = load(spark, d, "documents").filter(F.col("doc_id") % 3 != 0).select("doc_id", "lang")
    both = curation.side_columns(load(spark, d, "labels").select("doc_id", "quality"), docs, "doc_id")
    side = F.when(F.col("lang").isNull(), "labels").when(F.col("quality").isNull(), "documents").otherwise("both")
    return both.withColumn("side", side).withColumn("quality", F.coalesce("quality", F.lit(-1)))


@query(f"SELECT doc_id FROM ({_RECORDS}) WHERE bubble_score <= 0.5 AND object_count >= 2")
def score_filter(spark, d):
    return _records(spark, d).filter(exports.exportable(0.5, 2)).select("doc_id")


@query("SELECT string_split(url, '/')[3] AS folder, count(*) AS n_files FROM pages GROUP BY 1")
def files_per_folder(spark, d):
    host = F.split_part("url", F.lit("/"), F.lit(3))
    files = load(spark, d, "pages").select(F.concat(host, F.when(F.col("page_id") % 2 == 0, "/").otherwise("\\"), F.col("page_id").cast("string")).alias("path"))
    return curation.files_per_folder(files)


@query("""SELECT p_partkey, CASE WHEN n = 0 THEN p_brand ELSE strftime(DATE '2024-01-01' + (p_partkey % 300)::INT, '%Y%m%d') || '000000_' || n || '_' || p_brand END AS kept_as
FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey % 300, p_partkey) - 1 AS n FROM part)""")
def quarantine_names(spark, d):
    files = load(spark, d, "part").select("p_partkey", "p_brand", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 300).cast("int")).cast("timestamp_ntz").alias("seen"))
    return curation.quarantine(files, "p_brand", "seen", "p_partkey").select("p_partkey", "kept_as")


# --- scalars -----------------------------------------------------------------------------------


@query("""SELECT event_id, round((CASE WHEN event_id % 2 = 0 THEN -1 ELSE 1 END) * (event_id % 90 + (event_id % 60) / 60.0 + (event_id % 3600) / 3600.0), 9)::DOUBLE AS degrees, CASE WHEN event_id % 2 = 0 AND (event_id % 90 + event_id % 60 + event_id % 3600) > 0 THEN 'S' ELSE 'N' END AS side FROM events""")
def decimal_degrees(spark, d):
    value = X.dms(F.col("event_id") % 90, F.col("event_id") % 60, F.col("event_id") % 3600, F.when(F.col("event_id") % 2 == 0, "s").otherwise("N"))
    return load(spark, d, "events").select("event_id", F.round(value, 9).alias("degrees"), X.hemisphere(value, "N", "S").alias("side"))


_SHAPED = "SELECT l_orderkey, l_linenumber, l_extendedprice AS area, l_quantity * 10 AS perimeter, l_quantity AS minor_axis_length, l_quantity + 1 + l_linenumber AS major_axis_length, l_linenumber AS bbox_height, l_quantity AS bbox_width, l_tax AS standard_deviation_intensity, l_discount AS mean_intensity, l_partkey AS mean_distance_to_centroid, l_suppkey AS mean_distance_to_mass_center FROM lineitem"


@query(f"""SELECT l_orderkey, l_linenumber, round(minor_axis_length / (major_axis_length + 1e-6), 6)::DOUBLE AS aspect_ratio, round(bbox_width / (bbox_height + 1e-6), 4)::DOUBLE AS bbox_aspect_ratio, round(area / (bbox_width * bbox_height + 1e-6), 3)::DOUBLE AS extent_derived,
round(standard_deviation_intensity / (mean_intensity + 1e-6), 2)::DOUBLE AS intensity_cv, round(mean_distance_to_centroid / (mean_distance_to_mass_center + 1e-6), 4)::DOUBLE AS centroid_mass_center_ratio, round(4 * pi() * area / (perimeter * perimeter + 1e-6), 6)::DOUBLE AS circularity FROM ({_SHAPED})""")
def shape_ratios(spark, d):
    o = load(spark, d, "lineitem")
    names = {"area": F.col("l_extendedprice"), "perimeter": F.col("l_quantity") * 10, "minor_axis_length": F.col("l_quantity"), "major_axis_length": F.col("l_quantity") + 1 + F.col("l_linenumber"), "bbox_height": F.col("l_linenumber"), "bbox_width": F.col("l_quantity"), "standard_deviation_intensity": F.col("l_tax"), "mean_intensity": F.col("l_discount"), "mean_distance_to_centroid": F.col("l_partkey"), "mean_distance_to_mass_center": F.col("l_suppkey")}
    made = rules.derive_shapes(o.select("l_orderkey", "l_linenumber", *(c.alias(n) for n, c in names.items())))
    digits = {"aspect_ratio": 6, "bbox_aspect_ratio": 4, "extent_derived": 3, "intensity_cv": 2, "centroid_mass_center_ratio": 4, "circularity": 6}
    return made.select("l_orderkey", "l_linenumber", *(F.round(n, k).alias(n) for n, k in digits.items()))


_OD = "SELECT l_orderkey, l_linenumber, l_discount AS mean, (l_linenumber % 4)::DOUBLE AS background, l_extendedprice AS area, l_quantity AS perimeter FROM lineitem"


@query(f"""SELECT l_orderkey, l_linenumber, round(mean / nullif(background, 0), 9) AS ratio, round((background - mean) / nullif(background, 0), 9) AS contrast, round(4 * pi() * area / (perimeter * perimeter + 1e-10), 4) AS circularity,
CASE WHEN background <> 0 THEN round(greatest(0, -log10((mean + 0.01) / nullif(background, 0) + 1e-10)), 6) END AS density FROM ({_OD})""")
def optical_features(spark, d):
    o = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("mean"), (F.col("l_linenumber") % 4).cast("double").alias("background"), F.col("l_extendedprice").alias("area"), F.col("l_quantity").alias("perimeter"))
    back = F.nullif("background", F.lit(0.0))
    return o.select("l_orderkey", "l_linenumber", F.round(X.intensity_ratio("mean", "background"), 9).alias("ratio"), F.round(X.intensity_contrast("mean", "background"), 9).alias("contrast"), F.round(X.od_circularity("area", "perimeter"), 4).alias("circularity"), F.when(back.isNotNull(), F.round(X.optical_density(F.col("mean") + 0.01, back), 6)).alias("density"))


@query("""SELECT event_id, round((CASE WHEN event_id % 5 IN (0, 1, 2, 3) THEN 0 ELSE value END - 3.5) / 2.5, 6) AS x FROM events""")
def finite_vectors(spark, d):
    """Not-a-number, infinities and nulls as 0, then standardised."""
    value = F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("double")).when(F.col("event_id") % 5 == 1, F.lit(float("nan"))).when(F.col("event_id") % 5 == 2, F.lit(float("inf"))).when(F.col("event_id") % 5 == 3, F.lit(float("-inf"))).otherwise(F.col("value"))
    return load(spark, d, "events").select("event_id", F.round(X.standardise(X.finite_or_zero(value), 3.5, 2.5), 6).alias("x"))


@query("""SELECT p_partkey, 'zstd_clevel' || p_size || (CASE WHEN p_size % 2 = 0 THEN '_shuffle' ELSE '_noshuffle' END) AS label, trim(regexp_replace('./' || p_name || '?/' || p_brand || '.', '[^A-Za-z0-9._-]+', '_', 'g'), '._') AS name, coalesce(CASE WHEN p_size > 10 THEN p_size END, 300)::INT AS grid FROM part""")
def store_names(spark, d):
    """Names of compressions and stores, and the grid that counts."""
    p = load(spark, d, "part")
    shuffle = F.when(F.col("p_size") % 2 == 0, "shuffle").otherwise("noshuffle")
    return p.select("p_partkey", X.compression_label(F.lit("zstd"), "p_size", shuffle).alias("label"), X.sanitise(F.concat(F.lit("./"), "p_name", F.lit("?/"), "p_brand", F.lit("."))).alias("name"), X.effective_grid(F.when(F.col("p_size") > 10, F.col("p_size")), F.lit(300)).cast("int").alias("grid"))


@query("""SELECT page_id, '/mnt/c/' || replace(replace(url, 'https://', ''), 'http://', '') AS portable, 'C:\\' || replace(replace(replace(url, 'https://', ''), 'http://', ''), '/', '\\') AS drive, page_id::VARCHAR AS model FROM pages""")
def paths_between_systems(spark, d):
    inner = F.replace(F.replace("url", F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    windows = F.concat(F.lit("C:\\"), F.replace(inner, F.lit("/"), F.lit("\\")))
    p = load(spark, d, "pages").select("page_id", windows.alias("p"), F.concat(F.lit("preds_"), F.col("page_id").cast("string"), F.lit("_test.csv")).alias("f"))
    return p.select("page_id", X.portable_path("p").alias("portable"), X.drive_path(X.portable_path("p")).alias("drive"), X.strip_affixes("f", "preds_", "_test.csv").alias("model"))


@query("SELECT o_orderkey, format('{:,}', o_orderkey * 1000 + 7) AS number FROM orders")
def numbers_with_commas(spark, d):
    return load(spark, d, "orders").select("o_orderkey", X.thousands(F.col("o_orderkey") * 1000 + 7).alias("number"))


_COMMON = f"""SELECT bucket, n, h, w, CASE WHEN wide THEN 'uint16' ELSE 'uint8' END AS dtype, c FROM (
SELECT CAST(ceil(height / 300.0) * 300 AS INT) || 'x' || CAST(ceil(width / 300.0) * 300 AS INT) AS bucket, count(*) AS n, min(CAST(ceil(height / 300.0) * 300 AS INT)) AS h, min(CAST(ceil(width / 300.0) * 300 AS INT)) AS w, bool_or(dtype = 'uint16') AS wide, max(channels) AS c FROM ({_P}) GROUP BY 1)"""


@query(f"""WITH m AS (SELECT *, unnest([0, 1, 2]) AS level FROM ({_COMMON})), s AS (SELECT *, CAST(ceil(h / pow(2, level)) AS INT) AS lh, CAST(ceil(w / pow(2, level)) AS INT) AS lw FROM m)
SELECT bucket, level::INT AS level, n AS n_images, dtype, n || ',' || lh || ',' || lw || CASE WHEN c > 1 THEN ',' || c ELSE '' END AS shape, '1,' || least(300, lh, lw) || ',' || least(300, lh, lw) || CASE WHEN c > 1 THEN ',' || c ELSE '' END AS chunks, 'zstd_clevel5_shuffle' AS compression FROM s""")
def store_manifest(spark, d):
    """Shapes, chunks and types of the multi-scale stores that all parts' images would make."""
    rows = stats.assign_buckets(_images(spark, d), 300)
    told = arrays.manifest(rows, 300, 3, 2, arrays.Codec("zstd", 5, True))
    spelled = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return told.select("bucket", "level", "n_images", "dtype", spelled("shape"), spelled("chunks"), "compression")


@query("SELECT p_brand AS image_id, p_partkey AS label, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 6 <> 0 THEN p_size / 2.0 ELSE p_size / 4.0 END::DOUBLE AS mean_optical_density, p_size FROM part")
def local_background(spark, d):
    """Features by an object's own surroundings where these could be told, by the whole image's else."""
    p = load(spark, d, "part").select(F.col("p_brand").alias("image_id"), F.col("p_partkey").alias("label"), "p_size")
    whole = p.withColumn("mean_optical_density", F.col("p_size") / 4.0)
    near = p.withColumn("mean_optical_density", F.when((F.col("label") % 2 == 0) & (F.col("label") % 6 != 0), F.col("p_size") / 2.0)).drop("p_size")
    return rules.combine_first(near, whole, ["image_id", "label"])


# --- detail rows, side-cars, verdicts, orders -----------------------------------------------------

_VOCABULARY = [f"class_{k:02}" for k in range(64)]
_SHOT = """SELECT vec_id, '/survey/2024-01-0' || (vec_id % 6 + 1) || '/run_' || lpad((vec_id % 3 + 10)::VARCHAR, 2, '0') || '20.tar' AS tar_path, CASE WHEN vec_id % 40 = 0 THEN 'x/Background.tif' ELSE 'RawImages\\' || 'pi' || (vec_id % 9) || '.2024.' || vec_id || '.tif' END AS id, embedding FROM embeddings"""


def _shots(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as probabilities of 64 classes of images in archives."""
    key = F.col("vec_id")
    path = F.concat(F.lit("/survey/2024-01-0"), (key % 6 + 1).cast("string"), F.lit("/run_"), F.lpad((key % 3 + 10).cast("string"), 2, "0"), F.lit("20.tar"))
    name = F.when(key % 40 == 0, "x/Background.tif").otherwise(F.concat(F.lit("RawImages\\pi"), (key % 9).cast("string"), F.lit(".2024."), key.cast("string"), F.lit(".tif")))
    return load(spark, d, "embeddings").select("vec_id", path.alias("tar_path"), name.alias("id"), F.col("embedding").alias("probs"))


@query(f"""WITH p AS (SELECT *, list_position(embedding, list_max(embedding)) - 1 AS k FROM ({_SHOT}) WHERE id NOT LIKE '%Background.tif%')
SELECT vec_id, 'cruise' AS cruise_name, k::INT AS pred_id, 'class_' || lpad(k::VARCHAR, 2, '0') AS pred_label, round(list_max(embedding)::DOUBLE, 6) AS pred_conf, regexp_extract(tar_path, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AS date, (vec_id % 3 + 10) || ':20' AS time,
(regexp_extract(tar_path, '\\d{{4}}-\\d{{2}}-\\d{{2}}') || ' ' || (vec_id % 3 + 10) || ':20:00')::TIMESTAMP AS datetime, first_value(string_split(string_split(id, '\\')[-1], '.')[1]) OVER (PARTITION BY tar_path ORDER BY id) AS instrument_code, round(embedding[6]::DOUBLE, 6) AS class_05_conf FROM p""")
def detail_rows(spark, d):
    """Detail rows of classified images: labels, confidences, instrument, date and time of the bin, without backgrounds."""
    rows = predictions.widen(predictions.detail(_shots(spark, d), _VOCABULARY, "cruise"), _VOCABULARY)
    return rows.select("vec_id", "cruise_name", "pred_id", "pred_label", F.round(F.col("pred_conf").cast("double"), 6).alias("pred_conf"), "date", "time", "datetime", "instrument_code", F.round(F.col("class_05_conf").cast("double"), 6).alias("class_05_conf"))


@query("""WITH l AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS bin, user_id AS hits, event_id % 4 AS misses FROM events)
SELECT strftime(bin, '%Y%m%d%H%M') AS bin, sum(hits)::BIGINT AS hits, sum(misses)::BIGINT AS misses, round(CASE WHEN sum(hits) + sum(misses) = 0 THEN 0 ELSE sum(hits) / (sum(hits) + sum(misses)) END, 9)::DOUBLE AS subsample_factor FROM l GROUP BY 1""")
def side_car_totals(spark, d):
    """Hits and misses of each archive's side-car, a text of lines as archives hold it."""
    e = load(spark, d, "events").select(F.date_format(X.bin_start("ts"), "yyyyMMddHHmm").alias("bin"), F.concat(F.col("user_id").cast("string"), F.lit(","), (F.col("event_id") % 4).cast("string")).alias("line"))
    texts = e.groupBy("bin").agg(F.concat(F.array_join(F.collect_list("line"), "\r\n"), F.lit("\n\n")).alias("text"))
    members = texts.select(F.col("bin").alias("tar_path"), F.lit("HitsMisses.txt").alias("name"), F.col("text").cast("binary").alias("content"))
    return stats.hits_and_misses(tar.hits_misses(members), "tar_path").select(F.col("tar_path").alias("bin"), "hits", "misses", F.round("subsample_factor", 9).alias("subsample_factor"))


@query("""WITH b AS (SELECT event_type, arg_min(value, event_id) AS lat FROM events WHERE user_id % 3 = 0 AND event_type <> 'view' GROUP BY 1)
SELECT event_id, lat FROM events LEFT JOIN b USING (event_type)""")
def background_places(spark, d):
    """Each image's place, that of its archive's background; none where an archive has no background."""
    e = load(spark, d, "events")
    places = e.filter((F.col("user_id") % 3 == 0) & (F.col("event_type") != "view")).groupBy("event_type").agg(F.min_by("value", "event_id").alias("lat"))
    return e.join(places, "event_type", "left").select("event_id", "lat")


_VERDICT = "SELECT l_orderkey AS o_orderkey, avg((l_quantity > 25)::INT) > 0.5 AS is_bubble, count(*) AS object_count FROM lineitem WHERE l_linenumber <> 2 GROUP BY 1"


@query(f"SELECT o_orderkey, coalesce(object_count, 0)::BIGINT AS object_count FROM orders LEFT JOIN ({_VERDICT}) USING (o_orderkey) WHERE NOT coalesce(is_bubble, false)")
def artefact_filter(spark, d):
    """Images that are no artefacts; those without a verdict, as after an error, stay."""
    objects = load(spark, d, "lineitem").filter("l_linenumber <> 2").select(F.col("l_orderkey").alias("image_id"), (F.col("l_quantity") > 25).alias("is_bubble"), F.lit(0.5).alias("bubble_score"))
    kept = rules.apply_verdict(load(spark, d, "orders").select(F.col("o_orderkey").alias("image_id")), rules.image_vote(objects))
    return kept.select(F.col("image_id").alias("o_orderkey"), F.col("object_count").cast("bigint").alias("object_count"))


@query(f"""SELECT bucket, count, row_number() OVER (ORDER BY count DESC, bucket) AS by_count, row_number() OVER (ORDER BY h * w, bucket) AS by_size FROM (
SELECT CAST(ceil(height / 300.0) * 300 AS INT) || 'x' || CAST(ceil(width / 300.0) * 300 AS INT) AS bucket, count(*) AS count, min(CAST(ceil(height / 300.0) * 300 AS INT)) AS h, min(CAST(ceil(width / 300.0) * 300 AS INT)) AS w FROM ({_P}) GROUP BY 1)""")
def bucket_order(spark, d):
    """Places of the buckets by their images, most first, and by their pixels, fewest first."""
    told = stats.bucket_stats(stats.assign_buckets(_images(spark, d), 300)).select("bucket", "count", X.parse_bucket("bucket").alias("size"))
    sized = told.withColumn("pixels", X.pixel_count("size.height", "size.width")).drop("size")
    by_count = ranges.positions(sized, F.desc("count"), F.col("bucket"), name="by_count")
    return ranges.positions(by_count, F.col("pixels"), F.col("bucket"), name="by_size").drop("pixels")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS place FROM part")
def places_in_order(spark, d):
    """Every part's place by price, numbered without one task that sorts all."""
    return ranges.positions(load(spark, d, "part").select("p_partkey", "p_retailprice"), F.desc("p_retailprice"), F.col("p_partkey"), name="place").drop("p_retailprice")


@query(f"""SELECT bucket, p_partkey, (row_number() OVER (PARTITION BY bucket ORDER BY p_partkey) - 1)::INT AS index, height || ',' || width || CASE WHEN channels > 1 THEN ',3' ELSE '' END AS shape, dtype
FROM (SELECT *, CAST(ceil(height / 300.0) * 300 AS INT) || 'x' || CAST(ceil(width / 300.0) * 300 AS INT) AS bucket FROM ({_P}))""")
def record_table(spark, d):
    """Grouped images as records with their index, shape and type."""
    rows = stats.assign_buckets(_images(spark, d), 300).withColumn("tar_path", F.lit("t")).withColumn("member_idx", F.col("p_partkey")).withColumn("filename", F.col("p_partkey").cast("string"))
    return curation.record_table(rows).select("bucket", F.col("filename").cast("bigint").alias("p_partkey"), "index", F.array_join(F.col("shape").cast("array<string>"), ",").alias("shape"), "dtype")


@query("SELECT p_brand AS tar_path, string_agg(p_name, ',' ORDER BY p_partkey) AS names FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) WHERE r <= 10 GROUP BY 1")
def first_names(spark, d):
    members = load(spark, d, "part").select(F.col("p_brand").alias("tar_path"), F.col("p_partkey").alias("member_idx"), F.col("p_name").alias("name"))
    return curation.first_names(members).select("tar_path", F.array_join("names", ",").alias("names"))


# --- pixels -----------------------------------------------------------------------------------------
# Vectors of 64 numbers stand for grey images of 8 x 8.

_PIXELS = "SELECT vec_id, label, list_transform(embedding, lambda x: least(255, floor(abs(CAST(x AS DOUBLE)) * 255))::INT) AS p FROM embeddings"


def _pixels(spark: SparkSession, d: str) -> DataFrame:
    byte = F.transform("embedding", lambda x: F.lpad(F.hex(F.least(F.lit(255), F.floor(F.abs(x.cast("double")) * 255)).cast("int")), 2, "0"))
    rows = load(spark, d, "embeddings").select("vec_id", "label", F.unhex(F.array_join(byte, "")).alias("pixels"))
    return rows.withColumns({"height": F.lit(8), "width": F.lit(8), "channels": F.lit(1), "ndim": F.lit(2), "dtype": F.lit("uint8")})


@query(f"""WITH i AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS z, list_transform(p, lambda n: format('{{:02x}}', n)) AS h FROM ({_PIXELS})), t AS (SELECT *, unnest([0, 1]) AS ty FROM i), u AS (SELECT *, unnest([0, 1]) AS tx FROM t)
SELECT z || '.' || ty || '.' || tx AS chunk, array_to_string(list_concat(h[ty * 32 + tx * 4 + 1 : ty * 32 + tx * 4 + 4], list_concat(h[ty * 32 + tx * 4 + 9 : ty * 32 + tx * 4 + 12], list_concat(h[ty * 32 + tx * 4 + 17 : ty * 32 + tx * 4 + 20], h[ty * 32 + tx * 4 + 25 : ty * 32 + tx * 4 + 28]))), '') AS bytes FROM u""")
def array_store_chunks(spark, d):
    """Chunk files of a store that has been written and published."""
    root = scratch_path(spark, "stores")
    rows = stats.truncate_buckets(stats.assign_buckets(_pixels(spark, d), 8), 1 << 30, "vec_id")
    arrays.write_stores(rows, root, tile=4, codec=arrays.Codec("none"))
    return arrays.read_chunks(spark, f"{root}/bucket_8x8.zarr/0").select("chunk", F.lower(F.hex("data")).alias("bytes"))


def _brightness():
    """A model that tells how bright an image is; those whose first pixel is 1 of 255 fail with their whole batch."""

    def model(x):
        grey = x[:, 0] * 0.229 + 0.485
        if (abs(grey[:, 0, 0] * 255 - 1) < 0.01).any():
            raise ValueError("no such pixel")
        m = grey.mean(axis=(1, 2))
        return np.stack([m, 1 - m], 1)

    return model


@query(f"SELECT vec_id, CASE WHEN p[1] <> 1 THEN list_sum(p)::BIGINT ELSE -1 END AS brightness, p[1] = 1 AS quarantined FROM ({_PIXELS})")
def batch_inference(spark, d):
    """Results of a model in batches, some of whose images it cannot take."""
    found = inference.classify(_pixels(spark, d), _brightness, 2, size=8, batch_size=32)
    brightness = F.round(F.get("probs", F.lit(0)).cast("double") * 64 * 255).cast("bigint")
    return found.select("vec_id", F.coalesce(brightness, F.lit(-1)).alias("brightness"), F.col("error").isNotNull().alias("quarantined"))


@query("SELECT label, count(*) AS n, sum(list_sum(p))::BIGINT AS brightness, max(vec_id) AS last FROM (" + _PIXELS + ") GROUP BY 1")
def bucket_hook(spark, d):
    """What a processor makes of each group, batch by batch."""

    def process(label, batches):
        n = brightness = last = 0
        for b in batches:
            n, last = n + b.num_rows, max(last, *b.column("vec_id").to_pylist())
            brightness += sum(sum(p) for p in b.column("pixels").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([n]), pa.array([brightness]), pa.array([last])], ["label", "n", "brightness", "last"])

    return inference.process_buckets(_pixels(spark, d), process, "label int, n bigint, brightness bigint, last bigint", "label")
