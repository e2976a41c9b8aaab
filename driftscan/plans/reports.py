"""Named queries: the operators on the driver's tables, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftscan import functions as X
from driftscan.operators import curation, evaluation, rules, sampling, stats
from driftscan.session import load
from driftscan.sources.tar import EXTENSIONS

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The event stream as image rows: class, density and confidence, with an identifier and a place."""
    e = load(spark, d, "events")
    return e.select("event_id", "ts", "user_id", F.col("event_type").alias("pred_label"), F.col("value").cast("decimal(18,2)").alias("density"), (F.col("value") / 1000.0).alias("pred_conf"), F.get_json_object("props", "$.k").cast("int").alias("k"))


_E = "SELECT event_id, ts, user_id, event_type AS pred_label, CAST(value AS DECIMAL(18,2)) AS density, value / 1000.0 AS pred_conf, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"


def _images(spark: SparkSession, d: str) -> DataFrame:
    """Parts as images with sizes, dtypes and channels."""
    p = load(spark, d, "part")
    return p.select("p_partkey", "p_name", "p_brand", (F.col("p_size") * 37).alias("height"), ((F.col("p_partkey") % 60 + 1) * 23).cast("int").alias("width"), F.when(F.col("p_partkey") % 2 == 0, "uint8").otherwise("uint16").alias("dtype"), F.when(F.col("p_partkey") % 3 == 0, 3).otherwise(1).alias("channels"))


_P = "SELECT p_partkey, p_name, p_brand, p_size * 37 AS height, CAST((p_partkey % 60 + 1) * 23 AS INT) AS width, CASE WHEN p_partkey % 2 = 0 THEN 'uint8' ELSE 'uint16' END AS dtype, CASE WHEN p_partkey % 3 = 0 THEN 3 ELSE 1 END AS channels FROM part"
_B = f"SELECT *, CAST(ceil(height / 300.0) * 300 AS INT) AS bucket_h, CAST(ceil(width / 300.0) * 300 AS INT) AS bucket_w, CAST(CAST(ceil(height / 300.0) * 300 AS INT) AS VARCHAR) || 'x' || CAST(CAST(ceil(width / 300.0) * 300 AS INT) AS VARCHAR) AS bucket FROM ({_P})"


def _points(spark: SparkSession, d: str) -> DataFrame:
    """Events as track points with places that depend on user and event."""
    e = load(spark, d, "events")
    return e.select("event_id", "user_id", "ts", F.when(F.col("event_id") % 97 == 0, 0.0).otherwise(48.0 + F.col("user_id") % 100 / 10.0 + F.col("event_id") % 7 / 100.0).alias("lat"), F.when(F.col("event_id") % 97 == 0, 0.0).otherwise(2.0 + F.col("user_id") % 50 / 10.0 + F.col("event_id") % 11 / 100.0).alias("lon"))


_T = "SELECT event_id, user_id, ts, CASE WHEN event_id % 97 = 0 THEN 0.0 ELSE 48.0 + (user_id % 100) / 10.0 + (event_id % 7) / 100.0 END::DOUBLE AS lat, CASE WHEN event_id % 97 = 0 THEN 0.0 ELSE 2.0 + (user_id % 50) / 10.0 + (event_id % 11) / 100.0 END::DOUBLE AS lon FROM events"


def _probs(spark: SparkSession, d: str, start: int = 1, n: int = 64) -> DataFrame:
    """Embeddings as class scores of 64 classes, or of n from one on."""
    return load(spark, d, "embeddings").select("vec_id", "label", F.slice("embedding", start, n).alias("probs"))


_V = "SELECT vec_id, label, embedding AS probs FROM embeddings"
_VP = f"SELECT vec_id, label, list_position(probs, list_max(probs)) - 1 AS pred, list_max(probs) AS conf FROM ({_V})"
CLASSES = [f"c{k}" for k in range(64)]


def _preds(spark: SparkSession, d: str, start: int = 1, n: int = 64) -> DataFrame:
    return _probs(spark, d, start, n).select("vec_id", "label", X.argmax("probs").alias("pred"), F.array_max("probs").alias("conf"))


def _objects(spark: SparkSession, d: str) -> DataFrame:
    """Line items as objects of an image, their numbers scaled into shape features."""
    o = load(spark, d, "lineitem")
    return o.select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("label"), (F.col("l_discount") / 4).alias("mean_optical_density"), (1 - F.col("l_tax")).alias("solidity"), (F.col("l_quantity") / 100).alias("eccentricity"), (1 - F.col("l_tax") / 2).alias("intensity_ratio"), F.col("l_extendedprice").alias("area"), (F.col("l_quantity") * 10).alias("perimeter"))


_O = "SELECT l_orderkey AS image_id, l_linenumber AS label, l_discount / 4 AS mean_optical_density, 1 - l_tax AS solidity, l_quantity / 100 AS eccentricity, 1 - l_tax / 2 AS intensity_ratio, l_extendedprice AS area, l_quantity * 10 AS perimeter FROM lineitem"


# --- class statistics and bins -------------------------------------------------


@query(f"""SELECT pred_label, count(*) AS n_images, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events) AS pct, min(density)::DOUBLE AS min_density, round(avg(density), 6) AS mean_density, max(density)::DOUBLE AS max_density,
  min(pred_conf * 100) AS min_confidence, round(avg(pred_conf * 100), 6) AS mean_confidence, max(pred_conf * 100) AS max_confidence FROM ({_E}) GROUP BY pred_label""")
def class_statistics(spark, d):
    s = stats.class_statistics(_events(spark, d))
    return s.select("pred_label", "n_images", "pct", F.col("min_density").cast("double").alias("min_density"), F.round(F.col("mean_density").cast("double"), 6).alias("mean_density"), F.col("max_density").cast("double").alias("max_density"), "min_confidence", F.round("mean_confidence", 6).alias("mean_confidence"), "max_confidence").orderBy("pred_label")


@query(f"SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, pred_label, count(*)::DOUBLE AS total_counts, round(avg(pred_conf), 9) AS mean_pred_conf FROM ({_E}) GROUP BY 1, 2")
def bin_summary(spark, d):
    return stats.bin_summary(_events(spark, d), "ts", "pred_label", ["pred_conf"]).withColumn("mean_pred_conf", F.round("mean_pred_conf", 9))


_DENSITY = f"""WITH e AS ({_E}), s AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, pred_label, count(*)::DOUBLE AS total_counts FROM e GROUP BY 1, 2),
f AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, sum(k) AS h, sum(100 - k) AS m FROM e GROUP BY 1),
x AS (SELECT s.*, CASE WHEN h + m = 0 THEN 0.0 ELSE h / (h + m)::DOUBLE END AS f FROM s JOIN f USING (window_start))"""


def _binned_density(spark, d):
    e = _events(spark, d)
    summary = stats.bin_summary(e, "ts", "pred_label", [])
    lines = e.select(X.bin_start("ts").alias("window_start"), F.col("k").cast("bigint").alias("hits"), (100 - F.col("k")).cast("bigint").alias("misses"))
    return stats.add_density(summary, stats.hits_and_misses(lines, "window_start"), ["window_start"])


@query(_DENSITY + " SELECT window_start, pred_label, total_counts, round(f, 9) AS subsample_factor, CASE WHEN f = 0 THEN 'infinity'::DOUBLE ELSE round(total_counts / f / 340.0, 9) END AS density FROM x")
def bin_density(spark, d):
    return _binned_density(spark, d).select("window_start", "pred_label", "total_counts", F.round("subsample_factor", 9).alias("subsample_factor"), F.when(F.col("density") == float("inf"), F.col("density")).otherwise(F.round("density", 9)).alias("density"))


@query("SELECT l_returnflag, count(*)::DOUBLE AS total_counts, 'infinity'::DOUBLE AS density FROM lineitem GROUP BY 1")
def density_zero_factor(spark, d):
    c = load(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count("*").cast("double").alias("total_counts"))
    return c.withColumn("density", X.density("total_counts", F.lit(0.0)))


@query(_DENSITY + " SELECT window_start, pred_label, round(20 + 120 * d / (SELECT max(CASE WHEN f = 0 THEN NULL ELSE total_counts / f END) FROM x), 6) AS marker_size FROM (SELECT *, total_counts / nullif(f, 0) AS d FROM x)")
def marker_size_scaling(spark, d):
    b = _binned_density(spark, d).withColumn("density", F.nullif("density", F.lit(float("inf"))))
    return stats.marker_size(b).select("window_start", "pred_label", F.round("marker_size", 6).alias("marker_size"))


@query(f"SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, round(avg(density), 6) AS mean_density, arg_min(user_id, event_id) AS first_user_id, arg_min(pred_label, event_id) AS first_pred_label FROM ({_E}) GROUP BY 1")
def bin_first_values(spark, d):
    return stats.bin_first_values(_events(spark, d), "ts", "event_id", ["density"], ["user_id", "pred_label"]).withColumn("mean_density", F.round(F.col("mean_density").cast("double"), 6))


@query("SELECT event_id, strftime(ts, '%H%M') AS token, lpad(CAST(floor(CAST(strftime(ts, '%H%M') AS INT) / 10) * 10 AS INT)::VARCHAR, 4, '0') AS bin FROM events WHERE strftime(ts, '%H%M') LIKE '%0'")
def tenth_minute_filter(spark, d):
    e = load(spark, d, "events").select("event_id", X.timestamp_token(F.concat(F.lit("cruise_"), F.date_format("ts", "HHmm"), F.lit(".tar"))).alias("token"))
    return e.filter(X.tenth_minute("token")).withColumn("bin", X.floor_bin("token"))


def _coverage_sql(unit: str, start: str, step: str, extra: str = "") -> str:
    return f"""WITH c AS (SELECT {start} AS u, count(*) AS n, count(DISTINCT floor(epoch(ts) / 600)) AS b FROM events GROUP BY 1),
a AS (SELECT unnest(generate_series(min(u), max(u), INTERVAL {step})) AS u FROM c)
SELECT a.u AS unit_start, coalesce(n, 0) AS count{extra} FROM a LEFT JOIN c ON a.u = c.u"""


@query(_coverage_sql("hour", "date_trunc('hour', ts)", "1 HOUR"))
def coverage_hourly(spark, d):
    return stats.coverage(load(spark, d, "events"), "ts", "hour")


@query(_coverage_sql("day", "date_trunc('day', ts)::TIMESTAMP", "1 DAY"))
def coverage_daily(spark, d):
    return stats.coverage(load(spark, d, "events"), "ts", "day")


@query(_coverage_sql("week", "(date_trunc('day', ts) + INTERVAL 1 DAY * ((8 - isodow(ts)) % 7))::TIMESTAMP", "7 DAY", ", coalesce(b, 0) AS bins, coalesce(b, 0) / 1008.0::DOUBLE AS coverage"))
def coverage_weekly(spark, d):
    return stats.coverage(load(spark, d, "events"), "ts", "week")


@query("SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, count(*) AS count FROM events GROUP BY 1")
def coverage_10m(spark, d):
    return stats.pivot_counts(load(spark, d, "events").select(X.bin_start("ts").alias("window_start")), "window_start")


@query("""WITH e AS (SELECT event_type, time_bucket(INTERVAL '10 minutes', ts) AS slot, value FROM events), m AS (SELECT event_type, slot, avg(value) AS v FROM e GROUP BY ALL),
g AS (SELECT event_type, day, unnest(generate_series(day::TIMESTAMP, day::TIMESTAMP + INTERVAL '23:50:00', INTERVAL 10 MINUTE)) AS slot FROM (SELECT DISTINCT event_type, slot::DATE AS day FROM e))
SELECT event_type, day::VARCHAR AS day, g.slot, round(coalesce(v, 0), 6) AS value FROM g LEFT JOIN m USING (event_type, slot)""")
def day_grid_density(spark, d):
    grid = stats.day_grid(load(spark, d, "events"), "ts", "value", "event_type")
    return grid.withColumn("value", F.round("value", 6)).withColumn("day", F.col("day").cast("string"))


@query('SELECT min(ts) AS start, max(ts) AS "end", count(*) AS n_rows, epoch(max(ts) - min(ts)) / 3600.0 AS hours FROM events')
def survey_extent(spark, d):
    return stats.extent(load(spark, d, "events"), "ts")


_SEG = f"""SELECT *, sum(CASE WHEN gap_min > 10 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS segment_id FROM (
SELECT *, coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 60000000.0, 0) AS gap_min FROM ({_T}))"""


@query(f"SELECT user_id, event_id, round(gap_min + 1e-9, 3)::DOUBLE AS gap_min, segment_id::BIGINT AS segment_id FROM ({_SEG})")
def track_segments(spark, d):
    return stats.track_segments(_points(spark, d), "user_id", "ts", "event_id").select("user_id", "event_id", F.round(F.col("gap_min") + 1e-9, 3).alias("gap_min"), "segment_id")


@query(f"""SELECT user_id, segment_id::BIGINT AS segment_id, 0::BIGINT AS part, count(*)::INT AS n_points, string_agg(event_id || ' ' || round(lon * 100)::INT || ' ' || round(lat * 100)::INT, ',' ORDER BY ts, event_id) AS line
FROM ({_SEG}) GROUP BY user_id, segment_id HAVING count(*) > 1""")
def segment_lines(spark, d):
    lines = stats.segment_lines(stats.track_segments(_points(spark, d), "user_id", "ts", "event_id"), "user_id", "ts", "event_id")
    point = lambda p: F.concat_ws(" ", p["event_id"].cast("string"), F.round(p["lon"] * 100).cast("int").cast("string"), F.round(p["lat"] * 100).cast("int").cast("string"))
    return lines.select("user_id", "segment_id", "part", "n_points", F.array_join(F.transform("line", point), ",").alias("line"))


def _laea_sql() -> str:
    e2, e = X._E2, X._E
    q = f"({1 - e2!r} * (s / (1 - {e2!r} * s * s) - ln((1 - {e!r} * s) / (1 + {e!r} * s)) / {2 * e!r}))"
    import math

    sb, cb = math.sin(X._BETA0), math.cos(X._BETA0)
    return f"""WITH t AS (SELECT *, sin(radians(lat)) AS s, radians(lon) - {X._LON0!r} AS dl FROM ({_T}) WHERE NOT (lat = 0 AND lon = 0)),
b AS (SELECT *, asin({q} / {X._QP!r}) AS beta FROM t),
r AS (SELECT *, {X._RQ!r} * sqrt(2.0 / (1 + {sb!r} * sin(beta) + {cb!r} * cos(beta) * cos(dl))) AS bb FROM b),
p AS (SELECT user_id, event_id, ts, 4321000.0::DOUBLE + bb * {X._D!r} * cos(beta) * sin(dl) AS x, 3210000.0::DOUBLE + bb / {X._D!r} * ({cb!r} * sin(beta) - {sb!r} * cos(beta) * cos(dl)) AS y FROM r),
l AS (SELECT user_id, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, round(coalesce(sum(sqrt(dx * dx + dy * dy)), 0) / 1000.0, 4)::DOUBLE AS km FROM l GROUP BY user_id"""


@query(_laea_sql())
def track_length_laea(spark, d):
    return stats.track_length(_points(spark, d), "user_id", "ts", "event_id").withColumn("km", F.round("km", 4))


@query(f"SELECT min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat FROM ({_T}) WHERE NOT (lat = 0 AND lon = 0)")
def track_bounds(spark, d):
    return stats.track_bounds(_points(spark, d))


# --- buckets -------------------------------------------------------------------


def _bucket_query(mode: str, sql: str):
    def run(spark, d):
        return stats.assign_buckets(_images(spark, d), 300, mode).select("p_partkey", "bucket_h", "bucket_w", "bucket")

    run.__name__ = f"bucket_assign_{mode}"
    snap = {k: sql.format(v=k) for k in ("height", "width")}
    query(f"SELECT p_partkey, h AS bucket_h, w AS bucket_w, h::VARCHAR || 'x' || w::VARCHAR AS bucket FROM (SELECT p_partkey, CAST({snap['height']} AS INT) AS h, CAST({snap['width']} AS INT) AS w FROM ({_P}))")(run)


_bucket_query("ceil", "ceil({v} / 300.0) * 300")
_bucket_query("floor", "greatest(1, floor({v} / 300.0)) * 300")
_bucket_query("round", "greatest(1, round_even({v} / 300.0, 0)::INT) * 300")
_bucket_query("exact", "{v}")


def _bucketed(spark, d):
    return stats.assign_buckets(_images(spark, d))


@query(f"SELECT bucket, count(*) AS count, min(height) AS min_h, max(height) AS max_h, min(width) AS min_w, max(width) AS max_w, list_aggregate(list_sort(list(DISTINCT dtype)), 'string_agg', ',') AS dtypes, list_aggregate(list_sort(list(DISTINCT channels)), 'string_agg', ',') AS channels FROM ({_B}) GROUP BY bucket")
def bucket_stats(spark, d):
    return stats.bucket_stats(_bucketed(spark, d)).withColumn("dtypes", F.array_join("dtypes", ",")).withColumn("channels", F.array_join(F.transform("channels", lambda c: c.cast("string")), ","))


@query(f"SELECT p_partkey, bucket FROM (SELECT *, count(*) OVER (PARTITION BY bucket) AS n FROM ({_B})) WHERE n >= 20")
def bucket_min_size(spark, d):
    return stats.keep_large_buckets(_bucketed(spark, d), 20).select("p_partkey", "bucket")


@query(f"SELECT p_partkey, bucket, (rn - 1)::INT AS z FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY p_partkey) AS rn FROM ({_B})) WHERE rn <= 10")
def bucket_truncate(spark, d):
    return stats.truncate_buckets(_bucketed(spark, d), 10, "p_partkey").select("p_partkey", "bucket", "z")


@query(f"SELECT bucket, CASE WHEN bool_or(dtype = 'uint16') THEN 'uint16' ELSE 'uint8' END AS dtype, max(channels) AS channels FROM ({_B}) GROUP BY bucket")
def bucket_promotion(spark, d):
    return stats.promote(_bucketed(spark, d))


@query(f"SELECT bucket, count(*) AS before, count(*) FILTER (height >= 600) AS after, count(*) FILTER (NOT height >= 600) AS rejected FROM ({_B}) GROUP BY bucket")
def before_after(spark, d):
    b = _bucketed(spark, d)
    return curation.before_after(b, b.filter("height >= 600"), "bucket")


@query(f"SELECT p_partkey, height, width, height::BIGINT * width AS pixel_count, width / greatest(height, 1)::DOUBLE AS aspect_ratio FROM ({_P}) WHERE width BETWEEN 128 AND 1000 AND height BETWEEN 128 AND 1200")
def size_bounds_filter(spark, d):
    i = _images(spark, d).filter(F.col("width").between(128, 1000) & F.col("height").between(128, 1200))
    return i.select("p_partkey", "height", "width", X.pixel_count("height", "width").alias("pixel_count"), X.aspect_ratio("height", "width").alias("aspect_ratio"))


@query(f"SELECT p_partkey, level, 0.36 * pow(2.0, level) AS scale, (pow(2.0, level) - 1) * 0.36 / 2 AS translation, (ceil(bucket_h / 300.0) * ceil(bucket_w / 300.0))::BIGINT AS chunks FROM ({_B}), (SELECT unnest([0, 1, 2]) AS level)")
def pyramid_transforms(spark, d):
    b = _bucketed(spark, d).withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return b.select("p_partkey", "level", X.pyramid_scale(F.lit(0.36), 2, "level").alias("scale"), X.pyramid_translation(F.lit(0.36), 2, "level").alias("translation"), X.chunk_count(F.lit(1), "bucket_h", "bucket_w", 300).alias("chunks"))


# --- confidences ----------------------------------------------------------------


@query(f"SELECT vec_id, pred::INT AS pred, conf FROM ({_VP})")
def argmax_confidence(spark, d):
    p = _probs(spark, d).withColumn("pred", X.argmax("probs"))
    return p.select("vec_id", "pred", X.confidence("probs", "pred").alias("conf"))


@query(f"""WITH l AS (SELECT label, unnest(probs) AS conf, generate_subscripts(probs, 1) - 1 AS cid FROM ({_V})), m AS (SELECT label, 'c' || cid AS class, avg(conf) AS mc FROM l WHERE cid <> label GROUP BY ALL)
SELECT label, class, round(mc, 9) AS mean_conf, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY mc DESC, class) AS rank FROM m) WHERE rank <= 5""")
def related_classes_top5(spark, d):
    return stats.related_classes(_probs(spark, d), "label", "probs", CLASSES).withColumn("mean_conf", F.round("mean_conf", 9))


@query(f"SELECT count(*) FILTER (conf > 0.2) AS above, count(*) AS n, count(*) FILTER (conf > 0.2) * 100.0::DOUBLE / count(*) AS pct FROM ({_VP})")
def confidence_threshold_share(spark, d):
    return stats.threshold_share(_preds(spark, d), F.col("conf"), 0.2)


@query("WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT least(30, floor((value - lo) * 30 / (hi - lo)) + 1)::INT AS bin, count(*) AS count FROM events, r GROUP BY 1")
def confidence_histogram(spark, d):
    return stats.histogram(load(spark, d, "events"), "value")


#: First class and number of classes of three models, which together know all.
MODELS = ((0, 32), (16, 32), (24, 40))


def _model(spark, d, first: int, n: int) -> DataFrame:
    p = _probs(spark, d, first + 1, n)
    return p.select("vec_id", "label", *(F.get("probs", F.lit(k)).alias(CLASSES[first + k]) for k in range(n)))


def _ensemble_sql() -> str:
    models = " UNION ALL ".join(f"SELECT vec_id, label, {', '.join(f'embedding[{k + 1}] AS c{k}' if f <= k < f + n else f'NULL AS c{k}' for k in range(64))} FROM embeddings" for f, n in MODELS)
    means = ", ".join(f"round(avg(c{k}), 9) AS c{k}" for k in range(64))
    names = ", ".join(CLASSES)
    return f"WITH a AS (SELECT vec_id, label, {means} FROM ({models}) GROUP BY 1, 2) SELECT *, 'c' || (list_position([{names}], greatest({names})) - 1) AS ens_pred, greatest({names}) AS ens_conf FROM a"


@query(_ensemble_sql())
def ensemble_mean_argmax(spark, d):
    e = evaluation.ensemble([_model(spark, d, f, n) for f, n in MODELS], ["vec_id", "label"], CLASSES)
    return e.select("vec_id", "label", *(F.round(c, 9).alias(c) for c in CLASSES), "ens_pred", F.round("ens_conf", 9).alias("ens_conf"))


# --- evaluation ------------------------------------------------------------------

_CELLS = f"WITH p AS ({_VP})"


@query(_CELLS + ", l AS (SELECT DISTINCT label FROM p) SELECT a.label, b.label AS pred, count(p.label) AS count FROM l a CROSS JOIN l b LEFT JOIN p ON p.label = a.label AND p.pred = b.label GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return evaluation.confusion(_preds(spark, d))


_SCORES = _CELLS + """, c AS (SELECT label AS class, 1 AS t, 0 AS p, (label = pred)::INT AS h FROM p UNION ALL SELECT pred, 0, 1, 0 FROM p),
s AS (SELECT class, sum(t) AS support, CASE WHEN sum(p) > 0 THEN sum(h) / sum(p) ELSE 0 END AS precision, CASE WHEN sum(t) > 0 THEN sum(h) / sum(t) ELSE 0 END AS recall FROM c GROUP BY class),
f AS (SELECT class::INT AS class, support::BIGINT AS support, precision::DOUBLE AS precision, recall::DOUBLE AS recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END::DOUBLE AS f1 FROM s)"""


@query(_SCORES + " SELECT class, support, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f WHERE support > 0")
def per_class_metrics(spark, d):
    s = evaluation.class_scores(_preds(spark, d))
    return s.select("class", "support", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


@query(_SCORES + " SELECT round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1 FROM f")
def macro_metrics(spark, d):
    m = evaluation.macro_scores(_preds(spark, d))
    return m.select(*(F.round(c, 9).alias(c) for c in m.columns))


@query(_CELLS + " SELECT count(*) FILTER (label = pred) AS correct, count(*) AS n, avg((label = pred)::INT) AS accuracy FROM p")
def accuracy(spark, d):
    return evaluation.accuracy(_preds(spark, d))


@query(_CELLS + " SELECT label, pred::INT AS pred, count(*) AS count FROM p WHERE label <> pred GROUP BY 1, 2 HAVING count(*) >= 2")
def most_confused_pairs(spark, d):
    return evaluation.most_confused(_preds(spark, d))


@query(f"SELECT vec_id, round(-ln(greatest(probs[label + 1], 1e-12)), 6) AS loss FROM ({_V}) ORDER BY -ln(greatest(probs[label + 1], 1e-12)) DESC, vec_id LIMIT 20")
def top_losses(spark, d):
    return evaluation.top_losses(_probs(spark, d), "probs", "label", 20, "vec_id").select("vec_id", F.round("loss", 6).alias("loss"))


def _side_sql() -> str:
    def f(k, s):
        return _SCORES.replace(_V, f"SELECT vec_id, label, embedding[{s}:{s + 31}] AS probs FROM embeddings") + f" SELECT class, round(f1, 9) AS f1_{k} FROM f WHERE support > 0"

    return f"SELECT coalesce(a.class, b.class) AS class, f1_a, f1_b FROM ({f('a', 1)}) a FULL JOIN ({f('b', 33)}) b ON a.class = b.class"


@query(_side_sql())
def model_metrics_side_by_side(spark, d):
    s = evaluation.side_by_side({k: evaluation.class_scores(_preds(spark, d, start, 32)) for k, start in (("a", 1), ("b", 33))})
    return s.select("class", F.round("f1_a", 9).alias("f1_a"), F.round("f1_b", 9).alias("f1_b"))


@query("SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def truth_join(spark, d):
    return evaluation.join_truth(load(spark, d, "documents"), load(spark, d, "labels"), "doc_id").select("doc_id", "lang", "quality", "toxic")


@query("SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY 1")
def value_counts(spark, d):
    return stats.pivot_counts(load(spark, d, "lineitem"), "l_returnflag").orderBy(F.desc("count"))


# --- sampling ----------------------------------------------------------------------


def _tier_sql(table: str, label: str, key: str) -> str:
    return f"""SELECT {key}, {label} FROM (SELECT *, count(*) OVER (PARTITION BY {label}) AS n, row_number() OVER (PARTITION BY {label} ORDER BY md5({key}::VARCHAR), {key}) AS r FROM {table})
WHERE r <= CASE WHEN n > 1000 THEN 100 WHEN n > 499 THEN 50 WHEN n > 99 THEN 20 WHEN n > 49 THEN 7 WHEN n > 9 THEN 3 ELSE 0 END"""


@query(_tier_sql("documents", "lang", "doc_id"))
def stratified_tier_sample(spark, d):
    return sampling.tiered(load(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "lang")


@query(_tier_sql("events", "user_id", "event_id"))
def stratified_tier_sample_users(spark, d):
    return sampling.tiered(load(spark, d, "events").select("event_id", "user_id"), "user_id", "event_id").select("event_id", "user_id")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id::VARCHAR), event_id) AS r FROM events) WHERE r <= 100")
def per_class_sample_100(spark, d):
    return sampling.per_class(load(spark, d, "events").select("event_type", "event_id"), "event_type", "event_id").select("event_type", "event_id")


@query("SELECT o_orderpriority, o_orderkey FROM (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS n, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS r FROM orders) WHERE r <= floor(n * 0.1)")
def percent_subsample(spark, d):
    return sampling.percent(load(spark, d, "orders").select("o_orderpriority", "o_orderkey"), "o_orderpriority", "o_orderkey", 10).select("o_orderpriority", "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def global_limit(spark, d):
    return sampling.first_n(load(spark, d, "orders").select("o_orderkey", "o_totalprice"), 500, "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN CAST('0x' || left(md5(o_orderkey::VARCHAR), 4) AS INT) % 100 < 80 THEN 'train' ELSE 'valid' END AS part FROM orders")
def hash_split_80_20(spark, d):
    return sampling.hash_split(load(spark, d, "orders"), "o_orderkey").select("o_orderkey", "part")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM events) WHERE (r - 1) % 24 = 0")
def every_24th(spark, d):
    return stats.every_kth(load(spark, d, "events"), "event_type", ["ts", "event_id"], 24).select("event_type", "event_id")


@query("SELECT p_brand, min(p_name) AS first_path FROM part GROUP BY 1 ORDER BY 1 LIMIT 49")
def first_of_class(spark, d):
    return sampling.first_of_class(load(spark, d, "part"), "p_brand", "p_name")


# --- curation -----------------------------------------------------------------------


@query("SELECT c_custkey, n_name, r_name AS detailed_cat FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def key_mapping_join(spark, d):
    n, r = load(spark, d, "nation"), load(spark, d, "region")
    key = n.join(r, n.n_regionkey == r.r_regionkey).select(F.lit("survey").alias("source"), F.col("n_nationkey").alias("folder"), F.col("r_name").alias("detailed_cat"), "n_name")
    files = load(spark, d, "customer").select("c_custkey", F.lit("survey").alias("source"), F.col("c_nationkey").alias("folder"))
    return curation.map_by_key(files, key).join(n.select(F.col("n_nationkey").alias("folder"), "n_name"), "folder").select("c_custkey", "n_name", "detailed_cat")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_existing(spark, d):
    return curation.exclude(load(spark, d, "documents").select("doc_id", "source"), load(spark, d, "labels"), "doc_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def anti_test_images(spark, d):
    returned = load(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return curation.exclude(load(spark, d, "orders").select("o_orderkey"), returned, "o_orderkey")


@query("SELECT sha256(text) AS sha256, count(*) AS n, list_aggregate(list_sort(list(doc_id)), 'string_agg', ',') AS names FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_hash_groups(spark, d):
    g = curation.duplicate_groups(load(spark, d, "documents"), "text", "doc_id")
    return g.withColumn("names", F.array_join(F.transform("names", lambda n: n.cast("string")), ","))


@query("SELECT s_suppkey AS key, s_name AS name, s_acctbal AS acctbal, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def diagonal_union(spark, d):
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    return curation.diagonal(s, c)


@query("SELECT p_brand, p_type, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS r FROM part) WHERE r = 1")
def first_wins_dedup(spark, d):
    return curation.first_wins(load(spark, d, "part"), ["p_brand", "p_type"], "p_partkey").select("p_brand", "p_type", "p_partkey")


@query("SELECT page_id, string_split(url, '/')[-1] AS basename, string_split(string_split(url, '/')[-1], '.')[1] AS code FROM pages")
def basename_split(spark, d):
    return load(spark, d, "pages").select("page_id", X.basename("url").alias("basename"), X.instrument_code("url").alias("code"))


_SUFFIXES = (".tif", ".PNG", ".txt", ".jpeg", "", ".Tiff", ".tif.bak")
_NAMED = "'RawImages/' || replace(p_name, ' ', '.') || (['.tif', '.PNG', '.txt', '.jpeg', '', '.Tiff', '.tif.bak'])[p_partkey % 7 + 1]"


@query(f"SELECT p_partkey, name, lower(regexp_extract(name, '(\\.[^.]+)$', 1)) AS suffix FROM (SELECT p_partkey, {_NAMED} AS name FROM part) WHERE lower(regexp_extract(name, '(\\.[^.]+)$', 1)) IN ('.jpg', '.jpeg', '.png', '.tiff', '.tif', '.bmp', '.webp')")
def extension_filter(spark, d):
    ending = F.element_at(F.array(*map(F.lit, _SUFFIXES)), (F.col("p_partkey") % 7 + 1).cast("int"))
    files = load(spark, d, "part").select("p_partkey", F.concat(F.lit("RawImages/"), F.replace("p_name", F.lit(" "), F.lit(".")), ending).alias("name"))
    return files.withColumn("suffix", X.suffix("name")).filter(F.col("suffix").isin(*EXTENSIONS))


@query("SELECT p_partkey, translate(replace(p_name, ' ', '_'), '_-', '  ') AS label FROM part")
def label_cleanup(spark, d):
    return load(spark, d, "part").select("p_partkey", X.clean_label(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("label"))


@query("SELECT o_orderpriority, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS best, min(o_totalprice) AS best_loss FROM orders GROUP BY 1")
def best_of_grid(spark, d):
    return curation.best_of(load(spark, d, "orders"), "o_orderpriority", "o_orderkey", "o_totalprice")


# --- rules ------------------------------------------------------------------------------

_R = f"""SELECT *, (mean_optical_density < 0.02 AND solidity > 0.95 AND eccentricity < 0.3 AND intensity_ratio > 0.9) AS hard, 0.4 * greatest(0, least(1, 1 - mean_optical_density / 0.02)) + 0.2 * greatest(0, least(1, (solidity - 0.95) / 0.05)) + 0.2 * greatest(0, least(1, (0.3 - eccentricity) / 0.3)) + 0.2 * greatest(0, least(1, (intensity_ratio - 0.9) / 0.1)) AS score FROM ({_O})"""


@query(f"SELECT image_id, label, round(score, 6) AS bubble_score, hard AS is_bubble_hard, round(score, 6) > 0.7 AS is_bubble_scored, hard OR round(score, 6) > 0.7 AS is_bubble FROM ({_R})")
def rule_score(spark, d):
    s = rules.rule_score(_objects(spark, d))
    scored = F.round("bubble_score", 6)
    return s.select("image_id", "label", scored.alias("bubble_score"), "is_bubble_hard", (scored > 0.7).alias("is_bubble_scored"), (F.col("is_bubble_hard") | (scored > 0.7)).alias("is_bubble"))


@query(f"SELECT image_id, avg((hard OR round(score, 6) > 0.7)::INT) > 0.5 AS is_bubble, round(avg(round(score, 6)) + 1e-9, 6) AS bubble_score, count(*) AS object_count FROM ({_R}) GROUP BY 1")
def rule_image_vote(spark, d):
    s = rules.rule_score(_objects(spark, d)).withColumn("bubble_score", F.round("bubble_score", 6))
    s = s.withColumn("is_bubble", F.col("is_bubble_hard") | (F.col("bubble_score") > 0.7))
    return rules.image_vote(s).withColumn("bubble_score", F.round(F.col("bubble_score") + 1e-9, 6))


@query(f"SELECT image_id, label, round(4 * pi() * area / (perimeter * perimeter + 1e-6), 6) AS circularity, round(perimeter * perimeter / (area + 1e-6), 6) AS compactness FROM ({_O})")
def derived_shape_features(spark, d):
    return rules.derive_shapes(_objects(spark, d)).select("image_id", "label", F.round("circularity", 6).alias("circularity"), F.round("compactness", 6).alias("compactness"))


@query(f"SELECT image_id, round(avg(area) + 1e-7, 4) AS area, round(avg(solidity), 6) AS solidity, count(*) AS object_count FROM ({_O}) GROUP BY 1")
def object_feature_mean(spark, d):
    m = rules.object_means(_objects(spark, d), "image_id", ["area", "solidity"])
    return m.select("image_id", F.round(F.col("area") + 1e-7, 4).alias("area"), F.round("solidity", 6).alias("solidity"), "object_count")


@query("SELECT event_id, CASE WHEN hour(ts) = 0 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END AS repaired FROM events")
def midnight_repair(spark, d):
    """Times that lost their hour in the first hour of a day, as a file's do whose rows all stand at midnight."""
    e = load(spark, d, "events")
    written = F.when(F.hour("ts") == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    e = e.select("event_id", written.alias("datetime"), F.col("ts").cast("date").alias("date"), F.date_format("ts", "HH:mm").alias("time"))
    return e.select("event_id", X.repair_datetime("datetime", "date", "time").alias("repaired"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H%M') AS timestamp FROM events")
def origin_parsing(spark, d):
    e = load(spark, d, "events").withColumn("tar_path", F.concat(F.lit("/survey/"), F.date_format("ts", "yyyy_MM_dd"), F.lit("/run_"), F.date_format("ts", "HHmm"), F.lit(".tar")))
    return e.select("event_id", X.origin("tar_path").alias("o")).select("event_id", "o.date", "o.timestamp")
