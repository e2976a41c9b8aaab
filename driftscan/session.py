"""Session factory, table loading and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def get_session(app: str = "driftscan", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library assumes; conf overrides them (dots written as double underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | {k.replace("__", "."): str(v) for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_shipped: set[str] = set()
#: Arrow batches are bounded by bytes as well as rows: a worker and its JVM hold several of them at once.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package's sources to the executors, once for each application, so that Python workers can import it.

    A session that sets no bound for Arrow batches in bytes gets one of 4 MB.
    """
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, "4m")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    here = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="driftscan-")) / "driftscan.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f"driftscan/{f.relative_to(here)}")
    spark.sparkContext.addPyFile(str(to))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can read.

    It is the one named by spark.checkpoint.dir. Where that is unset, masters
    that run in this one process get a temporary folder and others one below
    the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_driftscan"
    if sc.applicationId not in _own_dirs:
        _own_dirs[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="driftscan-")
    return _own_dirs[sc.applicationId]


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextlib.contextmanager
def scratch_tables() -> Iterator[list[str]]:
    """The list to which materialize() adds the paths of what it writes within the block, in this thread."""
    made: list[str] = []
    outer = _made.get()
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        if outer is not None:
            outer.extend(made)


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # noqa: BLE001  the session has gone and its folder with it
        pass


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is put there goes when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_drop_at_exit, spark, path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and returns it re-read.

    This cuts the lineage, so that a lost executor costs no recomputation of
    what stands before it. The table goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
