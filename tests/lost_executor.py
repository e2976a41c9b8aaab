"""Run as a program: a query on a cluster of two executors in processes of their own, one of which is killed in its middle.

python lost_executor.py QUERY DATA OUT: OUT gets the rows as JSON lines, and the number of executors that were lost.
"""

import json
import os
import signal
import sys
import threading
import time
from pathlib import Path

import pyspark


def prepare(home: Path) -> None:
    """A Spark home that can be written to, for the executors' logs."""
    for p in Path(pyspark.__path__[0]).iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    os.environ |= {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": str(home / "local")}


def executors() -> list[int]:
    found = []
    for p in Path("/proc").glob("[0-9]*"):
        try:
            line = (p / "cmdline").read_bytes()
            if b"CoarseGrainedExecutorBackend" in line and f"SPARK_HOME={os.environ['SPARK_HOME']}".encode() in (p / "environ").read_bytes().split(b"\0"):
                found.append(int(p.name))
        except OSError:
            pass
    return sorted(found)


def main(name: str, data: str, out: str) -> None:
    root = Path(out)
    (root / "home").mkdir(parents=True)
    prepare(root / "home")
    from pyspark.sql import SparkSession

    import __spark_entry__

    conf = {"spark.master": "local-cluster[2,1,1500]", "spark.executor.memory": "1g", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{root}/shared", "spark.sql.warehouse.dir": f"{root}/warehouse", "spark.sql.session.timeZone": "UTC"}
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(4).repartition(4).count()
    lost: list[int] = []

    def kill() -> None:
        """Once the query has finished some stages, one executor goes with all its shuffle files."""
        first = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
        while spark.sparkContext._jsc.sc().dagScheduler().nextJobId() < first + 4:
            time.sleep(0.05)
        pid = executors()[0]
        os.kill(pid, signal.SIGKILL)
        lost.append(pid)

    threading.Thread(target=kill, daemon=True).start()
    rows = [r.asDict(recursive=True) for r in __spark_entry__.queries()[name](spark, data).collect()]
    (root / "rows").write_text("\n".join(json.dumps(r, sort_keys=True, default=str) for r in rows))
    (root / "lost").write_text(str(len(lost)))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
