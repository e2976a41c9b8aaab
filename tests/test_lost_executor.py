"""A query that loses an executor in its middle gives the rows it gives otherwise."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from driftscan import catalog

HERE = Path(__file__).resolve().parent


def disturbed(name: str, data: str, out: Path) -> list[str]:
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK", "PYSPARK"))} | {"PYTHONPATH": str(HERE.parent)}
    done = subprocess.run([sys.executable, str(HERE / "lost_executor.py"), name, data, str(out)], env=env, cwd=out.parent, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert (out / "lost").read_text() == "1"
    return sorted((out / "rows").read_text().splitlines())


def told(rows) -> list[str]:
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True, default=str) for r in rows)


@pytest.mark.parametrize("name", ["track_segments", "archive_index"])
def test_rows_are_the_same(spark, sf, tmp_path, name):
    assert disturbed(name, sf, tmp_path / "out") == told(catalog.QUERIES[name](spark, sf).collect())
