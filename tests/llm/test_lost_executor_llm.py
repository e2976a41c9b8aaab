"""Corpus queries that lose an executor in their middle."""

import pytest
from test_lost_executor import disturbed, told

from driftscan.llm import queries


@pytest.mark.parametrize("name", ["op11_centroids", "op13_resampling", "op3_secret_scan"])
def test_rows_are_the_same(spark, sf, tmp_path, name):
    assert disturbed(name, sf, tmp_path / "out") == told(queries.QUERIES[name](spark, sf).collect())
