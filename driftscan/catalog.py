"""Named queries of the library and the SQL that each must agree with."""

from __future__ import annotations

from driftscan.plans import reports, surveys

QUERIES: dict = reports.QUERIES | surveys.QUERIES
ORACLES: dict = reports.ORACLES | surveys.ORACLES
