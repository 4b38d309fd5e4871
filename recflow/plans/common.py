"""Shared parameters for the registered query plans.

Run date and timestamps are parameters (never the wall clock), so that every
plan is deterministic and comparable with its SQL oracle.
"""

from __future__ import annotations

from recflow.fixtures import Fixtures

RUN_DATE = "2025-01-15"
RUN_TS = "2025-01-15T12:00:00"
RECLASS_TS = "2025-01-15T12:10:00"
ENRICH_TS = "2025-01-15T12:20:00"
PULL_TS = "2025-01-15T11:50:00"
MODEL_NAME = "scorer-v1"


def fx(spark, sf_dir) -> Fixtures:
    return Fixtures.of(spark, sf_dir)
