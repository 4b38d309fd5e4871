"""All registered plans and their oracles."""

from __future__ import annotations

from recflow.plans import enrich_plans, header_plans, ingest_plans, reclass_plans, route_plans, stream_plans

QUERIES: dict = {}
ORACLES: dict = {}

for _m in (route_plans, ingest_plans, enrich_plans, reclass_plans, header_plans, stream_plans):
    QUERIES.update(_m.QUERIES)
    ORACLES.update(getattr(_m, "ORACLES", {}))
