"""All queries of the library by name, with SQL for those that SQL can express."""

from __future__ import annotations

from . import q_fusion, q_kept, q_quality, q_records, q_rollups, q_service, q_streaming

MODULES = (q_fusion, q_rollups, q_quality, q_records, q_service, q_streaming, q_kept)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
