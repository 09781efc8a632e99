"""Every registered query of the library proper, and its DuckDB equivalent."""

from __future__ import annotations

from .queries import episodes, monitoring, warehouse

QUERIES = {k: v for m in (warehouse, episodes, monitoring) for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in (warehouse, episodes, monitoring) for k, v in m.ORACLES.items()}
