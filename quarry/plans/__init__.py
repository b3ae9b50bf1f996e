"""All named queries of the archive."""

from quarry.plans import dedup, diagnostics, ingest, integrity, more, queue, streams  # noqa: F401  each registers its queries
from quarry.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
