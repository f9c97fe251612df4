"""The registered queries: every operator over the supplied tables, with its SQL."""

from lakestay.registry import (  # noqa: F401
    aggregates,
    entities,
    expressions,
    joining,
    quality,
    scans,
    versions,
    warehouse,
)
from lakestay.registry.core import REGISTRY

__all__ = ["REGISTRY"]
