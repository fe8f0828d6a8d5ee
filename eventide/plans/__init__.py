"""Concrete queries over the driver tables; importing registers them."""

from eventide.plans import joins, keyed, late, sources, streams, transforms, windows  # noqa: F401
from eventide.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
