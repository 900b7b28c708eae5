"""All queries of the relational library with their SQL twins."""

from quorate.plans import consensus, graphs, relational, releases, tiles  # noqa: F401
from quorate.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
