"""All registered queries; importing a module registers its queries."""

from tidemark.queries import features, jobs, models, tables  # noqa: F401
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
