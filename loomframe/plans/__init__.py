"""Registered queries over the given tables."""

from . import alignment, audits, episodes, learning, storage
from .standins import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "alignment", "audits", "episodes", "learning", "storage"]
