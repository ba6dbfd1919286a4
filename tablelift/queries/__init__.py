"""One runnable query per operator over the driver's tables, each with its SQL twin."""

from tablelift.queries import checks, dedups, documents, edits, joins, paths, sequences, upserts  # noqa: F401
from tablelift.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
