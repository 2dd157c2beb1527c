"""Every operator as a named query over the driver's tables, with its SQL twin."""

from queries import bitmaps, checks, files, landing, models, reports, sources, text, upserts  # noqa: F401
from queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
