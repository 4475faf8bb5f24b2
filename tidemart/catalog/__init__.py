"""Every registered query with the SQL that an independent engine can check it with."""

from tidemart.catalog import batch, formats, questions, streams, versions, warehouse
from tidemart.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batch", "formats", "questions", "streams", "versions", "warehouse"]
