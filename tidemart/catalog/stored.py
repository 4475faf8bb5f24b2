"""Tables that queries find stored, as an analyst does: made once per application and state of
their source files, below the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from tidemart.session import scratch_dir
from tidemart.sources import views

_FOLDERS: dict[tuple, str] = {}


def stored_folder(spark: SparkSession, sf_dir: str, name: str, tables: Sequence[str], make: Callable[[str], object]) -> str:
    """The folder that ``make(folder)`` has filled from ``tables``."""
    state = (spark.sparkContext.applicationId, sf_dir, name, *(views.source_state(spark, sf_dir, t) for t in tables))
    if state not in _FOLDERS:
        folder = scratch_dir(spark, name)
        make(folder)
        _FOLDERS[state] = folder
    return _FOLDERS[state]
