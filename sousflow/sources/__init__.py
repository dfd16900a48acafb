"""Table access: parquet reads and the reference-shaped views over the test tables."""

from sousflow.sources.bridge import Bridge
from sousflow.sources.tables import Tables

__all__ = ["Bridge", "Tables"]
