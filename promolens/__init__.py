"""Customer promotion-response analytics as Spark DataFrame jobs."""

from promolens.config import RunConfig
from promolens.sources.tables import SourceTables

__all__ = ["RunConfig", "SourceTables"]
