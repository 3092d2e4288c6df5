"""Sources (parquet / CSV scans, the readings mapping) and sinks."""

from wattline.sources.tables import load, table_path, TABLES
from wattline.sources.readings import readings, readings_dirty

__all__ = ["load", "table_path", "TABLES", "readings", "readings_dirty"]
