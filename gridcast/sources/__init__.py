"""Sources and sinks: panel files, derived test fixtures, JSON/CSV writers."""

from gridcast.sources.parquet import list_dataset_files, read_panel_files, nan_to_null
from gridcast.sources import fixtures

__all__ = ["list_dataset_files", "read_panel_files", "nan_to_null", "fixtures"]
