"""Sources and sinks: parquet scans, retail frames derived from driver tables, writers."""

from retailcast.sources.tables import read_table, table_path  # noqa: F401
from retailcast.sources.retail import customer_traffic, promotions, sales  # noqa: F401
