"""What the pipeline reads."""

from lineforge.sources.csv import ingest_csv
from lineforge.sources.schemas import FILE_SCHEMA, LINE_SCHEMA
from lineforge.sources.tables import TABLE_SETTINGS, order_lines

__all__ = ["FILE_SCHEMA", "LINE_SCHEMA", "TABLE_SETTINGS", "ingest_csv", "order_lines"]
