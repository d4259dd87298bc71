"""What the pipeline writes."""

from lineforge.sinks.csv import export_csv
from lineforge.sinks.tables import create_layers, write_counted, write_table

__all__ = ["create_layers", "export_csv", "write_counted", "write_table"]
