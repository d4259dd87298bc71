"""Order-line lakehouse on Spark: raw lines to a star schema with kept history, and its reports."""
