"""The registered queries and, apart from them, the same results in plain SQL."""

from lineforge.catalogue.oracle import oracle_sql
from lineforge.catalogue.registry import lakehouse_for, queries

__all__ = ["lakehouse_for", "oracle_sql", "queries"]
