"""Every operator as a query over the test tables, with the SQL that must give the same rows."""

from starloom.queries import joining, layout, profiling, rows, schema, storage, text
from starloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "joining", "layout", "profiling", "rows", "schema", "storage", "text"]
