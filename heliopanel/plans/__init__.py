"""Query catalog: importing this package registers every query."""

from . import queries_core, queries_eval, queries_models, queries_quality, queries_scoring  # noqa: F401
from . import queries_io  # last: reuses the DuckDB twins of earlier queries
from .registry import ORACLE, QUERIES

queries_io._register_audit_sql()
queries_io._register_stream_sql()

__all__ = ["QUERIES", "ORACLE"]
