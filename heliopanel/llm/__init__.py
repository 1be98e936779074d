"""Training-data operators: extraction, deduplication, filtering, mixing, tokens, search.

``QUERIES`` and ``ORACLE`` hold the registered queries and their SQL.
"""

from .queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
