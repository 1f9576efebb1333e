"""All registered queries and the SQL they are checked against."""

from catalog import bookkeeping, merges, nested, reports, tables  # noqa: F401, I001  (each registers its queries)
from catalog import loads  # noqa: F401  (uses the SQL of the others)
from catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
