"""All queries of the subpackage and the SQL they are checked against."""

from lodeworks.llm import bpe, caps, graph, licenses, lines, packing, periods, pieces, quality, repeats, simhash, spans, toxicity  # noqa: F401  (each registers its queries)
from lodeworks.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
