"""Names in a query, and where they stand, as Spark's own parser reads them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

_KINDS = {"UnresolvedRelation": "multipartIdentifier", "UnresolvedAttribute": "nameParts", "UnresolvedStar": "target"}
_OTHERS = ("children", "expressions", "innerChildren")


@dataclass(frozen=True)
class Name:
    """A name of one or more parts: a relation, a column, ``x.*``, or an alias given to a relation."""

    kind: str
    parts: tuple[str, ...]
    start: int
    stop: int


def _each(seq) -> Iterator:
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _nodes(plan) -> Iterator[tuple[str, object]]:
    """All nodes of a parsed plan with their class names: operators, expressions, subqueries and CTEs."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        yield kind, node
        expression = "expressions" in kind or "catalyst.expressions" in node.getClass().getName() or kind.startswith(("UnresolvedAttribute", "UnresolvedStar"))
        for others in _OTHERS[:1] if expression else _OTHERS:
            try:
                waiting += [x for x in _each(getattr(node, others)()) if "catalyst" in x.getClass().getName()]
            except Py4JError:  # no such method here
                continue
        if kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"):
            waiting.append(node.plan())


def names_in(spark: SparkSession, query: str) -> list[Name]:
    """The names of a query; none if Spark cannot parse it, which it then says when it runs."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    except Py4JError:
        return []
    found = set()
    for kind, node in _nodes(plan):
        origin = node.origin()
        if kind == "SubqueryAlias":
            found.add(Name("alias", (node.alias(),), -1, -1))
        if kind not in _KINDS or origin.startIndex().isEmpty():
            continue
        parts = getattr(node, _KINDS[kind])()
        if kind == "UnresolvedStar":
            if parts.isEmpty():
                continue
            parts = parts.get()
        found.add(Name(kind, tuple(_each(parts)), origin.startIndex().get(), origin.stopIndex().get()))
    return sorted(found, key=lambda n: n.start)


def unqualified(query: str, names: list[Name], schema: str, tables: set[str]) -> str:
    """The query with ``schema.table`` as ``table``, where that names one of the tables.

    In column names the qualifier goes only if it cannot be another thing: ``schema.table.column``
    is a column of the table unless a relation of the query has the schema's name.
    """
    shadowed = any(n.kind == "alias" and n.parts[-1].lower() == schema.lower() for n in names)
    out, at = [], 0
    for n in names:
        least = {"UnresolvedRelation": 2, "UnresolvedAttribute": 3, "UnresolvedStar": 2}.get(n.kind, 99)
        known = len(n.parts) >= least and n.parts[0].lower() == schema.lower() and n.parts[1].lower() in tables
        if not known or n.start < at or (shadowed and n.kind != "UnresolvedRelation") or (n.kind != "UnresolvedAttribute" and len(n.parts) != 2):
            continue
        star = ".*" if n.kind == "UnresolvedStar" else ""
        out += [query[at : n.start], ".".join("`" + p.replace("`", "``") + "`" for p in n.parts[1:]) + star]
        at = n.stop + 1
    return "".join([*out, query[at:]])
