"""Lineage read off a frame's plan: which tables, views and paths it comes from, and
which of their columns each of its columns depends on.  Nothing is run or typed in.

A frame whose lineage was cut (``checkpoint``) shows no sources beyond the cut; rows
given by the driver have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (schema or None, name, TABLE | VIEW | PATH)
Source = tuple[str | None, str, str]


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _value(option):
    return option.get() if option.isDefined() else None


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _nodes(plan):
    """All nodes of a plan, those of its subqueries included."""
    todo = [plan, *_items(plan.subqueriesAll())]
    while todo:
        node = todo.pop()
        yield node
        todo += _items(node.children())


def _table(identifier, entity: str = "TABLE") -> Source:
    return _value(identifier.database()), identifier.table(), entity


def _paths(relation) -> list[Source]:
    if _kind(relation) != "HadoopFsRelation":
        return []
    return [(None, p.toString(), "PATH") for p in _items(relation.location().rootPaths())]


def table_sources(df: DataFrame) -> list[Source]:
    """The tables, views and paths that ``df`` names or reads, a view with those below it."""
    found: set[Source] = set()
    for node in _nodes(df._jdf.queryExecution().analyzed()):
        kind = _kind(node)
        if kind == "View":
            found.add(_table(node.desc().identifier(), "VIEW"))
        elif kind == "LogicalRelation":
            catalog = _value(node.catalogTable())
            found.update([_table(catalog.identifier())] if catalog else _paths(node.relation()))
        elif kind == "HiveTableRelation":
            found.add(_table(node.tableMeta().identifier()))
    return sorted(found, key=lambda s: (s[2], s[0] or "", s[1]))


def column_sources(df: DataFrame) -> dict[str, list[tuple[str | None, str, str]]]:
    """For each column, the (schema, table or path, column) it depends on: those its
    value is computed from and those that choose its rows (join and group keys,
    filters), as the scans of a plan for that column alone read them."""
    out = {}
    for name in df.columns:
        found = set()
        plan = df.select(F.col(f"`{name.replace('`', '``')}`"))._jdf.queryExecution().sparkPlan()
        for node in _nodes(plan):
            kind = _kind(node)
            if kind == "FileSourceScanExec":
                table = _value(node.tableIdentifier())
            elif kind == "LogicalRelation":                        # below a subquery, before it is planned
                catalog = _value(node.catalogTable())
                table = catalog.identifier() if catalog else None
            else:
                continue
            tables = [_table(table)] if table else _paths(node.relation())
            found.update((schema, source, a.name()) for schema, source, _ in tables for a in _items(node.output()))
        out[name] = sorted(found, key=lambda s: (s[0] or "", s[1], s[2]))
    return out
