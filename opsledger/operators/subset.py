"""Referential subsetting: rows of driving tables, and the parents and children that they need."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.operators.relational import ranked
from opsledger.shared import checkpoint, dropped


PARTS = 8  # sets of a table's keys that are kept side by side before they are written as one


@dataclass(frozen=True)
class Edge:
    child: str
    child_key: str
    parent: str
    parent_key: str


@dataclass
class Node:
    """A table: its key, its rule, and what its rows pull in where it is the one that drives."""

    key: str
    where: str | None = None
    percent: float | None = None
    max_rows: int | None = None
    include_all: bool = False
    pull_parents: bool = True
    pull_children: bool = True
    app: str = ""  # the application that the table belongs to


@dataclass
class Graph:
    nodes: dict[str, Node]
    edges: list[Edge]
    excluded: set[tuple[str, str]] = field(default_factory=set)  # (child, parent) that no one follows
    forced: set[tuple[str, str]] = field(default_factory=set)  # (child, parent): the only children that the parent's rows pull, always


def seeds(df: DataFrame, node: Node, paths: list[str] | None = None) -> DataFrame:
    """Keys that a rule picks: all that its condition holds for, or a share of them; without a condition at least one row."""
    rows = df.where(node.where) if node.where else df
    keys = checkpoint(rows.select(node.key).distinct(), paths)
    if node.percent is None or (node.where and not 0 < node.percent < 100):
        return keys
    n = rows.count()
    most = int(n * node.percent / 100 + 0.5) if node.where else int(n * node.percent / 100) + 1
    return first_rows(keys, node.key, most, paths)


def first_rows(keys: DataFrame, key: str, most: int, paths: list[str] | None = None) -> DataFrame:
    """``most`` of the distinct ``keys``, in the order of their hash."""
    return checkpoint(ranked(keys, key).where(F.col("rank") <= most).select(key), paths)


def subset(tables: dict[str, DataFrame], graph: Graph, apps: list[str] | None = None) -> dict[str, DataFrame]:
    """Rows to keep of every table. A rule that fails raises.

    Tables with a rule and tables taken whole drive one after another, by application and name; only
    those of ``apps``, if given, but they pull rows of any. New rows pull
    their parents, and the children of the driving table and of children found, as the driving
    table's flags say; a table's forced children are pulled always, and instead of others. Children
    are capped at their table's ``max_rows``, what is held already counted in; parents never are, so
    no child lacks one. Only new keys are taken on, so cycles end, however long they are.
    """
    held: dict[str, list[DataFrame]] = {}  # keys so far, in the parts that they came in
    size: dict[str, int] = {}
    paths: list[str] = []

    def fresh(name: str, found: DataFrame, capped: bool) -> DataFrame | None:
        node = graph.nodes[name]
        if node.include_all and (apps is None or node.app in apps):
            return None
        found = found.distinct()
        for part in held.get(name, []):
            found = found.join(part, node.key, "left_anti")
        found = checkpoint(found, paths)
        room = node.max_rows - size.get(name, 0) if capped and node.max_rows else None
        n = found.count()
        if room is not None and 0 <= room < n:
            found, n = first_rows(found, node.key, room, paths), room
        if not n:
            return None
        parts = [*held.get(name, []), found]
        held[name] = parts if len(parts) < PARTS else [checkpoint(reduce(DataFrame.unionByName, parts), paths)]
        size[name] = size.get(name, 0) + n
        return found

    for root, rule in sorted(graph.nodes.items(), key=lambda x: (x[1].app, x[0])):
        if not (rule.include_all or rule.where or rule.percent) or (apps is not None and rule.app not in apps):
            continue
        start = checkpoint(tables[root].select(rule.key).distinct(), paths) if rule.include_all else fresh(root, seeds(tables[root], rule, paths), False)
        todo = [(root, start, None, None)] if start is not None else []
        while todo:
            name, new, reached, driver = todo.pop(0)
            rows = tables[name].join(new, graph.nodes[name].key, "left_semi")
            if rule.pull_parents:
                for e in sorted(graph.edges, key=lambda e: e.parent):
                    if e.child != name or (e.child, e.parent) in graph.excluded or (reached == "parent" and e.parent == driver):
                        continue
                    fk = rows.where(F.col(e.child_key).isNotNull()).select(F.col(e.child_key).alias("_k")).distinct()
                    found = fresh(e.parent, tables[e.parent].join(fk, F.col(e.parent_key) == F.col("_k"), "left_semi").select(graph.nodes[e.parent].key), False)
                    if found is not None:
                        todo.append((e.parent, found, "child", name))
            forced = {x for x in graph.forced if x[1] == name}
            if forced or (rule.pull_children and reached != "child"):
                for e in sorted(graph.edges, key=lambda e: e.child):
                    if e.parent != name or e.child == name or (e.child, e.parent) in graph.excluded or (forced and (e.child, e.parent) not in forced):
                        continue
                    pk = rows.select(F.col(e.parent_key).alias("_k")).distinct()
                    found = fresh(e.child, tables[e.child].join(pk, F.col(e.child_key) == F.col("_k"), "left_semi").select(graph.nodes[e.child].key), True)
                    if found is not None:
                        todo.append((e.child, found, "parent", name))
    out = {}
    for name, df in tables.items():
        key = graph.nodes[name].key
        if graph.nodes[name].include_all and (apps is None or graph.nodes[name].app in apps):
            out[name] = df
        elif name in held:
            out[name] = df.join(checkpoint(reduce(DataFrame.unionByName, held[name])), key, "left_semi")
        else:
            out[name] = df.limit(0)
    dropped(next(iter(tables.values())).sparkSession, paths)
    return out


def export(kept: dict[str, DataFrame], folder: str, remap: dict[str, dict[str, Column]] | None = None, where: dict[str, str] | None = None, empty: bool = True) -> DataFrame:
    """Writes each table of a subset as Parquet under ``folder``; (table, rows, path) of each, counted in what was written.

    ``remap`` replaces columns, ``where`` keeps only rows that meet a table's own condition on the
    columns as they were. Without ``empty`` tables that come out empty are left out, also of the folder.
    """
    counts = []
    for name, df in sorted(kept.items()):
        path = f"{folder.rstrip('/')}/{name}"
        rows = df.where((where or {}).get(name, "true"))
        if not empty and rows.isEmpty():
            continue
        rows.withColumns((remap or {}).get(name, {})).write.parquet(path)
        counts.append((name, df.sparkSession.read.parquet(path).count(), path))
    spark = next(iter(kept.values())).sparkSession
    return spark.createDataFrame(counts, "table string, rows long, path string")


def empty_tables(kept: dict[str, DataFrame]) -> list[str]:
    """Tables of which nothing is kept."""
    return sorted(name for name, df in kept.items() if df.isEmpty())


def dangling(kept: dict[str, DataFrame], graph: Graph) -> DataFrame:
    """(child, parent, n): rows kept whose parent isn't, of each edge that is followed."""
    out = []
    for e in graph.edges:
        if (e.child, e.parent) in graph.excluded:
            continue
        p = kept[e.parent].select(F.col(e.parent_key).alias("_k")).distinct()
        c = kept[e.child].where(F.col(e.child_key).isNotNull()).join(p, F.col(e.child_key) == F.col("_k"), "left_anti")
        out.append(c.agg(F.lit(e.child).alias("child"), F.lit(e.parent).alias("parent"), F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, out)
