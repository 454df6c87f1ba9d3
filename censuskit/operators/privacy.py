"""Entities across tables: which columns of which tables belong to an entity, and rewriting them.

The key graph is read off the schemas. Column names are compared without their table's prefix
(c_custkey and o_custkey are one key, custkey); aliases name keys that are called otherwise. A
table's own key is its first column, unless another table's first column has the same name and
stands before it. A table belongs to the entity if it has the entity's key, or a key owned by a
table that belongs to it: then its rows find their entity by joins along that path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


@dataclass(frozen=True)
class Member:
    """A table of the graph: the column by which it finds its entity, and the table that owns that
    column's key (None: the column is the entity's key); columns with keys of the graph."""

    table: str
    column: str
    through: str | None
    keys: dict[str, str]
    dates: tuple[str, ...]


def plain_name(column: str, aliases: dict[str, str]) -> str:
    return aliases.get(column, column.split("_", 1)[1] if "_" in column[:4] else column)


def key_graph(tables: dict[str, DataFrame], entity: str, aliases: dict[str, str] | None = None) -> list[Member]:
    """The tables that belong to the entity (a plain key name), nearest first."""
    aliases = aliases or {}
    plain = {t: {c: plain_name(c, aliases) for c in df.columns} for t, df in tables.items()}
    owner: dict[str, str] = {}
    for t, df in tables.items():
        owner.setdefault(plain[t][df.columns[0]], t)
    reached: dict[str, tuple[str, str | None]] = {}
    while True:
        more = {}
        for t, names in plain.items():
            if t in reached:
                continue
            direct = [c for c, n in names.items() if n == entity]
            through = [(c, owner[n]) for c, n in names.items() if owner.get(n) in reached and owner[n] != t]
            if direct:
                more[t] = (direct[0], None)
            elif through:
                more[t] = through[0]
        if not more:
            break
        reached |= more
    owned = {n for n, t in owner.items() if t in reached} | {entity}
    dates = lambda df: tuple(f.name for f in df.schema if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)))
    return [Member(t, c, via, {x: n for x, n in plain[t].items() if n in owned}, dates(tables[t])) for t, (c, via) in reached.items()]


def with_entity(tables: dict[str, DataFrame], graph: list[Member], name: str = "entity_") -> dict[str, DataFrame]:
    """Each table of the graph with the entity of its rows; along a path one row of the owner is
    found by its key."""
    out: dict[str, DataFrame] = {}
    for m in graph:
        df = tables[m.table]
        if m.through is None:
            out[m.table] = df.withColumn(name, F.col(m.column))
        else:
            own = tables[m.through].columns[0]
            out[m.table] = df.join(out[m.through].select(F.col(own).alias(m.column), name), m.column, "left")
    return {m.table: out[m.table].select(*tables[m.table].columns, name) for m in graph}


def duplicate_entities(tables: dict[str, DataFrame], entity: str, chosen: Callable[[Column], Column], offset: int, aliases: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Tables with the rows of the chosen entities once more, under new ids: the entity's key and
    all keys owned by tables of the graph are raised by offset in the copies, so that these
    match each other and nothing else. Other tables are returned as they are."""
    graph = key_graph(tables, entity, aliases)
    owned = with_entity(tables, graph)
    out = dict(tables)
    for m in graph:
        copies = owned[m.table].filter(chosen(F.col("entity_"))).drop("entity_")
        out[m.table] = tables[m.table].unionByName(copies.withColumns({c: (F.col(c) + offset).cast(tables[m.table].schema[c].dataType) for c in m.keys}))
    return out


def shift_dates(tables: dict[str, DataFrame], entity: str, days: Callable[[Column], Column], aliases: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Tables with every date and timestamp moved by as many days as days() gives for the row's
    entity, so that intervals within an entity stay; rows without one are not moved."""
    graph = key_graph(tables, entity, aliases)
    owned = with_entity(tables, graph)
    out = dict(tables)
    for m in graph:
        by = F.coalesce(days(F.col("entity_")), F.lit(0)).cast("int")
        kind = {c: tables[m.table].schema[c].dataType for c in m.dates}
        moved = {c: F.date_add(c, by) if isinstance(kind[c], DateType) else (F.col(c) + F.make_dt_interval(by)).cast(kind[c]) for c in m.dates}
        out[m.table] = owned[m.table].withColumns(moved).select(*tables[m.table].columns)
    return out
