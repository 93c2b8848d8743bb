"""A catalogue of views published for SQL and BI clients.

A view is SQL over other views, or a DataFrame operator over them; what a view
reads is declared with it.  ``publish`` registers the views that are asked for
and everything below them as temporary views, each after what it reads.  Views
are inlined by Catalyst, so a query over the topmost view still prunes columns
and pushes filters into the scans at the bottom.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class View:
    """``sql`` over the views of ``needs``, or ``build`` of their DataFrames in
    that order; a ``base`` view is given when the catalogue is published."""
    name: str
    needs: tuple[str, ...] = ()
    sql: str | None = None
    build: Callable[..., DataFrame] | None = None
    base: bool = False


@dataclass
class Catalogue:
    views: dict[str, View] = field(default_factory=dict)

    def add(self, name: str, needs: Iterable[str] = (), sql: str | None = None, build=None, base: bool = False) -> None:
        if name in self.views:
            raise ValueError(f"view {name} is defined twice")
        if base + (sql is not None) + (build is not None) != 1:
            raise ValueError(f"view {name} must be base, or have SQL, or a builder")
        self.views[name] = View(name, tuple(needs), sql, build, base)

    def order(self, names: Iterable[str] | None = None) -> list[str]:
        """The views asked for (all by default) and what they read, each after
        what it reads."""
        graph: dict[str, tuple[str, ...]] = {}
        todo = list(self.views if names is None else names)
        while todo:
            name = todo.pop()
            if name not in self.views:
                raise ValueError(f"no view {name}")
            if name not in graph:
                graph[name] = self.views[name].needs
                todo.extend(graph[name])
        try:
            return list(TopologicalSorter(graph).static_order())
        except CycleError as e:
            raise ValueError(f"views read each other: {' -> '.join(e.args[1])}") from e

    def publish(self, spark: SparkSession, bases: dict[str, Callable[[], DataFrame]],
                names: Iterable[str] | None = None) -> list[str]:
        """Register views; ``bases`` makes the base views, and only those that are
        read are made.  Returns the names in the order of their registration."""
        done = self.order(names)
        for name in done:
            view = self.views[name]
            if view.base:
                if name not in bases:
                    raise ValueError(f"no data for the base view {name}")
                bases[name]().createOrReplaceTempView(name)
            elif view.sql is not None:
                spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {view.sql}")
            else:
                view.build(*(spark.table(n) for n in view.needs)).createOrReplaceTempView(name)
        return done
