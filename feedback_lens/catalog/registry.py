"""Registry of queries and of the common table expressions their SQL builds on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_COVERS: dict[str, str] = {}
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, sql: str, needs: str = "") -> None:
    """Name a subquery; ``needs`` lists the views it reads."""
    _VIEWS[name] = (tuple(needs.split()), sql.strip())


def sql(needs: str, body: str) -> str:
    """A statement with every view it needs, dependencies first."""
    order: list[str] = []

    def add(name: str) -> None:
        for parent in _VIEWS[name][0]:
            add(parent)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n][1]})" for n in order) + "\n" + body.strip()


def query(covers: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``covers`` lists the inventory ids it shows."""

    def register(fn: Query) -> Query:
        name = fn.__name__
        _QUERIES[name] = fn
        _COVERS[name] = covers
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


def coverage() -> dict[str, str]:
    return dict(_COVERS)
