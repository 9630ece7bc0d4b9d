"""Named queries over a warehouse."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from mercato.plans.warehouse import Warehouse

Query = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str, **params: object) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Register a query; ``params`` are the arguments of the registered call."""

    def register(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = partial(function, **params) if params else function
        return function

    return register


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from mercato.plans import (  # noqa: F401
        basics,
        checks,
        cohorts,
        insights,
        marts,
        pipelines,
        ranking,
        reports,
        rolling,
        segments,
        spines,
        views,
        windows,
    )

    return QUERIES
