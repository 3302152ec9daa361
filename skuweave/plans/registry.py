"""Every registered query and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from skuweave.plans.views import with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under name, with the SQL of the same rows."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return f

    return add


def load() -> None:
    """Imports the modules that register queries."""
    from skuweave.plans import (  # noqa: F401
        prices,
        attributes,
        audits,
        files,
        grounded,
        guidelines,
        matching,
        more,
        nested,
        resolution,
        routing,
        searching,
        serving,
        tables,
        voice,
    )


load()
