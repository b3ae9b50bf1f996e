"""Named queries over the catalog, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.sources import catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None, on_catalog: bool = True):
    """Register a function of a Catalog under its name; ``sql`` may use the catalog's views and ends as its twin."""

    def register(f: Callable[[catalog.Catalog], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(catalog.Catalog(spark, sf_dir))
        if sql is not None:
            body = sql.strip()
            ORACLES[f.__name__] = (catalog.SQL + (", " + body[5:] if body[:5].upper() == "WITH " else body)) if on_catalog else body
        return f

    return register
