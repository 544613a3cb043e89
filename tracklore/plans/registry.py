"""Registry of queries: name to a function of (spark, sf_dir), and to SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracklore.plans.views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None, more: str = "", recursive: bool = False, reads: str | None = None):
    """Register a function of the named views' DataFrames (or of those that it ``reads`` instead), and the SQL body that answers the same."""

    def register(f: Callable[..., DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(*[view(spark, sf_dir, v) for v in (views if reads is None else reads).split()])
        if sql is not None:
            SQL[name] = with_views(views, sql, more, recursive)
        return f

    return register
