"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airtally.plans.views import Views, with_views
from airtally.session import plain_times, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: list[str] | None = None, sql: str | None = None,
          same_as: str | None = None):
    """Register a function ``Views -> DataFrame`` and, if SQL can say it, its oracle.

    ``same_as`` takes the oracle of another query.
    """
    def register(build: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain_times(build(Views(prepare(spark), folder)))
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if same_as is not None:
            ORACLES[name] = ORACLES[same_as]
        elif sql is not None:
            ORACLES[name] = with_views(views, sql) if views else sql
        return build
    return register
