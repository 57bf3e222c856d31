"""The list of named queries; each has its SQL counterpart unless SQL cannot express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.shapes import Shapes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``f(shapes)`` under its name, with the SQL that must give the same rows."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Shapes(spark, sf_dir))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return run

    return register
