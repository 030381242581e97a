"""Registration of queries with the SQL that has to give the same result."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from flowtide.session import SETTINGS
from flowtide.workload.adapters import Tables

DIGITS = 4


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, so that the order of a summation cannot show; zeros are positive.

    A mean may lie exactly between two results; a small shift takes it off the tie.
    """
    doubles = [f.name for f in df.schema if isinstance(f.dataType, DoubleType)]
    shift = F.lit(10.0 ** -(digits + 3))
    return df.withColumns({n: F.round(F.col(f"`{n}`") + shift, digits) + F.lit(0.0) for n in doubles})


def r(expression: str, digits: int = DIGITS) -> str:
    """The same rounding as SQL text."""
    return f"round({expression} + 1e-{digits + 3}, {digits}) + 0.0"


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    """Register a function from ``Tables`` to a DataFrame under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            zone = "spark.sql.session.timeZone"
            spark.conf.set(zone, SETTINGS[zone])
            return rounded(build(Tables(spark, folder)), digits)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return build

    return register
