"""Named queries and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.catalog.roles import Store
from mercato.session import use_engine_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Instants as zone-less times, which is what the comparison side has."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name) for f in df.schema])


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Store], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Store(use_engine_conf(spark), sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
