"""Tables cut from their lineage: written below the cluster's shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.session import scratch_path


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, written once as Parquet on shared storage; a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
