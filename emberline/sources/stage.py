"""Stage hand-off between jobs: Parquet, with CSV for evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_stage(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_evidence(df: DataFrame, path: str) -> str:
    """Any table as CSV; nested values become JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    df = df.select(*[F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
                     for f in df.schema])
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_evidence(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
