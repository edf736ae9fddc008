"""Tables, shared scratch tables and small column helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder named in ``spark.checkpoint.dir``, which
    ``clear_scratch`` deletes when nothing reads it any more."""
    return scratch_path(spark, f"llm-{name}")


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage with
    a table that every executor can read again."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: str) -> Column:
    """A 128-bit key of a row as 32 hex digits: equal rows have equal keys, and a
    null differs from every text."""
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        parts += [F.when(value.isNull(), F.lit("0:")).otherwise(F.concat(F.lit("1:"), F.length(value).cast("string"), F.lit(":"), value))]
    return F.md5(F.concat(*parts).cast("binary"))
