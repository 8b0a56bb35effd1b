"""Parquet tables of a data folder, alone, united, or registered as views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` under ``root``; with ``columns`` only those are read."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df.select(*[f"`{c}`" for c in columns]) if columns else df


def united(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """Shards whose columns differ, by name: a column that a shard doesn't have is null. With a ``schema`` no footer but
    those of the files that are read is opened, which is what to do with many shards."""
    return spark.read.schema(schema).parquet(*paths) if schema else spark.read.option("mergeSchema", True).parquet(*paths)


def attach(spark: SparkSession, root: str, space: str, *names: str) -> list[str]:
    """The tables of another folder as read-only views ``<space>_<name>``, beside those of other spaces."""
    views = [f"{space}_{n}" for n in names]
    for view, name in zip(views, names, strict=True):
        table(spark, root, name).createOrReplaceTempView(view)
    return views


def attached(spark: SparkSession, space: str) -> dict[str, list[str]]:
    """Views of a space and their columns, as the catalog has them."""
    found = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{space}_")]
    return {n.removeprefix(f"{space}_"): spark.table(n).columns for n in sorted(found)}
