"""Deliveries to consolidated tables: newest wins, edges once, keys remapped, partitions rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.functions.instants import micros
from fundloom.functions.keys import PROVENANCE, partition_year


def newest(df: DataFrame, *key: str) -> DataFrame:
    """One row per key: the one of the latest as_of, among equals the greatest row column by column.

    A grouped maximum of the row as a struct, so copies collapse map-side and no group is sorted. Rows with a null in
    the key form a key of their own.
    """
    rest = [c for c in df.columns if c not in key]
    row = F.struct(micros(F.col("as_of")).alias("_us"), *rest)
    return df.groupBy(*key).agg(F.max(row).alias("_r")).select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def dedup_entities(df: DataFrame) -> DataFrame:
    return newest(df.where("atlas_id is not null"), "atlas_id")


def dedup_edges(df: DataFrame) -> DataFrame:
    return newest(df, "src_id", "dst_id", "score" if "score" in df.columns else "role", "source")


def first_wins(df: DataFrame, key: str, position: Column) -> DataFrame:
    """One row per key: the one that came first by ``position``, which must be unique."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), position).alias("_r")).select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def remap_edges(edges: DataFrame, canonical: DataFrame, column: str = "dst_id") -> DataFrame:
    """Edges whose ``column`` is replaced by its canonical key (its own where there is none), collapsed again."""
    m = canonical.select(F.col("atlas_id").alias(column), "canonical_id")
    moved = edges.join(m, column, "left").withColumn(column, F.coalesce("canonical_id", column)).drop("canonical_id").select(*edges.columns)
    return dedup_edges(moved)


def canonical_orgs(orgs: DataFrame, ror: Column) -> DataFrame:
    """``(atlas_id, canonical_id, sources)``: keys that carry one ROR id share its smallest key; others stand for themselves."""
    keyed = orgs.where("atlas_id is not null").select("atlas_id", ror.alias("ror"), "source").distinct()
    merged = keyed.where("ror is not null").groupBy("ror").agg(F.min("atlas_id").alias("canonical_id"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    tied = keyed.where("ror is not null").select("atlas_id", "ror").distinct().join(merged, "ror").groupBy("atlas_id").agg(F.min(F.struct("canonical_id", "sources")).alias("m"))
    return orgs.where("atlas_id is not null").select("atlas_id").distinct().join(tied, "atlas_id", "left").select("atlas_id", F.coalesce("m.canonical_id", "atlas_id").alias("canonical_id"), "m.sources")


def write_deliveries(df: DataFrame, path: str, *years: str) -> None:
    """Appends to parquet shards by source and year; rewriting a slice replaces that slice only when ``overwrite`` is
    chosen by the caller through ``rewrite_slice``."""
    _sharded(df, *years).write.partitionBy("source", "year").option("compression", "zstd").mode("append").parquet(path)


def rewrite_slice(df: DataFrame, path: str, *years: str) -> None:
    """Replaces the (source, year) slices that ``df`` holds and leaves all others."""
    _sharded(df, *years).write.partitionBy("source", "year").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def _sharded(df: DataFrame, *years: str) -> DataFrame:
    """One task writes a slice's file; slices of a hot source are split by AQE (rebalance), not gathered."""
    return df.withColumn("year", partition_year(*[F.col(c) for c in (*years, "as_of")])).hint("rebalance", "source", "year")


def provenance_gaps(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.lit(table).alias("table_name"), *[F.sum((F.col(c).isNull() | (F.col(c) == "")).cast("long")).alias(c) for c in PROVENANCE])
