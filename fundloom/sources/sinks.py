"""Manifest, serving tables and small documents."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Columns with contact data, which no public view or query has.
PRIVATE = ("email", "email_source", "email_source_url", "email_as_of", "email_method", "contactable", "opt_out", "orcid", "phone")


def write_table(df: DataFrame, path: str) -> None:
    """A published table: zstd parquet, file sizes balanced by AQE."""
    df.hint("rebalance").write.option("compression", "zstd").mode("overwrite").parquet(path)


def merge_table(df: DataFrame, path: str, collapse: Callable[[DataFrame], DataFrame]) -> None:
    """``df`` into a published table: read, united by name, collapsed (newest per key, say) and written beside it, then
    swapped by renaming, so that readers see the old or the new table and a failed run changes nothing."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fresh, old = at(f"{path}.new"), at(f"{path}.old")
    known = fs.exists(at(path))
    write_table(collapse(spark.read.parquet(path).unionByName(df, allowMissingColumns=True) if known else df), f"{path}.new")
    fs.delete(old, True)
    if known:
        fs.rename(at(path), old)
    fs.rename(fresh, at(path))
    fs.delete(old, True)


def to_do(works: DataFrame, cache: DataFrame | None, key: str = "work_id") -> DataFrame:
    """Works without a vector in the cache: an anti-join on the key, each once."""
    some = works.dropDuplicates([key])
    return some if cache is None else some.join(cache.where("vector is not null").select(key), key, "left_anti")


def manifest(tables: dict[str, DataFrame]) -> dict:
    """Row count, columns, sources and newest as_of per table; one small aggregation each."""
    out = {}
    for name, df in tables.items():
        usd = F.round(F.sum("amount_usd"), 2) if "amount_usd" in df.columns else F.lit(None)
        by = {x.source: x.usd for x in df.groupBy("source").agg(usd.alias("usd")).collect()} if "amount_usd" in df.columns else None  # a row per source
        r = df.agg(F.count("*").alias("rows"), F.array_sort(F.collect_set("source")).alias("sources"), F.max("as_of").alias("as_of")).first()
        out[name] = {"row_count": r.rows, "columns": df.columns, "sources": r.sources, "as_of": r.as_of} | ({"usd_by_source": by} if by is not None else {})
    return out


def write_json(path: str | Path, value: object) -> None:
    """Replaces the file in one step, so readers never see half of it."""
    p = Path(path)
    part = p.with_suffix(p.suffix + ".part")
    part.write_text(json.dumps(value, indent=1, sort_keys=True, default=str))
    os.replace(part, p)


def append_jsonl(path: str | Path, value: object) -> None:
    with Path(path).open("a") as f:
        f.write(json.dumps(value, default=str) + "\n")


def read_jsonl(path: str | Path) -> list[dict]:
    """The lines of a log; none where there is no file. A line that was cut off by a failure is left out."""
    out = []
    if Path(path).exists():
        for line in Path(path).read_text().splitlines():
            try:
                out.append(json.loads(line))
            except ValueError:
                continue
    return out


def safe_columns(columns: list[str]) -> list[str]:
    """Columns that may be shown: all but those that hold contact data."""
    return [c for c in columns if c not in PRIVATE]


def public_view(df: DataFrame, name: str) -> None:
    """A temporary view without the private columns."""
    df.select(*safe_columns(df.columns)).createOrReplaceTempView(name)


def markdown(df: DataFrame, title: str, limit: int = 200) -> str:
    """A small aggregate as a report table."""
    rows = df.limit(limit).collect()
    head = f"## {title}\n\n| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns) + "\n"
    return head + "".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |\n" for r in rows)


def report(sections: dict[str, DataFrame], path: str | Path, title: str) -> None:
    """Small aggregates as a Markdown report, written in one step."""
    p = Path(path)
    part = p.with_suffix(p.suffix + ".part")
    part.write_text(f"# {title}\n\n" + "\n".join(markdown(df, name) for name, df in sections.items()))
    os.replace(part, p)
