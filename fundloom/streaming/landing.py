"""Landed pages as a stream, and windowed counts of late events. An extension: the batch jobs don't need it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundloom.operators.consolidate import write_deliveries
from fundloom.sources.connectors import SCHEMAS, graph_tables


def ingest(spark: SparkSession, source: str, landing: str, out: str, checkpoint: str, connector: Callable[[DataFrame], DataFrame], as_of: str) -> StreamingQuery:
    """Every new page in ``landing`` once: normalised and appended to the shards of each table under ``out``.

    Files already taken in are known by the checkpoint, so a restart repeats nothing that was committed; a batch that is
    repeated after a failure adds rows that consolidation collapses (newest wins).
    """
    pages = spark.readStream.schema(SCHEMAS[source]).option("multiLine", True).json(landing)

    def land(batch: DataFrame, _: int) -> None:
        batch.persist()
        for name, df in graph_tables(connector(batch), as_of).items():
            write_deliveries(df, f"{out}/{name}", *(("start_date", "end_date") if name == "grant" else ()))
        batch.unpersist()

    return pages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, late: str = "2 hours", window: str = "1 hour") -> DataFrame:
    """Counts and sums per type and window; events later than ``late`` behind the newest are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "events", "value")
