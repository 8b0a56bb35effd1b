"""Session factory and lineage cuts shared by every operator."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "fundloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    return builder.config(map=settings).getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only where that is unset and everything runs on
    this machine (tests) a temporary one is made. Files are reliable copies, so a lost executor costs no recomputation.

    A checkpoint would keep the planner's guess of its size, which is forgotten here. A join's guess is the product of its
    sides', so a loop that joins a table with itself squares it each round, until its digits fill the driver; and what a
    function, an explode or an array adds isn't in it, so large tables would be taken for small and sent to the driver for
    a broadcast. Without a guess, joins are broadcast by the sizes that adaptive execution has measured.

    Shuffle files behind a cut are deleted as soon as it is written, not when the driver happens to collect its garbage;
    nothing reads them again.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    _folder(spark)
    done = _kept_only(df)
    jvm, session, x = sc._jvm, spark._jsparkSession, done._jdf.queryExecution().analyzed()
    none = jvm.scala.Option.empty()
    bare = jvm.org.apache.spark.sql.execution.LogicalRDD(x.output(), x.rdd(), x.outputPartitioning(), x.outputOrdering(), False, none, session, none, none)
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, bare), spark)


@contextmanager
def packed(parts: Iterable[DataFrame]) -> Iterator[DataFrame]:
    """The rows of all ``parts`` as one table of compressed columns in the shared folder, deleted at the end of the block.

    For rows that are read several times and not after that: a checkpoint's rows are written as they lie in memory, and
    stay until the driver collects its garbage. Parts are written one after the other, and each one's shuffle files are
    deleted before the next is begun.
    """
    path = spark = None
    try:
        for part in parts:
            spark = part.sparkSession
            path = path or f"{_folder(spark)}/packed-{uuid4()}"
            with _shuffles_gone(spark):
                part.select("*").write.mode("append").option("compression", "zstd").parquet(path)
        yield spark.read.parquet(path)
    finally:
        if path:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def _folder(spark: SparkSession) -> str:
    """The shared checkpoint folder; see ``cut``."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.checkpoint.dir") is None and sc.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fundloom-checkpoint-"))
    return sc.getCheckpointDir()


@contextmanager
def _shuffles_gone(spark: SparkSession) -> Iterator[None]:
    """Spark deletes shuffle files after an action whose plan was made with this setting on."""
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def _kept_only(df: DataFrame) -> DataFrame:
    """``df``'s checkpoint, without the shuffle files that it was made from."""
    with _shuffles_gone(df.sparkSession):
        return df.select("*").checkpoint(eager=True)
