"""Session for local work and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | None = None, name: str = "keepwell") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    n = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{n}]").appName(name)
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", n).config("spark.sql.session.timeZone", "UTC")
             # HotSpot never compiles methods over 8000 bytecodes; wide cleaning projections exceed that
             # as one fused method, and run several times faster as separately compiled expressions
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             # the two partitions of a checked table are written side by side instead of sorted
             .config("spark.sql.maxConcurrentOutputFileWriters", "4")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: `spark.checkpoint.dir` or the checkpoint folder already set; in local mode (tests)
    a temporary one where neither is."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="keepwell-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/keepwell/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


HUGE, WRITERS = "spark.sql.codegen.hugeMethodLimit", "spark.sql.maxConcurrentOutputFileWriters"
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def wide_writes(spark: SparkSession) -> Iterator[None]:
    """Settings while a wide table is written. A projection that would be one method too long for HotSpot to compile runs as several
    that are compiled; Spark's default lets it be interpreted. Up to four partition folders are written side by side, so
    rows aren't sorted by folder. What the session has set further in this direction is kept. Shuffle files go when the write has ended;
    else they stay until the driver happens to collect its garbage, those of all tables together."""
    conf = spark.conf
    before = {key: conf.get(key) for key in (HUGE, WRITERS, TIDY)}
    conf.set(HUGE, min(int(before[HUGE]), 8000))
    conf.set(WRITERS, max(int(before[WRITERS]), 4))
    conf.set(TIDY, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            conf.set(key, value)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: work is not repeated, and a lost
    executor costs a re-read instead of the whole lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with wide_writes(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def finished(spark, folder: str) -> bool:
    """Whether a write into `folder` was committed. Spark's committer leaves its marker last."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(mark)


def removed(spark, folder: str) -> None:
    """Takes a folder away that this application has written and reads no more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
