"""Session helpers: a local session for tests and benches, and the shared folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; it
is read from the session and never replaced.  Only a local session without
one gets a fresh scratch folder, as tests do.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "roadprint") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Trip aggregates read the trip-sorted window output: a sort aggregate
        # streams one trip at a time instead of hashing (and spilling) them all.
        .config("spark.sql.execution.useObjectHashAggregateExec", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating one only for local runs."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="roadprint-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared (checkpoint) folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    return path


class Scope:
    """Written and persisted tables that live until the scope ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.held = spark, [], []

    def persist(self, df):
        """Keep ``df`` in the executors' memory and disk until the scope ends."""
        self.held.append(df.persist())
        return self.held[-1]

    def release(self) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for df in self.held:
            df.unpersist()
        for path in self.paths:
            where = hadoop.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.paths, self.held = [], []


_SCOPES: list[Scope] = []  # the innermost last; a driver opens them one inside the other


@contextmanager
def scratch(spark: SparkSession):
    """The tables that operators write inside the block are deleted, and those that it persists
    released, when the block ends, after the last reader.

    Results are lazy: consume them (write, collect, count) inside the block.  Blocks nest.
    """
    scope = Scope(spark)
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        _SCOPES.remove(scope)
        scope.release()


def materialize(df, name: str = "table"):
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage (many jobs reuse the result, a lost executor recomputes
    nothing upstream) with a single job, unlike an uncached ``checkpoint()``
    which computes its input twice.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
