"""Session settings, and where jobs put intermediate files.

Everything written between two stages (landed batches, snapshots, stream
checkpoints) goes under the shared folder the cluster names in
``spark.checkpoint.dir``. A machine-local folder would be unreadable for the
other executors, so one is only used for a local-mode session that names none.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Worth setting when a session is built; the library itself sets nothing.
SESSION_SETTINGS = {
    # The JVM never compiles a method above 8000 bytes. Where a longer one would be
    # generated Spark splits the code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # No stack trace per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Layers hold INT64 timestamps; readers other than Spark cannot all do INT96.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The defaults, named because skewed joins and rebalanced writes rest on them.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

SHARED_DIR_KEY = "spark.checkpoint.dir"


@cache
def _local_dir() -> str:
    """One per process, for local sessions; no session setting is changed for it."""
    return tempfile.mkdtemp(prefix="tierline-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read, as configured on the session."""
    configured = spark.conf.get(SHARED_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_KEY} to a folder shared by all executors")
    return _local_dir()


def new_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame computed once, into the shared folder, with its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
