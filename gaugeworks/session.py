"""Session settings and the shared folder used for lineage cuts and staged files."""
from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


# Adaptive settings for keys that hold a large share of the rows.  The last one
# lets a skewed join be split even when that costs one more shuffle downstream.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Partitioned writes.  A task that writes to few directories keeps a file open for each and need
# not sort its rows by directory first, which spills once a task's rows outgrow its memory.  Beyond
# this many directories the task sorts the rest of its rows.  Open files buffer a row group each,
# so those are kept small.
WRITE_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": "100"}
ROW_GROUP_BYTES = 8 << 20


def tolerate_skew(spark: SparkSession) -> SparkSession:
    """Apply :data:`SKEW_SETTINGS` and :data:`WRITE_SETTINGS` to a session somebody else built."""
    for key, value in {**SKEW_SETTINGS, **WRITE_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "gaugeworks", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the first
    comes from spark-submit, and the second only needs to be high, because
    adaptive execution merges small shuffle partitions by their actual size.
    """
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.ansi.enabled", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SKEW_SETTINGS, **WRITE_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Staged copies are read lazily and so outlive the call that wrote them; the folder is
    scratch space whose owner clears it after the application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    """For a purely local session without the setting: one folder, removed when Python ends."""
    folder = tempfile.mkdtemp(prefix=f"gaugeworks-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nothing was written to before, below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
