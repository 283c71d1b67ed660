"""Session helpers: recommended settings and the shared state folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. AQE re-plans joins at runtime (broadcasts only
# what it has measured to be small) and splits skewed shuffle partitions.
# Nothing here changes results: timestamps are TIMESTAMP_NTZ with literals
# built time-zone independently, and every write names its own overwrite
# mode, so the session's defaults for those are left to the user.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "pathcredit") -> SparkSession:
    """A local session for tests and the benchmark (not for clusters)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PATHCREDIT_DRIVER_MEM", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)


_LOCAL_DIRS: dict[str, str] = {}  # of local sessions without the setting, by application


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a scratch folder of its
    own; on a cluster that would scatter files over the machines' own disks,
    so there it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="pathcredit-ckpt-")
        sc.setCheckpointDir(_LOCAL_DIRS[sc.applicationId])
    return _LOCAL_DIRS[sc.applicationId]


def new_state_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one pipeline's tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, track: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back: the
    stage is computed once, later stages scan it (with column pruning and
    filter pushdown) instead of recomputing its lineage, and the data
    survives executor loss."""
    spark = df.sparkSession
    path = new_state_dir(spark, f"stage-{label}")
    df.write.parquet(path)
    if track is not None:
        track.append(path)
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on any Hadoop-compatible file system."""
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jp.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jp):
        fs.delete(jp, True)
