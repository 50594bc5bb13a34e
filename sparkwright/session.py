"""Session construction and the shared working folder.

The folder named by ``spark.checkpoint.dir`` is shared by the driver and all
executors; intermediate tables (staged CSV, stream sinks, checkpoints) go
below it.  Only a session in one process may do without the setting.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "sparkwright",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (their Python workers import it by
    name).  Needed on clusters that don't have it on their PYTHONPATH."""
    here = os.path.dirname(os.path.abspath(__file__))
    # The driver serves the file to executors that join later, too.
    folder = tempfile.mkdtemp(prefix="sparkwright-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(
        f"{folder}/sparkwright", "zip", os.path.dirname(here), os.path.basename(here)))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Only a session in
    one process (``local[...]``) may do without: it gets a private folder.
    Elsewhere a folder on the driver's disk would be lost to the executors, so
    a missing setting is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d and not sc.getCheckpointDir():
        # Named for the cluster but not yet registered with this context.
        sc.setCheckpointDir(d)
    d = d or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparkwright-ckpt-"))
        d = sc.getCheckpointDir()
    return d


_RUN_FOLDERS: dict[tuple[str, str], str] = {}


def _run_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one; the file system removes
    it when the driver's JVM ends."""
    root = checkpoint_root(spark).rstrip("/")
    key = (spark.sparkContext.applicationId, root)
    if key not in _RUN_FOLDERS:
        path = f"{root}/sparkwright-{uuid.uuid4().hex}"
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _RUN_FOLDERS[key] = path
    return _RUN_FOLDERS[key]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read the copy: the
    lineage is cut, a lost executor rereads the files, and later steps prune
    columns and push filters down."""
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
