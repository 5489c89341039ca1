"""Session construction and the shared scratch folder.

Staged tables (deltas, group means, job outputs in the sample queries) must
live where every executor can read them and where they survive the loss of an
executor. That place is the folder the cluster names in ``spark.checkpoint.dir``.
A session-local default is only created for local-mode sessions (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here assumes.

    AQE stays on: it coalesces small shuffle partitions, splits skewed join
    partitions and turns a shuffle join into a broadcast join once the real
    size of one side is known.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temp folder only in local mode."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set; staged tables need a folder every executor "
                "can reach. Set it on the cluster.")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared folder."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/quarry-stage/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Functions that run in workers are pickled by reference, so the workers must be able
    to import them however the driver came by the package. The archive is a file of the
    driver's, which Spark's own file server hands to the executors, as with ``--py-files``;
    nothing reads it by path elsewhere."""
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-ship-"), "quarry-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("quarry", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._quarry_shipped = True


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified Hadoop path string (scheme + normalised path)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString()


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
