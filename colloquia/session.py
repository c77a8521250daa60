"""Session helpers: a local session for tests/bench and shared scratch paths.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we
only invent one (under the local temp dir) when the session has none, which is
the case for local tests.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import SparkSession


# Spark's setting to remove the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "colloquia") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a local one if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="colloquia-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def reliable_checkpoint(df):
    """Materialise ``df`` as a table in the shared checkpoint folder and cut its lineage.

    The input is computed once, nothing is held in memory, and later reads prune
    columns and know the size (``checkpoint()`` gives rows of unknown size).  Row
    order is not kept; callers order by their own keys.
    """
    return write_table(df, scratch_path(df.sparkSession, "checkpoint"))


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries run inside go when the query ends.  Left to the driver's
    garbage collection, they stay on disk beside all that follows."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def write_table(df, path: str, by: Sequence[str] = ()):
    """Write ``df`` to a new folder and read it back."""
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, partitionBy=list(by) or None, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this run has written and needs no more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_scratch(df) -> None:
    """Delete the scratch tables that ``df`` reads; the caller has no more use for them."""
    scratch = urlparse(checkpoint_root(df.sparkSession)).path.rstrip("/") + "/colloquia/"
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if urlparse(folder).path.startswith(scratch):
            drop_table(df.sparkSession, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "colloquia", f"{name}-{uuid.uuid4().hex[:12]}")


def model_folder(spark: SparkSession) -> str:
    """The folder of trained models: shared, and the same in every session that names the
    same ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return os.path.join(named or checkpoint_root(spark), "colloquia-models")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side writers see a plain path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def spread(df):
    """Round-robin a scan of a single split over the cluster's cores.

    A table stored as one file with one row group is read by a single task;
    everything downstream would then run on one core.  Any table of two splits
    or more passes through untouched (the partition count is known from
    planning, no job runs).
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if want > 1 and df.rdd.getNumPartitions() == 1:
        return df.repartition(want)
    return df


def path_exists(path: str) -> bool:
    """Whether a folder or file exists, in whatever store Hadoop's clients reach."""
    spark = SparkSession.getActiveSession()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return where.getFileSystem(conf).exists(where)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``colloquia`` importable in Python workers (``addPyFile`` of a zip).

    Arrow functions pickle references to this package; executors (and local
    workers started outside the repository) need the package on their path.
    Done once per SparkContext; the zip is written to the shared checkpoint
    folder and Spark hands it to every executor.
    """
    import zipfile

    import colloquia

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(colloquia.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    root = checkpoint_root(spark)
    name = f"colloquia-{uuid.uuid4().hex[:8]}.zip"
    if root.startswith("file:") or "://" not in root:
        zpath = os.path.join(local_path(root), name)
        with open(zpath, "wb") as fh:
            fh.write(buf.getvalue())
    else:   # the shared folder of the cluster
        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(root)
        with fs.open_output_stream(f"{base}/{name}") as out:
            out.write(buf.getvalue())
        zpath = f"{root.rstrip('/')}/{name}"
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def table(spark: SparkSession, sf_dir: str, name: str):
    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))
