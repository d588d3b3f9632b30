"""Temporary tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of narrow data that may be broadcast after they have been counted.
BROADCAST_ROWS = 100_000
_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` or the context's checkpoint folder; a temporary folder only on a local master, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="spark-cohort-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below a folder of this application, which goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{shared_root(spark)}/cohort-{app}"
        atexit.register(_remove, spark, _roots[app])
    return f"{_roots[app]}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the JVM may have gone before this hook runs
        pass


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder on any file system that Spark knows; false if there was none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix><number>`` in a folder, ascending; none if it does not exist."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def stored(df: DataFrame, name: str, *, partition: str | None = None) -> DataFrame:
    """``df`` written as a table in the scratch folder and read back: it is computed once and survives lost executors."""
    path = scratch(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
