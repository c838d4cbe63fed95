"""Tables written to the folder that all executors share.

Cutting lineage with a written table (not a cached or locally checkpointed one) means that a lost
executor costs only the tasks that were running on it.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_saved: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; on a local master without it, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    atexit.register(shutil.rmtree, made.removeprefix("file://"), True)
    return made


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # noqa: BLE001  the session may have ended before; the folder is then left to its owner
        pass


def new_path(spark: SparkSession, tag: str) -> str:
    """A path of its own below the shared folder, removed when this process ends."""
    path = f"{shared_dir(spark)}/corpusloom-{tag}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, path)
    return path


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    saved = spark.read.schema(df.schema).parquet(path)
    _saved[saved] = path
    return saved


def unsave(saved: DataFrame) -> None:
    """Remove a table that ``save`` made and nothing will read again."""
    _remove(saved.sparkSession, _saved.pop(saved))


#: Inputs of fewer bytes are dealt anew, in parts of about so many.
SMALL_INPUT, PART = 64 << 20, 1 << 20


def spread(scan: DataFrame) -> DataFrame:
    """A small input on as many tasks as are worth it: a file of one row group is a single task, however many splits it has.

    Larger inputs, and those of as many splits anyway, are left alone: rows would be moved for nothing.
    """
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = min(scan.sparkSession.sparkContext.defaultParallelism, size // PART + 1)
    return scan.repartition(parts) if 1 < parts and size < SMALL_INPUT and scan.rdd.getNumPartitions() < parts else scan


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, where it is neither installed nor on their path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    app = spark.sparkContext.applicationId
    if app in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or "site-packages" in root:
        return
    _shipped.add(app)
    folder = tempfile.mkdtemp(prefix="corpusloom-code-")
    atexit.register(shutil.rmtree, folder, True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/corpusloom", "zip", root, "corpusloom"))
