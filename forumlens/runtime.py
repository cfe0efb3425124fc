"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", name: str = "forumlens", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there, driver and executors are one
    process. On a cluster without the setting this raises rather than write to one machine.
    """
    configured = spark.sparkContext.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="forumlens-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(tempfile.mkdtemp(prefix="forumlens-") + "/forumlens", "zip", root.parent, root.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


_written: dict[str, list[str]] = {}


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed by ``drop_materialized``."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared folder and read it back.

    A written table survives lost executors, and later reads prune columns.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete what this application materialized; frames that read it are of no use afterwards."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
