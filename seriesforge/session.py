"""Session defaults, and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed where it is not installed on the workers; registered queries call it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="seriesforge-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "seriesforge") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only where that is unset and the master is local (tests) is a temporary folder chosen, once per session, and
    removed with the process. On a cluster each executor would write to its own disk, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="seriesforge-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder.

    Used before iterative work, so that each pass reads files that outlive an
    executor instead of recomputing the features.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read again.

    For large tables that several passes read a few columns of, where rows of a checkpoint would be read whole.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
