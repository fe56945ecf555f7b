"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


ROOT = str(Path(__file__).resolve().parents[1])
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def local_session(cores: str | int = "*", app: str = "titlemart") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies; a cluster without it there gets ``--py-files``."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), ROOT]))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="titlemart-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/titlemart/{context.applicationId}"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside go when the scope ends, and none before.

    What is read from them has to be stored or collected inside. Scopes nest.
    """
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(found).getLength()


def write_shared(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives Catalyst the
    true size: a later join broadcasts this side only if it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Remove this application's intermediate tables, when results are stored."""
    delete_folder(spark, shared_dir(spark))
