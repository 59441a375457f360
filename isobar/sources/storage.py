"""Where tables between jobs and stream checkpoints lie."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares.

    Where none is set, a local session has one of its own; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = "/tmp/isobar-work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table of the shared folder, for plans that read them more than once."""
    spark = rows.sparkSession
    path = work_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once a session, for tasks that run Python."""
    context = spark.sparkContext
    if getattr(context, "_isobar_sent", False):
        return
    root = Path(__file__).resolve().parents[2]
    folder = Path(tempfile.mkdtemp(prefix="isobar-code-"))  # the driver serves it as long as the session lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "isobar_feeds.zip", "w") as z:
        for f in sorted((root / "isobar").rglob("*.py")):
            z.write(f, f.relative_to(root).as_posix())
    context.addPyFile(str(folder / "isobar_feeds.zip"))
    context._isobar_sent = True
