"""Tables and files between jobs, in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir.

    Where that is unset, a local session, which is one machine, has a folder of
    its own; a cluster has none that all its machines share, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = "/tmp/isobar-checkpoints"
    return f"{base.rstrip('/')}/isobar-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "t") -> DataFrame:
    """The rows as a table on shared storage: later jobs start from files, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_isobar_path"] = path
    return out


def tidily(df: DataFrame, name: str = "t") -> DataFrame:
    """``written``, after which the job's shuffle files are deleted at once; else they stay until the driver collects garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        conf.set(key, before)


def settled(df: DataFrame) -> DataFrame:
    """Rows that every job reads in the same order: as they are where they come from files by filters and projections alone, else written."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    plain = all(x in ("Project", "Filter", "ColumnarToRow", "FileScan", "Scan", "LocalTableScan", "WholeStageCodegen") for x in re.findall(r"^[\s:+-]*(?:\*\(\d+\) )?([A-Za-z]+)", plan, re.M))
    return df if plain and not re.search(r"\brandn?\(", plan) else written(df)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` has made and no later job reads."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.__dict__["_isobar_path"])
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once a session, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_isobar_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    folder = Path(tempfile.mkdtemp(prefix="isobar-code-"))  # the driver serves it as long as the session lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = folder / "isobar_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "isobar").rglob("*.py")):
            z.write(f, f.relative_to(root).as_posix())
    context.addPyFile(str(path))
    context._isobar_shipped = True
