"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}
_tables: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a folder of this machine only in local mode where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="hexfold-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the application's own, which goes when Python ends before Spark does, or by ``remove``."""
    key = spark.sparkContext.applicationId
    if key not in _folders:
        _folders[key] = f"{shared_folder(spark)}/hexfold-{uuid.uuid4().hex}"
        atexit.register(remove, spark)
    return f"{_folders[key]}/{name}-{uuid.uuid4().hex}"


def new_table(name: str) -> str:
    """The name of a new table of the catalog, which goes with the folders."""
    _tables.append(f"hexfold_{name}_{uuid.uuid4().hex}")
    return _tables[-1]


def remove(spark: SparkSession) -> None:
    """Remove all intermediate tables of the application."""
    context = spark.sparkContext
    if context._jsc is None or not (folder := _folders.pop(context.applicationId, None)):
        return
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet, reread it."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
