"""Where rows that are used more than once are kept: the folder that all executors and the driver share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, or that the session's checkpoint folder has been set to.

    Where neither is set it is a folder in the warehouse, which all machines of a cluster see as well.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_passtrail_stored"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """An empty folder below the shared one, as a URI."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path)
    return store.makeQualified(path).toString()


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows as Parquet into the shared folder and read them back: later uses do not compute them again."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
