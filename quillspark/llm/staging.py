"""Written tables that cut lineage, in the folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share.

    It is read from the session's ``spark.checkpoint.dir``. Only a local master may go without that
    setting (tests); a cluster without it is an error, as a folder of one machine would lose rows.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="quillspark-")
    return _LOCAL[app]


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Losing an executor afterwards costs nothing, as the written files outlive it; unlike a cache the
    table takes no executor memory. The table is deleted when the driver's JVM ends, or before by
    ``delete_staged``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.option("compression", "zstd").parquet(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_staged(spark: SparkSession) -> None:
    """Deletes all tables staged so far; results that still read them must have been written before."""
    while _WRITTEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
