"""Access to the parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table ``name`` (one parquet file or a folder of them) of ``directory``.

    Files are read as they lie: how finely they are split is the reader's setting
    (``spark.sql.files.maxPartitionBytes``) and the files' row groups, and costs no shuffle.
    """
    return spark.read.parquet(f"{directory}/{name}.parquet")
