"""Source lists in YAML, settings, and files as rows of bytes."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """Options of a run; every field can come from an environment variable of its name in capitals."""

    chunk_max_tokens: int = 700
    chunk_overlap_tokens: int = 80
    chunk_min_tokens: int = 40
    embed_batch_size: int = 64
    embed_model: str = "text-embedding-3-small"
    request_delay: float = 1.0
    embed_delay: float = 0.1
    max_retries: int = 4
    timeout: int = 30
    enable_ocr: bool = False

    @classmethod
    def from_environment(cls) -> Settings:
        read = {"bool": lambda x: x.lower() in ("1", "true", "yes"), "int": int, "float": float, "str": str}
        return cls(**{f.name: read[f.type](os.environ[f.name.upper()]) for f in fields(cls) if f.name.upper() in os.environ})


def read_source_list(spark: SparkSession, path: str) -> DataFrame:
    """``id, url, title, tags`` of a YAML list; ``tags`` is JSON text, so nested values keep their types.

    Items without an id, and items that aren't maps, are left out; a missing url or title is an error.
    """
    import json

    import yaml

    with open(path, encoding="utf-8") as f:
        listed = yaml.safe_load(f) or []
    if isinstance(listed, dict):
        listed = listed.get("sources", [])
    rows = [(str(x["id"]), x["url"], x["title"], json.dumps(x.get("tags") or {}, default=str, ensure_ascii=False)) for x in listed if isinstance(x, dict) and x.get("id") is not None]
    return spark.createDataFrame(rows, "id string, url string, title string, tags string")


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, modified_at, length, content`` of files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("modificationTime").alias("modified_at"), "length", "content")
