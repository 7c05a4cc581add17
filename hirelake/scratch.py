"""Tables written once to cut lineage, in the folder shared by all executors."""

import tempfile
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


@lru_cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="hirelake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a local session may run without that setting; on a cluster a
    machine-local folder would be lost to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{label}-{uuid4().hex}"


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet and read it back: computed once, survives lost
    executors, read with column pruning and a known size."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
