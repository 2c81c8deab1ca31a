"""Tables staged in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset a temporary folder, on a single machine only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="gridloom-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again, so that later reads see the same partitions and rows; gone with the application."""
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    df.write.parquet(at.toString())
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(at.toString())


#: Rows of keys, some 100 bytes each, that may be broadcast.
BROADCAST_ROWS = 200_000


def joined_to_keys(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Wide rows joined to a staged table of few columns: broadcast up to BROADCAST_ROWS rows, which are counted, so wide rows aren't shuffled."""
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys) if few else keys, on, how)
