"""Documents as they arrive: the same stages over a stream of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.functions.text import stem

#: Columns of Spark's reader of whole files.
FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_documents(spark: SparkSession, folder: str, files_per_batch: int = 10) -> DataFrame:
    """(path, pdf_name, length, content) of new *.pdf files; a batch takes as many documents as a batch of a run."""
    files = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*.pdf").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return files.select("path", stem(F.col("path")).alias("pdf_name"), "length", "content")


def process_arriving(documents: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Run ``process`` on each batch of whole documents and write its rows below ``out``, one folder a batch.

    A document is in one batch, so numbering within documents needs no state; a batch that is run again
    overwrites its folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
