"""Sources: documents, their pages and images, listed and read by Spark's own readers.

Rendering a page needs a renderer, which is passed in: an object with ``page_count(content)`` and
``render(content, page_numbers, dpi)`` that yields (page_no, image) with numpy images. None comes with the library.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.text import parent, stem
from gridloom.settings import PAGE, SETTINGS


class Renderer(Protocol):
    def page_count(self, content: bytes) -> int: ...

    def render(self, content: bytes, pages: list[int], dpi: int) -> Iterable[tuple[int, np.ndarray]]: ...


def documents(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """(path, pdf_name, length[, content]) of the *.pdf files right in a folder; without content none is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select("path", stem(F.col("path")).alias("pdf_name"), "length", *["content"] * content)


def page_counts(files: DataFrame, renderer: Renderer) -> DataFrame:
    """(pdf_name, n_pages, error) of documents with content; those that can't be opened have 0 pages and an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content in zip(batch.column("pdf_name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    rows.append((name, renderer.page_count(content), None))
                except Exception as e:  # a broken document is a result, not a failure of the job
                    rows.append((name, 0, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.string()), strict=True)], names=["pdf_name", "n_pages", "error"])

    return files.select("pdf_name", "content").mapInArrow(run, "pdf_name string, n_pages int, error string")


def relevant(page_no: Column, n_pages: Column) -> Column:
    """From the third page to the last but one."""
    return (page_no >= 3) & (page_no < n_pages)


def rendered_pages(files: DataFrame, renderer: Renderer, which: str | tuple[int, int] = "relevant", dpi: int = SETTINGS.dpi) -> DataFrame:
    """PAGE rows, one a page: ``relevant``, ``first``, ``all``, or from one number up to but not with another. Pages are chosen before anything is rendered, and each
    is rendered once; a page is a batch of its own, as it may have 50 MB. Documents that fail give no pages."""

    def wanted(n: int) -> list[int]:
        if isinstance(which, tuple):
            return list(range(max(1, which[0]), min(which[1], n + 1)))
        return {"relevant": list(range(3, n)), "first": [1][:n], "all": list(range(1, n + 1))}[which]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    found = renderer.render(row["content"], wanted(renderer.page_count(row["content"])), dpi)
                    for page_no, image in found:
                        yield page_batch(row["pdf_name"], page_no, image)
                except Exception:  # counted by page_counts
                    continue

    return files.select("pdf_name", "content").mapInArrow(run, PAGE)


_PAGE_ARROW = pa.schema([("pdf_name", pa.string()), ("page_no", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("data", pa.binary())])


def page_batch(pdf_name: str, page_no: int, image: np.ndarray) -> pa.RecordBatch:
    channels = 1 if image.ndim == 2 else image.shape[2]
    row = {"pdf_name": pdf_name, "page_no": page_no, "height": image.shape[0], "width": image.shape[1], "channels": channels, "data": image.tobytes()}
    return pa.RecordBatch.from_pylist([row], schema=_PAGE_ARROW)


def as_image(row: dict) -> np.ndarray:
    """The array of a row with height, width, channels and data."""
    shape = (row["height"], row["width"]) + ((row["channels"],) if row["channels"] > 1 else ())
    return np.frombuffer(row["data"], dtype=np.uint8).reshape(shape)


def image_files(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """(path, pdf_name, file_name) of the images below ``folder``/<document>; a missing folder has none."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, pdf_name string, file_name string")
    return files.select("path", parent(F.col("path")).alias("pdf_name"), F.regexp_extract("path", "([^/]*)$", 1).alias("file_name"))


def images(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """(path, pdf_name, file_name, height, width, channels, data) decoded on the JVM; what isn't an image is left out.

    The reader's channels are blue, green, red; they are turned round here. A missing folder has none.
    """
    try:
        rows = spark.read.format("image").option("dropInvalid", "true").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, pdf_name string, file_name string, height int, width int, channels int, data binary")
    rows = rows.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))
    schema = T.StructType(rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["channels"] >= 3:
                    a = as_image(row)
                    row["data"] = np.concatenate([a[..., 2::-1], a[..., 3:]], axis=2).tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    rows = rows.mapInArrow(run, schema)
    return rows.select("path", parent(F.col("path")).alias("pdf_name"), F.regexp_extract("path", "([^/]*)$", 1).alias("file_name"), "height", "width", "channels", "data")
