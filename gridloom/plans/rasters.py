"""Blocks found on drawn pages: rasters made of table rows, through the pixel kernels and the block operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import blocks as b
from gridloom.operators import raster

#: Size of a drawn page, and pages held in memory at a time.
DRAWN_W, DRAWN_H, PAGES = 900, 1000, 8


def drawn(seed: int) -> np.ndarray:
    """A white page with up to six ruled boxes whose places follow from the seed."""
    page = np.full((DRAWN_H, DRAWN_W), 255, dtype=np.uint8)
    for i in range(seed % 7):
        y, x = 40 + 310 * (i // 2), 40 + 430 * (i % 2)
        h, w = 120 + seed * 7 % 90, 260 + seed * 13 % 120
        page[y : y + h, x : x + w] = 0
        page[y + 4 : y + h - 4, x + 4 : x + w - 4] = 255
    return page


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "page", "x", "y", "w", "h"]
    for batch in batches:
        for start in range(0, len(batch), PAGES):
            rows = [
                (r["doc"], r["page"], *box)
                for r in batch.slice(start, PAGES).to_pylist()
                for box in raster.component_boxes(raster.adaptive_threshold(drawn(r["page"])))
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def raster_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One drawn page for each supplier: detected, deduplicated and numbered blocks."""
    pages = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((F.col("s_suppkey") % 10).alias("doc"), F.col("s_suppkey").alias("page"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # the rows are too small to tell how long their pages take
    boxes = pages.repartition(parts, "page").mapInArrow(_detect, "doc long, page long, x long, y long, w long, h long")
    kept = b.deduplicated(b.contour_candidates(boxes, DRAWN_W, DRAWN_H), ["doc", "page"])
    return b.numbered(kept, ["doc"], ["page", "idx"]).select("doc", "page", "idx", "voter_no", "x", "y", "w", "h")
