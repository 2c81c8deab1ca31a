"""The pipeline over rendered pages: detection, numbering, cutting, cleaning, recognition."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.text import voter_file
from gridloom.operators import blocks as b
from gridloom.operators import grid, ocr, raster, runs
from gridloom.settings import PAGE, SETTINGS
from gridloom.sources.documents import Renderer, as_image, rendered_pages
from gridloom.sources.staging import joined_to_keys, staged

_KEY = ["pdf_name", "page_no"]
_FOUND = "pdf_name string, page_no int, height int, width int, x long, y long, w long, h long, failed boolean"
_LINES = "pdf_name string, page_no int, height int, width int, h_lines array<bigint>, v_lines array<bigint>"


def _mapped(pages: DataFrame, schema: str, of: Callable[[dict], list[dict]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows = of(batch.slice(i, 1).to_pylist()[0])
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW[schema])

    return pages.mapInArrow(run, schema)


_ARROW = {
    _FOUND: pa.schema([("pdf_name", pa.string()), ("page_no", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), *[(c, pa.int64()) for c in "xywh"], ("failed", pa.bool_())]),
    _LINES: pa.schema([("pdf_name", pa.string()), ("page_no", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("h_lines", pa.list_(pa.int64())), ("v_lines", pa.list_(pa.int64()))]),
}


def _own(row: dict) -> dict:
    return {k: row[k] for k in ("pdf_name", "page_no", "height", "width")}


def _contours(row: dict) -> list[dict]:
    try:
        found = raster.component_boxes(raster.adaptive_threshold(raster.gray(as_image(row))))
    except Exception:  # the whole page stands for its blocks
        return [_own(row) | {"x": 0, "y": 0, "w": row["width"], "h": row["height"], "failed": True}]
    return [_own(row) | dict(zip("xywh", box, strict=True)) | {"failed": False} for box in found]


def _ruled(row: dict) -> list[dict]:
    try:
        ink = raster.adaptive_threshold(raster.gray(as_image(row)))
        return [_own(row) | {"h_lines": raster.line_positions(ink, False), "v_lines": raster.line_positions(ink, True)}]
    except Exception:
        return []


def detected_blocks(pages: DataFrame) -> DataFrame:
    """(pdf_name, page_no, idx, x1, y1, x2, y2) of the blocks of PAGE rows: from contours, on pages without any from ruled lines.

    Pages with ruled lines are looked at again only where contours give nothing. Bounds are those of each page's own size.
    """
    w, h = F.col("width"), F.col("height")
    boxes = staged(_mapped(pages, _FOUND, _contours), "boxes")  # pages are rendered and thresholded once for them
    kept = b.deduplicated(b.contour_candidates(boxes.where("not failed").select(*_KEY, "height", "width", "x", "y", "w", "h"), w, h), _KEY)
    left, top = F.greatest(F.lit(0).cast("long"), F.col("x") - SETTINGS.block_padding), F.greatest(F.lit(0).cast("long"), F.col("y") - SETTINGS.block_padding)
    kept = kept.select(*_KEY, "idx", left.alias("x1"), top.alias("y1"), (left + F.col("pw")).alias("x2"), (top + F.col("ph")).alias("y2"))
    failed = boxes.where("failed").select(*_KEY, F.lit(0).alias("idx"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("w").alias("x2"), F.col("h").alias("y2"))
    found = staged(kept.unionByName(failed), "found")
    rest = joined_to_keys(pages, found.select(*_KEY).distinct(), _KEY, "left_anti")
    lines = _mapped(rest.select(*PAGE.fieldNames()), _LINES, _ruled)
    merged = lines.select(*_KEY, "height", "width", *[grid.merge_close(F.col(c), gap).alias(c) for c, gap in (("h_lines", SETTINGS.horizontal_gap), ("v_lines", SETTINGS.vertical_gap))])
    cells = grid.grid_blocks(grid.grid_cells(grid.viable(merged), [*_KEY, "height", "width"], w, h), w, h)
    cells = b.strict_if_many(cells, _KEY).select(*_KEY, F.col("cell_idx").alias("idx"), "x1", "y1", "x2", "y2")
    return found.unionByName(cells)


def cut_blocks(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(pdf_name, voter_no, file_name, height, width, channels, data) of each numbered block's pixels."""
    numbered = b.numbered(blocks, ["pdf_name"], ["page_no", "idx"])
    listed = staged(numbered.groupBy(*_KEY).agg(F.collect_list(F.struct("voter_no", "x1", "y1", "x2", "y2")).alias("blocks")), "listed")
    schema = "pdf_name string, voter_no long, height int, width int, channels int, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("pdf_name", pa.string()), ("voter_no", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("data", pa.binary())])
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                image = as_image(row)
                for k in row["blocks"]:
                    part = np.ascontiguousarray(image[k["y1"] : k["y2"], k["x1"] : k["x2"]])
                    yield pa.RecordBatch.from_pylist([{"pdf_name": row["pdf_name"], "voter_no": k["voter_no"], "height": part.shape[0], "width": part.shape[1], "channels": row["channels"], "data": part.tobytes()}], schema=kind)

    return joined_to_keys(pages, listed, _KEY, "inner").mapInArrow(run, schema).withColumn("file_name", voter_file(F.col("voter_no")))


def cleaned_blocks(cards: DataFrame, keep_on_error: bool = True, timed: bool = False) -> DataFrame:
    """Cards without border and inner boxes; what can't be cleaned stays as it was, or with ``keep_on_error`` off is left out.

    ``timed`` adds the seconds that each one took.
    """
    names = cards.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                row, start = one.to_pylist()[0], time.perf_counter()
                try:
                    image = np.ascontiguousarray(raster.cleaned(as_image(row)))
                    row |= {"height": image.shape[0], "width": image.shape[1], "data": image.tobytes()}
                except Exception:
                    if not keep_on_error:
                        continue
                out = pa.RecordBatch.from_pylist([row], schema=one.schema)
                yield out.append_column("seconds", pa.array([time.perf_counter() - start])) if timed else out

    schema = T.StructType([*cards.schema.fields, T.StructField("seconds", T.DoubleType())]) if timed else cards.schema
    return cards.mapInArrow(run, schema).select(*names, *["seconds"] * timed)


def first_pages(pages: DataFrame) -> DataFrame:
    """(pdf_name, file_name, height, width, channels, data, seconds) of the content of PAGE rows: the largest contour and a margin, or the whole page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row, start = batch.slice(i, 1).to_pylist()[0], time.perf_counter()
                image = as_image(row)
                try:
                    image = np.ascontiguousarray(raster.page_content(image, SETTINGS.page_padding))
                except Exception:  # the whole page stands for its content
                    pass
                out = {"pdf_name": row["pdf_name"], "file_name": FIRST_PAGE, "height": image.shape[0], "width": image.shape[1], "channels": row["channels"], "data": image.tobytes()}
                yield pa.RecordBatch.from_pylist([out | {"seconds": time.perf_counter() - start}], schema=_IMAGE)

    return pages.select(*PAGE.fieldNames()).mapInArrow(run, "pdf_name string, file_name string, height int, width int, channels int, data binary, seconds double")


FIRST_PAGE = "page_1.jpg"
_IMAGE = pa.schema([("pdf_name", pa.string()), ("file_name", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("data", pa.binary()), ("seconds", pa.float64())])


def preprocessed(files: DataFrame, renderer: Renderer, legacy_unified: bool = SETTINGS.legacy_unified) -> tuple[DataFrame, DataFrame]:
    """The first phase over documents (path, pdf_name, content): staged images and PREPROCESS rows.

    Images: (pdf_name, file_name, first, height, width, channels, data, seconds), cleaned cards and what page 1 holds. Nothing is
    recognised before all of them are written.
    """
    pages = rendered_pages(files, renderer)
    cards = cleaned_blocks(cut_blocks(pages, detected_blocks(pages)), keep_on_error=legacy_unified, timed=True)
    columns = ["pdf_name", "file_name", "height", "width", "channels", "data", "seconds"]
    images = cards.select(*columns, F.lit(False).alias("first")).unionByName(first_pages(rendered_pages(files, renderer, "first")).select(*columns, F.lit(True).alias("first")))
    images = staged(images, "images")
    of = files.select("pdf_name", F.col("path").alias("pdf_path"), F.concat(F.lit("clean_preprocessed/"), "pdf_name").alias("cleaned_dir"))
    return images, staged(runs.preprocess_stats(of, images.select("pdf_name", "first", "seconds")), "preprocess")


def read_texts(images: DataFrame, stats: DataFrame, factory: Callable[[], object], legacy_unified: bool = SETTINGS.legacy_unified) -> tuple[DataFrame, DataFrame]:
    """The second phase over documents whose first one succeeded: staged texts and OCR_STATS rows.

    Texts: (pdf_name, file_name, first, success, error, text, seconds). What page 1 holds is read like an image and told apart.
    """
    ready = runs.ready_for_ocr(stats.select("pdf_name"), stats)
    read = ocr.recognized(joined_to_keys(images, ready, ["pdf_name"], "left_semi").drop("seconds"), factory, ["pdf_name", "file_name", "first"])
    texts = staged(ocr.text_of(read, legacy_unified).drop("result"), "texts")
    return texts, staged(runs.ocr_stats(ready, texts.withColumnRenamed("success", "ok"), legacy_unified), "ocr")


def document_texts(pages: DataFrame, factory: Callable[[], object], legacy_unified: bool = SETTINGS.legacy_unified) -> DataFrame:
    """(pdf_name, voter_no, file_name, result, success, error, text) from PAGE rows to text."""
    cards = cleaned_blocks(cut_blocks(pages, detected_blocks(pages)), keep_on_error=legacy_unified)
    return ocr.text_of(ocr.recognized(cards, factory, ["pdf_name", "voter_no", "file_name"]), legacy_unified)
