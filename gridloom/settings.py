"""Settings of the pipeline, and the schemas that its stages exchange."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Settings:
    """Defaults of a run. ``legacy_unified`` counts an unreadable image as a success and page 1 as an image."""

    # Fixed values that runs of the same documents must share to give the same results.
    dpi: int = 400
    page_width: int = 3307
    page_height: int = 4677
    jpeg_quality: int = 95
    images_per_chunk: int = 5
    documents_per_batch: int = 10
    dedup_overlap: float = 0.7
    horizontal_gap: int = 30
    vertical_gap: int = 100
    block_padding: int = 5
    page_padding: int = 20
    border_inset: int = 5
    fill_padding: int = 2
    gigabytes_per_worker: float = 2.0
    legacy_unified: bool = False


SETTINGS = Settings()

_LONG, _TEXT = T.LongType(), T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: A raster as Spark's image source lays it out, but in RGB order.
RASTER = _struct(height=T.IntegerType(), width=T.IntegerType(), channels=T.IntegerType(), data=T.BinaryType())
PAGE = _struct(pdf_name=_TEXT, page_no=T.IntegerType(), height=T.IntegerType(), width=T.IntegerType(), channels=T.IntegerType(), data=T.BinaryType())
CONTOUR = _struct(pdf_name=_TEXT, page_no=T.IntegerType(), contour_idx=T.IntegerType(), x=_LONG, y=_LONG, w=_LONG, h=_LONG, n_vertices=T.IntegerType(), area=T.DoubleType())
BLOCK = _struct(y=_LONG, x=_LONG, w=_LONG, h=_LONG, ph=_LONG, pw=_LONG)
LINE = _struct(text=_TEXT, confidence=T.DoubleType(), bbox=T.ArrayType(T.DoubleType()), polygon=T.ArrayType(T.ArrayType(T.DoubleType())))
OCR = _struct(page=T.IntegerType(), text_lines=T.ArrayType(LINE), image_bbox=T.ArrayType(T.DoubleType()))
OUTCOME = _struct(file_path=_TEXT, success=T.BooleanType(), error=_TEXT)
PREPROCESS = _struct(pdf_name=_TEXT, pdf_path=_TEXT, total_voters=_LONG, cleaned=_LONG, page_1_saved=T.BooleanType(), cleaned_dir=_TEXT, preprocess_success=T.BooleanType(), time_taken=T.DoubleType())
OCR_STATS = _struct(pdf_name=_TEXT, ocr_successful=_LONG, ocr_failed=_LONG, page_1_ocr_successful=T.BooleanType(), time_taken=T.DoubleType())
