"""Recognition of text on images by a backend that is passed in.

A backend is made once in each Python worker by a factory without arguments; it has ``recognize(image, autocast)``,
which returns a dict with ``text_lines`` (dicts with text, confidence, bbox, polygon), and may have ``page`` and
``image_bbox``, and ``release()``, which frees a device's memory after each batch. None comes with the library.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.settings import OCR
from gridloom.sources.documents import as_image

_BACKENDS: dict[str, object] = {}

_LINE = pa.struct([("text", pa.string()), ("confidence", pa.float64()), ("bbox", pa.list_(pa.float64())), ("polygon", pa.list_(pa.list_(pa.float64())))])
_RESULT = pa.struct([("page", pa.int32()), ("text_lines", pa.list_(_LINE)), ("image_bbox", pa.list_(pa.float64()))])


def backend_of(factory: Callable[[], object]):
    """The worker's backend of a factory, made at its first use."""
    name = f"{factory.__module__}.{factory.__qualname__}"
    if name not in _BACKENDS:
        _BACKENDS[name] = factory()
    return _BACKENDS[name]


def _read(backend, image) -> dict:
    try:
        found = backend.recognize(image, autocast=True)
    except TypeError as e:
        if "BFloat16" not in str(e):
            raise
        found = backend.recognize(image, autocast=False)  # once more in full precision
    keys = ("text", "confidence", "bbox", "polygon")
    lines = [{k: line.get(k) for k in keys} for line in found.get("text_lines", [])]
    return {"page": found.get("page", 1), "text_lines": lines, "image_bbox": found.get("image_bbox")}


def recognized(images: DataFrame, factory: Callable[[], object], key: list[str], images_per_batch: int = 5) -> DataFrame:
    """(key, result OCR, success, error, seconds) of images (key, height, width, channels, data); an error is a row's, not the job's."""
    columns = images.select(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = backend_of(factory)
        for batch in batches:
            for start in range(0, len(batch), images_per_batch):
                part = batch.slice(start, images_per_batch)
                results, errors, seconds = [], [], []
                for row in part.select(["height", "width", "channels", "data"]).to_pylist():
                    begin = time.perf_counter()
                    try:
                        results.append(_read(backend, as_image(row)))
                        errors.append(None)
                    except Exception as e:
                        results.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                    seconds.append(time.perf_counter() - begin)
                if hasattr(backend, "release"):
                    backend.release()
                own = [part.column(k) for k in key]
                yield pa.RecordBatch.from_arrays([*own, pa.array(results, _RESULT), pa.array([e is None for e in errors]), pa.array(errors, pa.string()), pa.array(seconds, pa.float64())], names=[*key, "result", "success", "error", "seconds"])

    schema = columns.schema.add("result", OCR).add("success", "boolean").add("error", "string").add("seconds", "double")
    return images.select(*key, "height", "width", "channels", "data").mapInArrow(run, schema)


def text_of(results: DataFrame, legacy_unified: bool = False) -> DataFrame:
    """Adds ``text``: the lines that have text, a line each; where recognition failed null, or in legacy mode empty."""
    some = F.filter("result.text_lines", lambda x: x.text.isNotNull() & (x.text != ""))
    text = F.array_join(F.transform(some, lambda x: x.text), "\n")
    return results.withColumn("text", F.coalesce(text, F.lit("")) if legacy_unified else text)
