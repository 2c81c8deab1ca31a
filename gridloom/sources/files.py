"""Sinks: files named by row, image encoding, and the removal of what isn't needed any more."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def png(image: np.ndarray) -> bytes:
    """A PNG file of a gray, RGB or RGBA image."""
    rows = image.reshape(image.shape[0], -1)
    kind = {1: 0, 3: 2, 4: 6}[1 if image.ndim == 2 else image.shape[2]]
    raw = np.concatenate([np.zeros((len(rows), 1), dtype=np.uint8), rows], axis=1).tobytes()
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def write_named(files: DataFrame, folder: str) -> DataFrame:
    """Write each row (file_path, content binary) to ``folder``/file_path, over what is there; OUTCOME rows come back.

    A file is written under another name and then moved, so a task that is run again leaves whole files. The folder
    must be one that all executors share. The result is lazy: files are written when it is read, once a read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        made = set()
        for batch in batches:
            rows = []
            for path, content in zip(batch.column("file_path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    target = f"{root}/{path}"
                    above = target.rpartition("/")[0]
                    if above not in made:
                        fs.create_dir(above, recursive=True)
                        made.add(above)
                    part = f"{above}/.{uuid.uuid4().hex}"
                    with fs.open_output_stream(part) as out:
                        out.write(content or b"")
                    fs.move(part, target)
                    rows.append({"file_path": path, "success": True, "error": None})
                except Exception as e:
                    rows.append({"file_path": path, "success": False, "error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file_path", pa.string()), ("success", pa.bool_()), ("error", pa.string())]))

    return files.select("file_path", F.col("content").cast("binary")).mapInArrow(run, "file_path string, success boolean, error string")


def text_files(texts: DataFrame) -> DataFrame:
    """(file_path, content) of one UTF-8 text file an image, for rows (pdf_name, stem, text)."""
    return texts.select(F.concat_ws("/", "pdf_name", F.concat("stem", F.lit(".txt"))).alias("file_path"), F.encode("text", "UTF-8").alias("content"))


def remove_files(outcomes: DataFrame, folder: str) -> DataFrame:
    """Remove the files of outcomes that succeeded, and folders that this leaves empty. Never done unless called."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as f

        fs, root = _open(folder)
        for batch in batches:
            for path in batch.column("file_path").to_pylist():
                target = f"{root}/{path}"
                if fs.get_file_info(target).type == f.FileType.File:
                    fs.delete_file(target)
                above = target.rpartition("/")[0]
                if above != root and fs.get_file_info(above).type == f.FileType.Directory and not fs.get_file_info(f.FileSelector(above)):
                    fs.delete_dir(above)
            yield batch

    return outcomes.where("success").select("file_path").mapInArrow(run, "file_path string")


def image_content(images: DataFrame, suffix: str = ".png", encode: Callable[[np.ndarray], bytes] = png) -> DataFrame:
    """(file_path, content) of rows (pdf_name, file_name, height, width, channels, data): the document's folder, the name with a new suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                shape = (row["height"], row["width"]) + ((row["channels"],) if row["channels"] > 1 else ())
                content = encode(np.frombuffer(row["data"], dtype=np.uint8).reshape(shape))
                path = f"{row['pdf_name']}/{row['file_name'].rpartition('.')[0] or row['file_name']}{suffix}"
                yield pa.RecordBatch.from_pylist([{"file_path": path, "content": content}])

    return images.select("pdf_name", "file_name", "height", "width", "channels", "data").mapInArrow(run, "file_path string, content binary")
