"""Token-ID files: frequency-ranked ids in byte-aligned variable-length coding, control bytes apart.

A file is a run of blocks; a block holds some documents:

    8 bytes   magic b"GLTOKEN1"
    3 x u64   documents, ids, data bytes
    documents x (i64 doc_id, u8 null mark, u64 ids)      columns one after another
    control   2 bits an id, four ids a byte: byte length of its rank, less 1
    data      each id's rank in 1 to 4 little-endian bytes

Ranks order ids by corpus frequency, so the frequent ones take one byte. The rank table is kept
once beside the files. A task writes its file under a name of its own attempt; only files named in
the rows that successful tasks return belong to the data set.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, drop, stage, workspace
from .tokens import encoder

MAGIC = b"GLTOKEN1"
_HEAD = struct.Struct("<8s3Q")

#: Ids in a block, unless one document has more: bounds the memory of writer and reader.
BLOCK_IDS = 1 << 20

#: Ids that one file holds about.
FILE_IDS = 1 << 25

_CODES = np.arange(256, dtype=np.int64)
#: By control byte: byte lengths of its four values, and where each begins.
LENGTHS = np.stack([(_CODES >> 2 * k & 3) + 1 for k in range(4)], axis=1)
STARTS = np.cumsum(LENGTHS, axis=1) - LENGTHS
TOTALS = LENGTHS.sum(axis=1)
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values; the last group is filled with zeros."""
    v = np.zeros(-(-len(values) // 4) * 4, dtype="<u4")
    v[: len(values)] = values
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    g = code.reshape(-1, 4).astype(np.uint8)
    control = g[:, 0] | g[:, 1] << 2 | g[:, 2] << 4 | g[:, 3] << 6
    keep = np.arange(4) <= code[:, None]
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` values, by table lookup of whole control bytes."""
    c = np.frombuffer(control, dtype=np.uint8)
    total = TOTALS[c]
    starts = (STARTS[c] + (np.cumsum(total) - total)[:, None]).ravel()[:n]
    lengths = LENGTHS[c].ravel()[:n]
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    words = np.lib.stride_tricks.as_strided(raw, (max(0, len(raw) - 3), 4), (1, 1))[starts]
    return np.ascontiguousarray(words).view("<u4").ravel() & _MASKS[lengths - 1]


def write_block(f, docs: list[int | None], counts: np.ndarray, ranks: np.ndarray) -> None:
    control, data = encode_values(ranks)
    f.write(_HEAD.pack(MAGIC, len(docs), len(ranks), len(data)))
    f.write(np.array([d or 0 for d in docs], dtype="<i8").tobytes())
    f.write(np.array([d is None for d in docs], dtype=np.uint8).tobytes())
    f.write(counts.astype("<u8").tobytes())
    f.write(control)
    f.write(data)


def read_blocks(f) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """doc_ids, ids of each document, and all ranks, block by block."""
    while head := f.read(_HEAD.size):
        magic, docs, n, size = _HEAD.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a token file")
        ids = np.frombuffer(f.read(8 * docs), dtype="<i8").tolist()
        null = f.read(docs)
        counts = np.frombuffer(f.read(8 * docs), dtype="<u8").astype(np.int64)
        control = f.read(-(-n // 4))
        yield [None if z else d for d, z in zip(ids, null, strict=True)], counts, decode_values(control, f.read(size), n)


def open_folder(uri: str):
    """File system and path of a shared folder that Python's workers read and write."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n, ids): packed little-endian ids of each whole text with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, len(batch), 1000)):
                tokens, at = enc.encode(part.column("text"))
                n = np.diff(at) + 1
                ids = np.insert(tokens, at[1:], np.array(end_id, dtype=tokens.dtype))
                offsets = np.concatenate([[0], np.cumsum(n)]) * ids.itemsize
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), packed.cast(pa.binary())], names=["doc_id", "n", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n long, ids binary")


def _width(tokenizer: str) -> str:
    return encoder(tokenizer).dtype.str


def frequency_ranks(tokens: DataFrame, dtype: str) -> np.ndarray:
    """ids in descending order of corpus count, ties to the smaller id; as many rows as the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                got = np.bincount(np.frombuffer(ids.as_buffer(), dtype=dtype))
                if len(got) > len(counts):
                    counts = np.pad(counts, (0, len(got) - len(counts)))
                counts[: len(got)] += got
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return rows.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(dtype=np.int64)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> tuple[DataFrame, np.ndarray]:
    """Encode (doc_id, text) and write token files in ascending doc_id order (null first) to ``folder``.

    Returns the list of files (file, part, docs, ids, base), where base is the number of ids in the
    files before, and the ids in rank order. Texts that are null are empty: their end id alone. Rows that
    repeat a doc_id are documents of their own. An empty table writes no file.
    """
    spark, dtype = docs.sparkSession, _width(tokenizer)
    staged = f"{folder}/ids"
    tokens = stage(tokenize(docs, tokenizer, end_id), staged)
    by_rank = frequency_ranks(tokens, dtype)
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_IDS))
    ranks = np.zeros(by_rank.max(initial=0) + 1, dtype=np.uint32)
    ranks[by_rank] = np.arange(len(by_rank))
    table = spark.sparkContext.broadcast(ranks)  # four bytes for each id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ranks, fs_path = table.value, open_folder(folder)
        part = TaskContext.get().partitionId()
        name, f = f"tokens-{part:06d}-{uuid.uuid4().hex}.bin", None
        docs_, ids, size, rows, all_ids = [], [], 0, 0, 0

        def flush() -> None:
            if docs_:
                write_block(f, docs_, np.array([len(x) for x in ids]), ranks[np.concatenate(ids)])
            docs_.clear()
            ids.clear()

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                f = f or fs_path[0].open_output_stream(f"{fs_path[1]}/{name}")
                docs_.append(doc)
                ids.append(np.frombuffer(raw.as_buffer(), dtype=dtype))
                size, rows, all_ids = size + len(ids[-1]), rows + 1, all_ids + len(ids[-1])
                if size >= BLOCK_IDS:
                    flush()
                    size = 0
        if f:
            flush()
            f.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "part": part, "docs": rows, "ids": all_ids}])

    done = tokens.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id").mapInArrow(run, "file string, part long, docs long, ids long")
    files = sorted(done.collect(), key=lambda r: r.part)  # one row a file
    drop(spark, staged)
    base, rows = 0, []
    for r in files:
        rows.append((r.file, r.part, r.docs, r.ids, base))
        base += r.ids
    return spark.createDataFrame(rows, "file string, part long, docs long, ids long, base long"), by_rank


def read_tokens(files: DataFrame, folder: str, by_rank: np.ndarray) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""
    spark = files.sparkSession
    table = spark.sparkContext.broadcast(by_rank.astype("<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        fs, path = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["base"]
                with fs.open_input_stream(f"{path}/{row['file']}") as f:
                    for docs, counts, ranks in read_blocks(f):
                        raw = memoryview(table.value[ranks].tobytes())
                        ends = np.cumsum(counts)
                        starts = ends - counts
                        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, start + starts, counts, crc)], names=names)
                        start += int(ends[-1])

    n = max(1, files.count())
    return files.repartitionByRange(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = workspace(spark, "tokens")
    files, by_rank = write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_tokens(files, folder, by_rank)
