"""Repeated substrings removed exactly: two-stage suffix sorting within content-defined classes.

Every window of WINDOW bytes has a class: the least hash of its GRAM-byte substrings. Equal windows have equal
classes, wherever they stand, and neighbouring windows mostly share theirs, so a text falls into a
few runs of windows of one class. Runs are dealt by class:

- A run whose class is found nowhere else, and whose least substring once, repeats nothing.
- Runs of the same bytes, by two 64-bit hashes beside the class, repeat each other whole.
- What is left, at the borders of repeats, brings its bytes. Suffixes smaller than their successors are sorted
  directly, the others are induced by scanning the buckets, and windows whose common prefix with a
  neighbour in the suffix array has WINDOW bytes repeat.
- Classes of more than CLASS_RUNS runs or CLASS_BYTES bytes are dealt further, window by window, by 128-bit hash.

Classes that hold more than one of HOT_SHARE runs are found on a sample of texts, which only chooses their way: they
are counted by partial aggregates, and the counts are broadcast, so a passage that stands everywhere meets in no task.

Equal texts are handled once. Texts are bucketed by their hash, so only numbers are shuffled after that.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import HOT_SHARE, documents, drop, join_skewed, small_batches, stage, workspace

WINDOW, GRAM = 200, 80

#: Runs and bytes of a class that are sorted together; bytes of several classes' runs in one suffix array; positions handled at a time.
CLASS_RUNS, CLASS_BYTES, ARRAY_BYTES, SEGMENT = 4096, 1 << 23, 1 << 22, 1 << 20

#: One in so many texts is looked at to find hot classes.
SAMPLE = 64

_M = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.Generator(np.random.PCG64(200)).integers(0, 1 << 64, size=(2, 256), dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64."""

    def __init__(self, n: int):
        inverse = np.full(n, pow(int(_M), -1, 1 << 64), dtype=np.uint64)
        power = np.full(n, _M, dtype=np.uint64)
        power[0] = inverse[0] = 1
        self.up, self.down = np.multiply.accumulate(power), np.multiply.accumulate(inverse)


_POWERS: list[_Powers] = []


def _prefix(x: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which any substring's hash follows, and the factors to take it back to the start."""
    if not _POWERS:
        _POWERS.append(_Powers(SEGMENT + 2 * WINDOW))
    p = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(table[x] * _POWERS[0].up[: len(x)], out=p[1:])
    return p, _POWERS[0].down


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours: of blocks' running minima from the right and from the left."""
    n = len(h) - w + 1
    padded = np.full(-(-len(h) // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(h)] = h
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def runs(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """(low, high, class, two content hashes, own) of the runs of windows that begin at low .. high of a text's bytes.

    own: the class's substring occurs twice or more near the run, so windows within the run may be equal.
    """
    out = []
    for at in range(0, len(x) - WINDOW + 1, SEGMENT):
        part = x[at : at + SEGMENT + WINDOW - 1]
        p, down = _prefix(part, _BYTES[0])
        grams = _mixed((p[GRAM:] - p[:-GRAM]) * down[: len(part) - GRAM + 1])
        least = _least(grams, WINDOW - GRAM + 1)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        low = np.concatenate([[0], cut])
        high = np.concatenate([cut, [len(least)]]) - 1
        ordered = np.sort(grams)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        contents = []
        for sums in (p, _prefix(part, _BYTES[1])[0]):
            contents.append(_mixed((sums[high + WINDOW] - sums[low]) * down[low] + (high - low).astype(np.uint64) * _M).view(np.int64))
        out.append((low + at, high + at, least[low].view(np.int64), *contents, np.isin(least[low], again)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (*(np.zeros(0, dtype=np.int64) for _ in range(5)), np.zeros(0, dtype=bool))


def window_hashes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window of a short piece."""
    out = []
    for table in _BYTES:
        p, down = _prefix(x, table)
        out.append(_mixed((p[WINDOW:] - p[:-WINDOW]) * down[: len(x) - WINDOW + 1]).view(np.int64))
    return out[0], out[1]


def sort_suffixes(x: np.ndarray, wanted: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """The ``wanted`` places of ``x`` in the order of the ``depth`` or more bytes from there on.

    Two-stage sorting: places whose suffix is smaller than its successor's are sorted, word by word among those
    still equal; each other place is put behind its successor by one scan over the buckets of first bytes.
    ``x`` must have ``depth`` bytes behind every wanted place.
    """
    n = len(x)
    differs = np.flatnonzero(x[1:] != x[:-1])
    after = np.searchsorted(differs, np.arange(n - 1))
    end = np.where(after < len(differs), differs[np.minimum(after, max(len(differs) - 1, 0))], n - 1) if len(differs) else np.full(n - 1, n - 1)
    small = np.zeros(n, dtype=bool)  # a run of one byte up to the end is followed by nothing, which is smaller
    small[:-1] = (end < n - 1) & (x[np.minimum(end + 1, n - 1)] > x[:-1])
    # a place that isn't small needs its successors up to a small one
    needed = np.zeros(n, dtype=bool)
    needed[wanted] = True
    edge = np.flatnonzero(needed & ~small)
    while len(edge):
        edge = edge[edge < n - 1] + 1
        edge = edge[~needed[edge]]
        needed[edge] = True
        edge = edge[~small[edge]]
    order = _sorted_directly(x, np.flatnonzero(needed & small), depth)
    first = np.searchsorted(x[order], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[n - 1]:
        buckets[x[n - 1]].append(np.array([n - 1]))
    out = []

    def before(places: np.ndarray) -> np.ndarray:
        p = places[places > 0] - 1
        return p[needed[p] & ~small[p]]

    for c in range(256):
        scan = np.concatenate(buckets[c]) if buckets[c] else np.zeros(0, dtype=np.int64)
        levels = [scan]
        while len(scan):
            scan = before(scan)
            scan = scan[x[scan] == c]
            levels.append(scan)
        bucket = np.concatenate([*levels, order[first[c] : first[c + 1]]])
        if len(bucket):
            out.append(bucket)
            p = before(bucket)
            p = p[x[p] > c]
            by = np.argsort(x[p], kind="stable")
            p = p[by]
            cut = np.searchsorted(x[p], np.arange(257))
            for d in np.flatnonzero(np.diff(cut)):
                buckets[d].append(p[cut[d] : cut[d + 1]])
    ranked = np.concatenate(out) if out else np.zeros(0, dtype=np.int64)
    keep = np.zeros(n, dtype=bool)
    keep[wanted] = True
    return ranked[keep[ranked]]


def _words(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as numbers in their order; zeros behind the end."""
    view = np.lib.stride_tricks.as_strided(x, (len(x) - 7, 8), (1, 1))
    return np.ascontiguousarray(view[np.minimum(places, len(x) - 8)]).view(">u8").ravel().astype(np.uint64)


def _sorted_directly(x: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    padded = np.concatenate([x, np.zeros(depth + 16, dtype=np.uint8)])
    places = places[np.argsort(_words(padded, places), kind="stable")] if len(places) else places
    word = _words(padded, places)
    tied = np.zeros(len(places), dtype=np.int64)  # group of places equal so far
    tied[1:] = np.cumsum(word[1:] != word[:-1]) if len(places) else 0
    active = np.arange(len(places))
    for at in range(8, depth + 8, 8):
        g = tied[active]
        again = np.zeros(len(g), dtype=bool)
        again[1:] |= g[1:] == g[:-1]
        again[:-1] |= again[1:] & (g[1:] == g[:-1])
        active, g = active[again], g[again]
        if not len(active):
            break
        word = _words(padded, places[active] + at)
        by = np.lexsort((word, g))
        places[active], word = places[active][by], word[by]
        new = np.ones(len(g), dtype=bool)
        new[1:] = (g[1:] != g[:-1]) | (word[1:] != word[:-1])
        tied[active] = np.cumsum(new)
    return places


def repeated(x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Those of the ``wanted`` places of ``x`` whose windows occur at another wanted place too."""
    order = sort_suffixes(x, wanted)
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for at in range(0, WINDOW, 8):  # common prefix of neighbours, while there is one
        live = np.flatnonzero(same)
        same[live] = _words(x, order[live] + at) == _words(x, order[live + 1] + at)
    found = np.zeros(len(order), dtype=bool)
    found[:-1] |= same
    found[1:] |= same
    return np.sort(order[found])


def spans(starts: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges covered by windows that begin at these places, in order."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > WINDOW)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), (starts[np.concatenate([cut, [len(starts) - 1]])] + WINDOW).tolist(), strict=True))


def _raw(value) -> np.ndarray:
    buffer = value.as_buffer()
    return np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, dtype=np.uint8)


def _batch(kinds: dict[str, pa.DataType], **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in kinds.items()], names=list(kinds))


def _find_runs(batches: Iterator[pa.RecordBatch], hot: tuple[int, ...] = (), only: bool = False) -> Iterator[pa.RecordBatch]:
    """The runs of all classes but these, or of these only."""
    names = ["t1", "t2", "low", "high", "class", "content", "content2", "own"]
    for batch in batches:
        found: list[tuple[np.ndarray, ...]] = []
        size = 0
        for t1, t2, text in zip(batch.column("t1").to_numpy(), batch.column("t2").to_numpy(), batch.column("raw"), strict=True):
            parts = runs(_raw(text))
            if hot:
                wanted = np.isin(parts[2], hot, invert=not only)
                parts = tuple(c[wanted] for c in parts)
            n = len(parts[0])
            found.append((np.full(n, t1), np.full(n, t2), *parts))
            size += n
            if size > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=names)
                found, size = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=names)


_PIECES = {"class": pa.int64(), "t1": pa.int64(), "t2": pa.int64(), "low": pa.int64(), "h1": pa.int64(), "h2": pa.int64(), "piece": pa.binary()}


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of each run, or of a hot class's run the hashes of its windows (piece null, class 0)."""
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for t1, t2, text, listed in zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), batch.column("raw"), batch.column("runs").to_pylist(), strict=True):
            x = _raw(text)
            for r in listed:
                piece = x[r["low"] : r["high"] + WINDOW]
                if r["hot"]:
                    for at in range(0, len(piece) - WINDOW + 1, SEGMENT >> 4):
                        h1, h2 = window_hashes(piece[at : at + (SEGMENT >> 4) + WINDOW - 1])
                        n, low = len(h1), np.arange(len(h1)) + r["low"] + at
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.zeros(n, dtype=np.int64), np.full(n, t1), np.full(n, t2), low, h1, h2)] + [pa.nulls(n, pa.binary())], names=list(_PIECES))
                else:
                    rows.append((r["class"], t1, t2, r["low"], None, None, piece.tobytes()))
                    size += len(piece)
                if size > ARRAY_BYTES or len(rows) > 20_000:
                    yield _batch(_PIECES, **dict(zip(_PIECES, zip(*rows, strict=True), strict=True)))
                    rows, size = [], 0
        if rows:
            yield _batch(_PIECES, **dict(zip(_PIECES, zip(*rows, strict=True), strict=True)))


_MARKS = {"t1": pa.int64(), "t2": pa.int64(), "low": pa.int64(), "stop": pa.int64()}


def _sort_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges (t1, t2, low, stop) that repeat, from the pieces of whole classes at a time."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        pieces = [np.frombuffer(r[4], dtype=np.uint8) for r in rows]
        lengths = np.array([len(p) for p in pieces])
        x, base = np.concatenate(pieces), np.cumsum(lengths) - lengths
        wanted = np.concatenate([b + np.arange(n - WINDOW + 1) for b, n in zip(base.tolist(), lengths.tolist(), strict=True)])
        found = repeated(x, wanted)
        of = np.searchsorted(base, found, side="right") - 1
        marks = []
        for k, part in zip(*_grouped(of, found), strict=True):
            _, t1, t2, low, _ = rows[k]
            marks += [(t1, t2, low + a - int(base[k]), low + b - int(base[k])) for a, b in spans(part)]
        return _batch(_MARKS, **dict(zip(_MARKS, zip(*marks, strict=True) if marks else [[]] * 4, strict=True)))

    rows: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        for r in zip(*[batch.column(c).to_pylist() for c in ("class", "t1", "t2", "low", "piece")], strict=True):
            if size >= ARRAY_BYTES and r[0] != last:
                yield solved(rows)
                rows, size = [], 0
            rows.append(r)
            size, last = size + len(r[4]), r[0]
    if rows:
        yield solved(rows)


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values by key; keys ascend."""
    cut = np.flatnonzero(np.diff(keys)) + 1
    return (keys[np.concatenate([[0], cut])].tolist(), np.split(values, cut)) if len(keys) else ([], [])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["t1", "t2", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for t1, t2, text, copies, marks in zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), batch.column("raw"), batch.column("copies").to_pylist(), batch.column("marks").to_pylist(), strict=True):
            x = _raw(text)
            ranges = [(0, len(x))] if copies > 1 and len(x) >= WINDOW else merged(marks or [])
            kept, at = hashlib.sha256(), 0
            for a, b in [*ranges, (len(x), len(x))]:
                kept.update(x[at:a].tobytes())
                at = b
            rows.append((t1, t2, len(x), sum(b - a for a, b in ranges), len(ranges), kept.hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "kept_sha256" else pa.int64()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def merged(marks: list) -> list[tuple[int, int]]:
    """Maximal ranges of the union of ranges."""
    out: list[list[int]] = []
    for a, b in sorted((m["low"], m["stop"]) for m in marks):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _judged(texts: DataFrame, folder: str) -> DataFrame:
    """(t1, t2, low, high, class, whole, sorted, hot) of the runs that may repeat.

    whole: the run's bytes stand elsewhere too; sorted: it is to be sorted with its class, as one of equal runs at most;
    hot: the class is too large to be sorted.
    """
    schema = "t1 long, t2 long, low long, high long, class long, content long, content2 long, own boolean"
    size, content = F.sum(F.col("high") - F.col("low") + WINDOW), F.struct("content", "content2")
    of = ["class", "content", "content2"]

    def told(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("sorted", (F.col("n") == 1) | F.col("first") & (F.col("least") < F.col("most")))
        hot = (F.col("n_class") > CLASS_RUNS) | (F.col("size") > CLASS_BYTES)
        return rows.where("n_class > 1 or own").select("t1", "t2", "low", "high", "class", (F.col("n") > 1).alias("whole"), "sorted", hot.alias("hot"))

    seen = texts.where(F.pmod("t1", F.lit(SAMPLE)) == 0).mapInArrow(_find_runs, schema).groupBy("class").count()
    bound = max(CLASS_RUNS, seen.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] * SAMPLE // HOT_SHARE)
    hot = [r["class"] for r in seen.where(F.col("count") > bound // SAMPLE).collect()]  # at most HOT_SHARE

    of_class, of_content = Window.partitionBy("class"), Window.partitionBy(*of)
    cold = texts.mapInArrow(lambda batches: _find_runs(batches, tuple(hot)), schema)
    cold = cold.withColumns({"n_class": F.count("*").over(of_class), "size": size.over(of_class), "least": F.min(content).over(of_class), "most": F.max(content).over(of_class)}).where("n_class > 1 or own")
    cold = told(cold.withColumns({"n": F.count("*").over(of_content), "first": F.row_number().over(of_content.orderBy("t1", "t2", "low")) == 1}))
    if not hot:
        return cold
    rows = stage(texts.mapInArrow(lambda batches: _find_runs(batches, tuple(hot), only=True), schema), f"{folder}/hot")
    place = F.struct("t1", "t2", "low")
    classes = rows.groupBy("class").agg(F.count("*").alias("n_class"), size.alias("size"), F.min(content).alias("least"), F.max(content).alias("most"))
    runs_ = rows.groupBy(*of).agg(F.count("*").alias("n"), F.min(place).alias("place")).withColumn("key", F.concat_ws(",", *of)).drop(*of)
    rows = rows.join(F.broadcast(classes), "class").withColumn("key", F.concat_ws(",", *of))
    rows = join_skewed(rows, runs_.withColumn("times", F.col("n")), "key", "times", bound * HOT_SHARE, F.xxhash64("t1", "t2", "low"))
    return cold.union(told(rows.withColumn("first", place == F.col("place"))))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, null being empty. A byte is removed if a string of WINDOW bytes that covers it also
    starts anywhere else; strings are judged on the input. Texts shorter than WINDOW lose nothing. Rows of equal
    text get equal results, and repeated rows come back repeated. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = workspace(spark, "repeats")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("raw")).select("*", F.xxhash64("raw").alias("t1"), F.xxhash64(F.lit(1), "raw").alias("t2"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"gridloom_texts_{uuid.uuid4().hex}"
    once = keyed.groupBy("t1", "t2").agg(F.first("raw").cast("binary").alias("raw"), F.count("*").alias("copies"))
    once.repartition(parts, "t1", "t2").write.bucketBy(parts, "t1", "t2").option("path", f"{folder}/texts").option("compression", "zstd").saveAsTable(table)
    texts = spark.table(table)

    judged = stage(_judged(texts.where(F.length("raw") >= WINDOW).select("t1", "t2", "raw"), folder), f"{folder}/judged")

    wanted = judged.where("sorted").groupBy("t1", "t2").agg(F.collect_list(F.struct("low", "high", "class", "hot")).alias("runs"))
    pieces = texts.select("t1", "t2", "raw").join(wanted, ["t1", "t2"]).mapInArrow(_cut_pieces, "class long, t1 long, t2 long, low long, h1 long, h2 long, piece binary")
    pieces = stage(pieces, f"{folder}/pieces")
    arrays = pieces.where("piece is not null").select("class", "t1", "t2", "low", "piece").repartition(4 * parts, "class").sortWithinPartitions("class")
    arrays = arrays.mapInArrow(_sort_pieces, "t1 long, t2 long, low long, stop long")
    single = pieces.where("piece is null").select("t1", "t2", "low", "h1", F.concat_ws(",", "h1", "h2").alias("key"))
    bound = max(CLASS_RUNS, single.count() // HOT_SHARE)
    common = [r.key for r in single.groupBy("key").count().where(F.col("count") > bound).collect()]  # fewer than HOT_SHARE
    rest = (single.where(~F.col("key").isin(common)) if common else single).withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1").drop("n")
    single = (rest.union(single.where(F.col("key").isin(common))) if common else rest).select("t1", "t2", "low", (F.col("low") + WINDOW).alias("stop"))
    whole = judged.where("whole").select("t1", "t2", "low", (F.col("high") + WINDOW).alias("stop"))
    marks = whole.union(arrays).union(single).groupBy("t1", "t2").agg(F.collect_list(F.struct("low", "stop")).alias("marks"))
    done = texts.join(marks, ["t1", "t2"], "left").select("t1", "t2", "raw", "copies", "marks").mapInArrow(_remove, "t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    done = stage(done, f"{folder}/done")
    drop(spark, f"{folder}/judged")
    drop(spark, f"{folder}/pieces")

    key = F.concat_ws(",", "t1", "t2")
    each = keyed.select("doc_id", key.alias("key"))
    held = stage(texts.select(key.alias("key"), "copies"), f"{folder}/copies")
    spark.sql(f"DROP TABLE {table}")
    drop(spark, f"{folder}/texts")
    total = held.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    right = done.select(key.alias("key"), "n_bytes", "n_removed", "n_spans", "kept_sha256").join(held, "key")
    out = join_skewed(each, right, "key", "copies", total, F.col("doc_id"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


#: Every window of 200 bytes by its place, in hexadecimal and cut from pieces of a text; repeated ones by MD5, islands of them, and what is left.
ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT r, j, n, substr(x, 256 * j + 1, 654) AS y FROM (SELECT r, x, len(x) // 2 - 199 AS n, unnest(range((len(x) // 2 - 72) // 128)) AS j FROM d WHERE len(x) >= 400)),
k AS (SELECT r, 128 * j + o AS i, md5_number(substr(y, 2 * o + 1, 400)) AS s FROM (SELECT r, j, n, y, unnest(range(least(128, n - 128 * j))) AS o FROM c)),
s AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM k) WHERE n > 1),
e AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 AS joined FROM s),
g AS (SELECT r, i, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g FROM e),
p AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY r, g),
q AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM p),
m AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
    FROM q JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN m USING (r)
"""
