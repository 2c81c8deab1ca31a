"""WARC archives: deduplicated writing, and reading in parallel by boundary-chain verification.

Tasks scan byte ranges of the files for record magic, which payloads may hold too. Each candidate's header
names where its successor would begin. Within a range the chains are followed at once; between ranges
pointer jumping from each file's start keeps the candidates that are reached, in a number of rounds that is the
logarithm of the ranges of a file. Only records on the chain from the start are read. A chain that doesn't end where
its file does, or a record that isn't whole, is an error: no record is lost without one.

A task writes its file under a name of its own attempt; only the files that successful tasks return
belong to the archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import drop, join_small, stage, workspace

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"

#: Smallest payload that another record may stand for; bytes after which a file is closed; bytes of a range.
LEAST, FILE_BYTES, RANGE = 1000, 1 << 28, 1 << 22

#: Bytes read at least behind a range for a header that goes on there, however long.
MORE = 1 << 16

_FIELD = re.compile(rb"(?i)content-length:[ \t]*(\d+)[ \t]*$|[!-9;-~]+:")
_HEADER = re.compile(rb"(?im)^([A-Za-z-]+): *(.*?)\r?$")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record; a revisit holds the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    lines += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return MAGIC + "\r\n".join(lines).encode() + END + block + END


_URL_SAFE = "".join(chr(c) for c in range(0x21, 0x7F))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(urn: bytes | None) -> int | None:
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", urn or b"")
    return int(found[1]) if found else None


def _folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); returns the files (file, bytes).

    Payloads are the html in UTF-8, empty for null; they are equal if SHA-1, a second hash and length are. Of equal
    payloads of at least LEAST bytes the record with the largest page_id is the response; the others revisit it. Rows that repeat that page_id are responses too;
    rows without page_id are revisits if any row of the group has one, else responses. An empty table gives no file.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("digest"), F.xxhash64("html").alias("hash"), F.octet_length("html").alias("size"))
    same = ["digest", "hash", "size"]
    long = rows.where(F.col("size") >= LEAST).groupBy(*same).agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    groups = stage(long.where("n > 1 and last is not null").select(*same, "last"), f"{folder}/groups")
    rows = join_small(rows, groups, same, salt=F.xxhash64("page_id"))
    rows = rows.withColumn("revisit", F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _folder(folder)
        out, name, size = None, "", 0
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "last", "revisit")], strict=True):
                if out is None:
                    name, size = f"pages-{uuid.uuid4().hex}.warc", 0
                    out = fs.open_output_stream(f"{path}/{name}")
                data = record(r[0], r[1], r[2].encode(), r[3], r[4], r[5])
                out.write(data)
                size += len(data)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pylist([{"file": name, "bytes": size}])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "bytes": size}])

    return stage(rows.select("page_id", "url", "html", "digest", "last", "revisit").mapInArrow(run, "file string, bytes long"), f"{folder}/files")


class Headers:
    """Header lines of a file from one place on. Each is read once, however many candidates it may belong to."""

    def __init__(self, f, at: int, size: int = MORE):
        self.f, self.at = f, at
        f.seek(at)
        self.data = f.read(size)
        self.known: dict[int, tuple[int, int] | None] = {}

    def _end(self, line: int) -> int:
        """Where a line's end mark stands; -1 at the file's end."""
        while (stop := self.data.find(b"\r\n", line)) < 0:
            self.f.seek(self.at + len(self.data))
            more = self.f.read(max(MORE, len(self.data)))
            if not more:
                return -1
            self.data += more
        return stop

    def behind(self, line: int) -> tuple[int, int] | None:
        """Where the block begins behind header lines from this one on, and the length they name, else -1; None if they are no header."""
        lengths: list[tuple[int, int]] = []
        while line not in self.known:
            stop = self._end(line)
            field = _FIELD.match(self.data, line, max(stop, line))
            if stop == line:
                self.known[line] = (line + 2, -1)
            elif stop < 0 or not field:
                self.known[line] = None
            else:
                lengths.append((line, int(field[1]) if field[1] else -1))
                line = stop + 2
        out = self.known[line]
        for at, length in reversed(lengths):
            out = out and (out[0], length if out[1] < 0 else out[1])
            self.known[at] = out
        return out

    def record(self, i: int) -> tuple[int, int] | None:
        """Where the block of a record that begins at ``i`` stands, and its length; None if no whole header does."""
        if len(self.data) < i + len(MAGIC):
            self.f.seek(self.at + len(self.data))
            self.data += self.f.read(MORE)
        found = self.behind(i + len(MAGIC)) if self.data.startswith(MAGIC, i) else None
        return found if found and found[1] >= 0 else None


def candidates(f, start: int, stop: int) -> dict[int, int]:
    """Offsets of magic in a range of a file, each with the offset of its successor; -1 without a header."""
    lines = Headers(f, start, stop - start + len(MAGIC) - 1)
    out, at = {}, lines.data.rfind(MAGIC)
    while at >= 0:
        found = lines.record(at)
        out[start + at] = start + sum(found) + len(END) if found else -1
        at = lines.data.rfind(MAGIC, 0, at + len(MAGIC) - 1)
    return {at: out[at] for at in sorted(out) if at < stop}


def read_archives(files: DataFrame, folder: str, payloads: bool = True, range_bytes: int = RANGE) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of each record on the chains.

    Length and digest of a response are measured; those of a revisit, which has no payload, are the record's. Raises
    ValueError where the chain of a file doesn't end at its last byte, and fails on a record that isn't whole.
    """
    spark = files.sparkSession
    ranges = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(bytes - 1) div {range_bytes}"))).alias("range"))
    n = max(1, ranges.count())
    shuffle = min(n, 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)) if n < 10_000 else n // 16

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _folder(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{path}/{r['file']}") as f:
                    start = r["range"] * range_bytes
                    chain = candidates(f, start, start + range_bytes)
                last: dict[int, int] = {}
                for at in sorted(chain, reverse=True):
                    last[at] = last.get(chain[at], chain[at])
                yield pa.RecordBatch.from_pydict({"file": pa.array([r["file"]] * len(last), pa.string()), "at": pa.array(list(last), pa.int64()), "next": pa.array(list(last.values()), pa.int64())})

    nodes = stage(ranges.repartition(shuffle, "file", "range").mapInArrow(scan, "file string, at long, next long"), f"{folder}/candidates")
    entries = nodes.select("file", F.col("next").alias("at")).distinct().union(files.select("file", F.lit(0).cast("long").alias("at"))).distinct()
    steps = jumps = stage(nodes.join(entries, ["file", "at"], "left_semi"), f"{folder}/jumps-0")
    real = jumps.select("file", "at")
    reached = stage(jumps.where("at = 0").select("file", "at"), f"{folder}/reached-0")
    drop(spark, f"{folder}/candidates")
    count, k = reached.count(), 0
    while count:
        k += 1
        further = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at")).join(real, ["file", "at"], "left_semi")
        new = stage(reached.union(further).distinct(), f"{folder}/reached-{k}")
        if (now := new.count()) == count:
            reached = new
            break
        ahead = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        jumps, reached, count = stage(jumps.join(ahead, ["file", "next"]).select("file", "at", F.col("after").alias("next")), f"{folder}/jumps-{k}"), new, now
    ends = reached.join(steps, ["file", "at"]).select("file", F.col("next").alias("bytes"))
    broken = files.where("bytes > 0").join(ends, ["file", "bytes"], "left_anti").limit(5).collect()
    if broken:
        raise ValueError("the records' chain doesn't end where the file does: " + ", ".join(r.file for r in broken))

    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _folder(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{path}/{r['file']}") as f:
                    rows, size = [], 0
                    for row in _records(f, r["at"], (r["at"] // range_bytes + 1) * range_bytes):
                        size += len(row["payload"] or b"")
                        rows.append(row if payloads else row | {"payload": None})
                        if size > range_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema=kind)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return reached.repartition(shuffle, "file", "at").mapInArrow(read, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def _records(f, at: int, stop: int) -> Iterator[dict]:
    """The records from a verified place on that begin before ``stop`` and the file's end."""
    size = f.size()
    while at < min(stop, size):
        lines = Headers(f, at)
        if not (found := lines.record(0)):
            raise ValueError(f"no record header at {at}")
        begin, length = at + found[0], found[1]
        fields = {k.lower(): v for k, v in _HEADER.findall(lines.data[len(MAGIC) : found[0] - len(END)])}
        f.seek(begin)
        block = f.read(length + len(END))
        if len(block) < length + len(END) or block[length:] != END:
            raise ValueError(f"record at {at} isn't whole")
        block = block[:length]
        http = block.find(END) + len(END)
        revisit = fields.get(b"warc-type") == b"revisit"
        payload = None if revisit else block[http:]
        if revisit:
            sizes = [v for k, v in _HEADER.findall(block[:http]) if k.lower() == b"content-length"]
            size_, digest = int(sizes[0]), base64.b32decode(fields[b"warc-payload-digest"].partition(b":")[2]).hex()
        else:
            size_, digest = len(payload), hashlib.sha1(payload).hexdigest()
        url = fields.get(b"warc-target-uri")
        yield {"page_id": _page(fields.get(b"warc-record-id")), "url": url and url.decode(), "record_type": fields[b"warc-type"].decode(), "payload_bytes": size_, "payload_digest": digest, "refers_to": _page(fields.get(b"warc-refers-to")), "payload": payload}
        at = begin + length + len(END)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "warc")
    files = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(files, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM d
"""
