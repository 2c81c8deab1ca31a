"""SimHash near-dedup of similar texts: covering masks propose pairs, an exact similarity of word shingles decides.

Texts with equal sets of shingles are one. Each set has a SimHash fingerprint of WORDS 64-bit words, cut into pieces of
PIECE bits; the covering masks of ``simhash`` for RADIUS bits make tables over each piece. Sets that agree in a table meet
in a bucket, where pairs are screened by SCREEN words. What passes is a candidate only: a pair is linked if the
Jaccard similarity of the whole sets is at least ``SIMILAR``.

A pair within RADIUS bits in some piece, so any pair within 95 of all 1024 bits, is found for certain. Pairs at the least similarity
differ in about 155 bits, spread by chance: one in some 5000 of them meets in no table, one in 700,000 at 0.85.

Connected groups are wanted, not all their pairs. So a first round holds each set of a bucket against the first one near it, the
nearest of all buckets only, and later ones hold sets that aren't connected yet against others, nearest first, in growing numbers
until no pair is left, those that the first round left included. Those rounds screen by the whole fingerprint and by the parity of
the sets, which bounds their similarity from above and so loses no link, and a pair is asked for in the first table only in which it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .shared import HOT_SHARE, drop, join_skewed, join_small, small_batches, stage, workspace
from .simhash import SAMPLE, _differing, masks

#: Words in a shingle.
SHINGLE = 5

#: Least similarity of a link, as a fraction of integers.
SIMILAR = (4, 5)

#: 64-bit words of a fingerprint; bits of a piece, and the radius that its masks cover.
WORDS, PIECE, RADIUS = 16, 32, 2

#: Words by which pairs are screened, and bits of them that may differ: four deviations above a pair of the least similarity.
SCREEN, FAR = 2, 36

#: Bits of the whole fingerprint that may differ in later rounds: over five deviations above a pair of the least similarity.
#: Of sets below FEW shingles more bits are ties, so more may differ.
FAR_WHOLE, FEW, FAR_FEW = 220, 32, 256

#: 64-bit words of a set's parity.
PARITY = 16

#: Sets of a bucket that are held before they are reduced to those far from each other; parts of a hot bucket.
BUCKET, SALTS = 1 << 16, 256

#: Sets verified against one copy of another.
CHUNK = 64

#: Pairs of all its buckets, the nearest, that are verified of a set in the first round.
FIRST = 2

#: Pairs of a bucket by which a set asks for others in the second round; each later round has eight times as many.
NEAREST = 4

_XOR = np.random.default_rng(20).integers(0, 1 << 64, WORDS, dtype=np.uint64)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_MASKS = [m for start in range(0, 64, PIECE) for m in masks(RADIUS, list(range(start, start + PIECE)))]


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a whole text's word shingles (ASCII lower case); a text of fewer words is one shingle."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    whole = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(k, len(words))
    hash_, starts, stops = xxhash.xxh64_intdigest, (ends - lengths)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    return np.unique(np.fromiter((hash_(whole[a:b], 42) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=len(starts)))


def fingerprint(x: np.ndarray) -> np.ndarray:
    """WORDS words of a set of hashes: a bit is 1 if set in over half of the words that a hash turns to; 0 of the empty set."""
    ones = np.zeros(64 * WORDS, dtype=np.int64)
    for i in range(0, len(x), 4096):
        h = (x[i : i + 4096, None] ^ _XOR) * _ODD
        h = (h ^ h >> np.uint64(32)) * _ODD
        h ^= h >> np.uint64(29)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(x), bitorder="little").view("<u8").astype(np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether sorted sets of hashes have at least the similarity of a link."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def parity(x: np.ndarray) -> np.ndarray:
    """PARITY words of a set of hashes: a bit is 1 if an odd number of them fall on it."""
    n = 64 * PARITY
    return np.packbits(np.bincount((x % np.uint64(n)).astype(np.int64), minlength=n) & 1, bitorder="little").view("<u8").astype(np.uint64)


def may_be_similar(sizes: np.ndarray, parities: np.ndarray, size: int, one: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes and parities can have the similarity of a link with another; true of all that have it.

    Hashes that two sets share fall on the same bit of both, so parities differ in no more bits than the sets in hashes.
    """
    differing = np.bitwise_count(parities ^ one).sum(axis=1, dtype=np.int64)
    return (SIMILAR[1] - SIMILAR[0]) * (sizes + size) >= (SIMILAR[1] + SIMILAR[0]) * differing


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, dtype=np.uint64).view(np.int64), pa.int64())


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, id, size, words) of rows (doc_id, text_hash, text): id is a hash of the set of shingles, words its fingerprint."""

    @F.arrow_udf("struct<id: bigint, size: int, words: array<bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        import xxhash

        ids, sizes, words = [], [], []
        for t in texts:
            x = shingles(t.as_py())
            ids.append(xxhash.xxh64_intdigest(x.tobytes(), 7))
            sizes.append(len(x))
            words.append(fingerprint(x))
        n = len(ids)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * WORDS, pa.int32()), _signed(np.array(words).reshape(-1)))
        return pa.StructArray.from_arrays([_signed(np.array(ids, dtype=np.uint64)), pa.array(sizes, pa.int32()), lists], names=["id", "size", "words"])

    return docs.select("doc_id", "text_hash", run.asNondeterministic()(F.col("text")).alias("s")).select("doc_id", "text_hash", "s.*")


def _buckets(sets: DataFrame) -> DataFrame:
    """Sets (words, ...) once for each table t, with the key of their bucket there."""
    each = sets.select("*", F.posexplode(F.array(*[F.lit(m).cast("long") for m in _MASKS * WORDS])).alias("t", "mask"))
    piece = F.element_at("words", F.expr(f"t div {len(_MASKS)} + 1").cast("int")).bitwiseAND(F.col("mask"))
    return each.withColumn("key", F.xxhash64("t", piece))


def _members(sets: DataFrame) -> DataFrame:
    """Rows (key, id, size, w0, w1) of the buckets of sets (id, size, words): one for each table."""
    return _buckets(sets).select("key", "id", "size", *[F.col("words")[i].alias(f"w{i}") for i in range(SCREEN)])


def first_table(differing: np.ndarray) -> np.ndarray:
    """The first table in which pairs meet, of rows of WORDS words with the bits by which they differ; all of them meet in some."""
    t, masks_ = np.arange(len(_MASKS) * WORDS), np.array(_MASKS, dtype=np.int64).view(np.uint64)
    return (differing[:, t // len(_MASKS)] & masks_[t % len(_MASKS)] == 0).argmax(axis=1)


_ROW = ["key", "id", "size", *[f"w{i}" for i in range(SCREEN)]]


class _Rows:
    """Members of buckets as arrays, in the order of their keys."""

    def __init__(self, columns: list[np.ndarray]):
        self.columns = columns
        self.key, self.id, self.size = columns[:3]

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        return cls([batch.column(c).to_numpy().astype(np.int64) for c in _ROW])

    @classmethod
    def whole(cls, batch: pa.RecordBatch) -> _Rows:
        """Rows of ``_later``: beside key, id and size their table, their label, all their words and their parity."""
        narrow = [batch.column(c).to_numpy().astype(np.int64) for c in ("key", "id", "size", "t", "label")]
        wide = [batch.column(c).flatten().to_numpy().view(np.uint64).reshape(-1, n) for c, n in (("words", WORDS), ("parity", PARITY))]
        return cls([*narrow, *wide])

    def part(self, at) -> _Rows:
        return _Rows([c[at] for c in self.columns])

    def then(self, other: _Rows) -> _Rows:
        return _Rows([np.concatenate(c) for c in zip(self.columns, other.columns, strict=True)])

    def fits(self, a, b) -> np.ndarray:
        """Whether sizes allow the similarity."""
        return SIMILAR[1] * np.minimum(self.size[a], self.size[b]) >= SIMILAR[0] * np.maximum(self.size[a], self.size[b])

    def far(self, a, b) -> np.ndarray:
        """Bits by which rows differ; more than all where sizes rule the similarity out."""
        bits = sum(_differing(w[a], w[b]).astype(np.int64) for w in self.columns[3 : 3 + SCREEN])
        return np.where(self.fits(a, b), bits, 64 * SCREEN + 1)


def first_near(rows: _Rows) -> tuple[list[np.ndarray], np.ndarray]:
    """Pairs (a, b, far) of ids that link each row to the first one of its bucket near it, and the places of rows that have none."""
    rest, leaders, pairs = np.arange(len(rows.key)), [], [np.zeros((3, 0), dtype=np.int64)]
    while len(rest):
        key = rows.key[rest]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        first = np.repeat(rest[start], np.diff(np.append(start, len(rest))))
        far = rows.far(first, rest)
        hit = far <= FAR
        leaders.append(rest[start])
        found = hit & (first != rest)
        pairs.append(np.stack([rows.id[first[found]], rows.id[rest[found]], far[found]]))
        rest = rest[~hit & (first != rest)]
    return pairs, np.sort(np.concatenate(leaders)) if leaders else rest


def _linked_first(rows: DataFrame, by: list[str], leave: bool) -> DataFrame:
    """Pairs (id, other, far) of ``first_near`` from buckets dealt by these columns, and with ``leave`` the rows without any (other, far null)."""
    kind = pa.schema([(c, pa.int64()) for c in (*_ROW, "other", "far")])

    def out(pairs: list[np.ndarray], left: _Rows | None) -> pa.RecordBatch:
        a, *ends = np.concatenate(pairs, axis=1)
        n = 0 if left is None else len(left.key)
        found = [np.zeros(len(a), dtype=np.int64), a, *[np.zeros(len(a), dtype=np.int64)] * (len(_ROW) - 2)]
        columns = [np.concatenate([f, left.columns[i]]) if n else f for i, f in enumerate(found)]
        ends = [pa.array(np.concatenate([e, np.zeros(n, dtype=np.int64)]), mask=np.arange(len(a) + n) >= len(a)) for e in ends]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), *ends], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Rows | None = None
        for batch in batches:
            if not len(batch):
                continue
            x = _Rows.of(batch)
            x = x if held is None else held.then(x)
            last = int(np.searchsorted(x.key, x.key[-1]))  # that bucket may go on
            if last:
                pairs, left = first_near(x.part(slice(0, last)))
                yield out(pairs, x.part(left) if leave else None)
            held = x.part(slice(last, None))
            if len(held.key) > BUCKET:
                pairs, left = first_near(held)
                yield out(pairs, None)
                held = held.part(left)
        if held is not None:
            pairs, left = first_near(held)
            yield out(pairs, held.part(left) if leave else None)

    schema = ", ".join(f"{c} long" for c in (*_ROW, "other", "far"))
    parts = rows.select(*_ROW, *[c for c in by if c not in _ROW]).repartition(*by).sortWithinPartitions("key", *by, "id")
    return parts.select(*_ROW).mapInArrow(run, schema)


def _first(sets: DataFrame, total: int) -> DataFrame:
    """Pairs (a, b, far) that link each set b to the first near one of a bucket: at most one for each table.

    Keys that a sample shows to be hot are reduced part by part before they meet. The sample only chooses that way; at most
    SAMPLE * HOT_SHARE keys can be above the bound, as each takes one in so many of all rows.
    """
    tables = len(_MASKS) * WORDS
    most = max(BUCKET, total * tables // HOT_SHARE)
    seen = _members(sets.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(SAMPLE)) == 0)).groupBy("key").count()
    hot = [r.key for r in seen.where(F.col("count") > most // SAMPLE).select("key").collect()]
    hot = sets.sparkSession.createDataFrame([(k,) for k in hot], "key long").withColumn("hot", F.lit(True))
    rows = _members(sets).join(F.broadcast(hot), "key", "left")
    salted = rows.where("hot").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    parts = _linked_first(salted, ["key", "salt"], leave=True)
    found = _linked_first(rows.where("hot is null").select(*_ROW).union(parts.where("other is null").select(*_ROW)), ["key"], leave=False)
    return found.select("id", "other", "far").union(parts.where("other is not null").select("id", "other", "far")).toDF("a", "b", "far").distinct()


def _later(rows: DataFrame, most: int) -> DataFrame:
    """(a, b, key, more) of pairs of different labels in buckets of rows (key, t, id, size, label, words, parity), at most so many for each set.

    A pair comes from one bucket only, the first one in which it meets; more marks the buckets in which pairs were left,
    which also give a row with equal ends, as their nearest pairs may all belong to other buckets.
    Sets of a bucket's commonest label needn't ask, as the others ask for them.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("more", pa.bool_())])

    def asked(x: _Rows) -> tuple[np.ndarray, int, bool]:
        table, label, words, parities = x.columns[3:]
        kinds, inverse, counts = np.unique(label, return_inverse=True, return_counts=True)
        out, more = [np.zeros((2, 0), dtype=np.int64)], False
        for a in np.flatnonzero(inverse != counts.argmax()) if len(kinds) > 1 else ():
            hit = np.flatnonzero((label != label[a]) & x.fits(a, slice(None)))
            far = np.bitwise_count(words[hit] ^ words[a]).sum(axis=1, dtype=np.int64)
            near = far <= np.where(np.minimum(x.size[hit], x.size[a]) < FEW, FAR_FEW, FAR_WHOLE)
            hit, far = hit[near], far[near]
            near = may_be_similar(x.size[hit], parities[hit], x.size[a], parities[a])
            hit, far = hit[near], far[near]
            if len(hit) > most:
                more, hit = True, hit[np.argsort(far, kind="stable")[:most]]
            hit = hit[first_table(words[hit] ^ words[a]) == table[a]]
            own = np.full(len(hit), x.id[a])
            out.append(np.stack([np.minimum(own, x.id[hit]), np.maximum(own, x.id[hit])]))
        if more:
            out.append(np.full((2, 1), x.id[0]))
        return np.unique(np.concatenate(out, axis=1), axis=1), x.key[0], more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Rows | None = None

        def solved(x: _Rows) -> pa.RecordBatch:
            cut = np.flatnonzero(np.diff(x.key)) + 1
            parts = [asked(x.part(slice(s, e))) for s, e in zip([0, *cut], [*cut, len(x.key)], strict=True)]
            a, b = np.concatenate([p for p, _, _ in parts], axis=1)
            key, more = (np.concatenate([np.full(p[0].shape[1], p[i]) for p in parts]) for i in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(key), pa.array(more, pa.bool_())], schema=schema)

        for batch in batches:
            if not len(batch):
                continue
            x = _Rows.whole(batch)
            x = x if held is None else held.then(x)
            last = int(np.searchsorted(x.key, x.key[-1]))
            if last:
                yield solved(x.part(slice(0, last)))
            held = x.part(slice(last, None))
        if held is not None:
            yield solved(held)

    rows = rows.select("key", "t", "id", "size", "label", "words", "parity")
    return rows.repartition("key").sortWithinPartitions("key", "id").mapInArrow(run, "a long, b long, key long, more boolean")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of those pairs whose sets (id, set) are similar; a set with many pairs is sent in copies, one for each CHUNK."""
    held = pairs.groupBy("a").agg(F.count("*").alias("n"))
    parts = pairs.join(held, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / CHUNK)))
    ends = F.array(F.struct(F.lit(0).alias("o"), F.col("a").alias("id")), F.struct(F.lit(1).alias("o"), F.col("b").alias("id")))
    rows = parts.select("a", "part", F.inline(ends)).distinct().join(sets.select("id", "set"), "id").select("a", "part", "o", "id", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            a, o, ids, lists = batch.column("a").to_pylist(), batch.column("o").to_pylist(), batch.column("id").to_pylist(), batch.column("set")
            offsets, values, out = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64), []
            for i in range(len(a)):
                x = values[offsets[i] : offsets[i + 1]]
                if o[i] == 0:
                    one = x.copy()
                elif similar(one, x):
                    out.append((a[i], ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "o").mapInArrow(run, "a long, b long")


def _sets(rows: DataFrame) -> DataFrame:
    """(id, size, words, parity, set) of rows (id, size, words, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 500) for b in batches for i in range(0, len(b), 500)):
            all_ = [shingles(t.as_py()) for t in batch.column("text")]
            lists = []
            for values in ([parity(x) for x in all_], all_):
                ends = np.cumsum([0, *map(len, values)])
                lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(np.concatenate([np.zeros(0, dtype=np.uint64), *values]))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "size", "words")], *lists], names=["id", "size", "words", "parity", "set"])

    return rows.select("id", "size", "words", "text").mapInArrow(run, "id long, size int, words array<long>, parity array<long>, set array<long>")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _merged(labels: DataFrame, links: DataFrame, folder: str) -> DataFrame | None:
    """(id, label) after links (a, b) have joined the labels of their ends; None if that changes none.

    Components are those of the labels, so each round works on what the last one left apart.
    """
    ends = links.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b").where("x <> y")
    ends = stage(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{folder}-ends")
    if ends.limit(1).count() == 0:
        return None
    new = stage(components(ends, f"{folder}-components").toDF("label", "new"), f"{folder}-new")
    drop(links.sparkSession, f"{folder}-components")
    out = join_small(labels, new, ["label"], salt=F.xxhash64("id"))
    return stage(out.select("id", F.coalesce("new", "label").alias("label")), folder)


def near_groups(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, text_hash, label) for each row of ``docs`` (doc_id, text); rows that links connect have one label.

    Null, empty and blank texts have no shingles and are alike. Repeated rows come back repeated.
    """
    small_batches(docs.sparkSession)
    each = stage(sketches(_rows(docs)), f"{folder}/each")
    total = each.count()
    named = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.coalesce("text_hash", F.lit(0)).alias("text_hash"))
    distinct = each.groupBy("id").agg(F.min(named).alias("named"), F.first("size").alias("size"), F.first("words").alias("words"), F.count("*").alias("rows"))
    distinct = stage(distinct, f"{folder}/distinct")
    met = stage(_first(distinct, distinct.count()), f"{folder}/met")
    # only sets that are near another one in some bucket may be asked for later
    some = stage(distinct.join(met.select("a").union(met.select("b")).toDF("id").distinct(), "id", "left_semi"), f"{folder}/some")
    texts = _rows(docs).withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn("text_hash", F.coalesce("text_hash", F.lit(0)))
    known = some.select("id", "size", "words", "named._id", "named.text_hash")
    sets = stage(_sets(texts.join(known, ["_id", "text_hash"]).dropDuplicates(["id"])), f"{folder}/sets")
    nearest = Window.partitionBy("b").orderBy("far", "a")  # a set is in one row for each table at most
    found = stage(met.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= FIRST).select("a", "b"), f"{folder}/pairs-1")
    labels = some.select("id", F.col("id").alias("label"))
    n, most, done, more, keys = 1, NEAREST, None, True, None
    while True:
        linked = stage(_verified(found, sets), f"{folder}/linked-{n}")
        merged = _merged(labels, linked, f"{folder}/merged-{n}")
        unordered = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        done = unordered if done is None else done.union(unordered)
        if merged is None and not more:
            break
        labels = labels if merged is None else merged
        now = sets.select("id", "size", "words", "parity").join(labels, "id")
        open_ = _buckets(now.select("id", "words", "label")).select("key", "t", "id", "label")
        if keys is None:
            keys = open_.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
        asked = stage(_later(open_.drop("label").join(keys, "key").join(now, "id"), most), f"{folder}/asked-{n}")
        keys = asked.where("more").select("key").distinct()  # nothing was left in the others
        n, most = n + 1, 8 * most
        found = stage(asked.where("a <> b").select("a", "b").distinct().join(done, ["a", "b"], "left_anti"), f"{folder}/pairs-{n}")
        more = asked.where("more").limit(1).count() > 0
        if found.limit(1).count() == 0 and not more:
            break
    names = distinct.join(labels, "id", "left")
    names = stage(names.select(F.col("id").cast("string").alias("key"), F.coalesce("label", "id").alias("label"), "rows"), f"{folder}/names")
    out = join_skewed(each.select("doc_id", "text_hash", F.col("id").cast("string").alias("key"), "id"), names, "key", "rows", total, F.monotonically_increasing_id())
    out = stage(out.select("doc_id", "text_hash", "label"), f"{folder}/groups")
    for part in ("each", "distinct", "met", "some", "sets", "names", *(f"{p}-{i}" for p in ("pairs", "linked", "asked", "merged") for i in range(1, n + 1))):
        drop(docs.sparkSession, f"{folder}/{part}")
    return out


def one_of_near(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, but one for each group of near copies.

    The row with the group's smallest doc_id stays; among rows of that id, one with the smallest hash of its text. Where
    a group has no doc_id at all, one text stays. Rows that repeat id and text come down to one.
    """
    folder = workspace(docs.sparkSession, "near")
    groups = near_groups(docs.select("doc_id", "text"), folder)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.coalesce("text_hash", F.lit(0)).alias("hash")))
    keep = groups.groupBy("label").agg(least.alias("k"))
    keep = stage(keep.select(F.coalesce(F.col("k.doc_id").cast("string"), F.lit("")).alias("_id"), F.col("k.hash").alias("_hash")), f"{folder}/keep")
    id_, hash_ = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64(F.col("text").cast("string"))
    rows = docs.select(F.struct("*").alias("_row"), id_.alias("_id"), hash_.alias("_hash")).join(keep, ["_id", "_hash"], "left_semi")
    first = Window.partitionBy("_id", "_hash").orderBy("_id")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("_row.*")
