"""Quality rules: base rules, then robust multivariate outliers by minimum covariance determinant.

Each document's statistics are transformed to a vector. For every language and source, concentration
steps over all of its documents look for the covariance of least determinant among (n + p + 1) / 2 of them, on which
the breakdown point of nearly a half rests: the nearest so many by the present estimate make the next one, until the
determinant falls no more. They go from STARTS starts; the BEST after two steps go on to their end, and the least determinant
counts. A document is rejected when its Mahalanobis distance exceeds the cutoff.

The search asks for order statistics and moments only. A group of up to GROUP_ROWS documents answers them in one task; a
larger one by jobs over its vectors, which send back counts and sums. Sums are of integers and distances are
taken in one order, so both ways, and reruns, give the same estimate. Distances that agree to 2^-20 are ties.

Groups with fewer than MIN_ROWS documents are pooled by language, and if that isn't enough, altogether;
if that isn't enough either, nothing but the base rules rejects.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, drop, join_small, small_batches, stage, text_key, workspace

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: Share of a group's documents that the estimate concentrates on; the number is (n + DIM + 1) / 2.
SHARE = 0.5

#: Starts of the concentration: the medians, and single documents with the median deviations as scales; and how many go on to the end.
STARTS, BEST = 7, 2

#: Documents of a group that one task takes, some 5 MB for each 100,000; larger groups answered by the same jobs.
GROUP_ROWS, WAVE = 1 << 20, 16

#: Fewest documents that an estimate is made of.
MIN_ROWS = 100

#: Squared distances above this probability of the chi-square distribution are rejected.
CONFIDENCE = 0.999

#: Vectors are kept as integers in steps of 1 / UNIT.
UNIT = 4096

#: Least standard deviation of each component: those of a group whose documents hardly differ are raised to it.
FLOORS = {"log words": 0.25, "log word length": 0.08, "symbols": 0.5, "repeated lines": 0.15, "repeated words": 0.12}
DIM = len(FLOORS)
PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """STATS of a whole text; words are runs of bytes other than ASCII white space, lines end at newlines."""
    return byte_stats((text or "").encode("utf-8", "surrogatepass"))


def byte_stats(raw: bytes) -> tuple[int, int, int, int, int, int]:
    words = raw.split()
    if not words:
        return (0, 0, int(sum(raw.count(c) for c in b"#*$%&|<>")), 0, 0, 0)
    bytes_ = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = len(raw) - bytes_[0x80:0xC0].sum() - bytes_[0x20] - bytes_[0x09:0x0E].sum()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), int(chars), int(bytes_[list(b"#*$%&|<>")].sum()), len(lines) - len(set(lines)), _repeated(words), len(lines))


def _repeated(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    code, v = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words)), len(index)
    pair = code[:-2] * v + code[1:-1]
    if v >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair * v + code[2:]
    ordered = np.sort(window)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(window, again))
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def stats_of(text: Column) -> Column:
    """Struct of the STATS of a string column. Only the texts go to Python, and only numbers come back."""

    @F.arrow_udf("struct<" + ", ".join(f"{s}: bigint" for s in STATS) + ">")
    def run(texts: pa.Array) -> pa.Array:
        rows = np.array([byte_stats(t.as_py() or b"") for t in texts], dtype=np.int64).reshape(-1, len(STATS))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(STATS))], names=STATS)

    return run.asNondeterministic()(text.cast("string").cast("binary"))  # so that a filter on it doesn't compute it again


def base_failed() -> Column:
    s = F.col("_stats")
    return (s.n_words < 50) | (100 * s.n_repeat_words > 50 * s.n_words)


def vector() -> list[Column]:
    """The transformed statistics in steps of 1 / UNIT."""
    s = F.col("_stats")
    words, lines = F.greatest(s.n_words, F.lit(1)), F.greatest(s.n_lines, F.lit(1))
    parts = [F.log(words), F.log((s.word_chars + 1) / words), F.log1p(100 * s.n_symbols / words), F.sqrt(s.n_dup_lines / lines), F.sqrt(s.n_repeat_words / words)]
    return [F.round(x * UNIT).cast("long").alias(f"x{i}") for i, x in enumerate(parts)]


def chi2_cdf(x: float, k: int) -> float:
    """Of the chi-square distribution: series of the lower incomplete gamma function."""
    a, z = k / 2, x / 2
    if z <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def _consistency(share: float) -> float:
    """Factor that makes the covariance of the central ``share`` of normal data that of all."""
    return share / chi2_cdf(chi2_quantile(share, DIM), DIM + 2)


def covariance(n: int, sums: list[int], products: list[int], share: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance, floors included, from integer moments."""
    mean = np.array([s / n for s in sums]) / UNIT
    cov = np.zeros((DIM, DIM))
    for (i, j), p in zip(PAIRS, products, strict=True):
        cov[i, j] = cov[j, i] = (p * n - sums[i] * sums[j]) / (n * n) / UNIT**2
    return mean, cov * _consistency(share) + np.diag(np.square(list(FLOORS.values())))


def estimate(n: int, sums: list[int], products: list[int], share: float) -> tuple[list[float], list[float]]:
    """Mean and inverse covariance (row by row) from integer moments."""
    mean, cov = covariance(n, sums, products, share)
    return mean.tolist(), np.linalg.inv(cov).ravel().tolist()


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. from mean and inverse."""
    d = [F.col(f"x{i}") / UNIT - F.col("mean")[i] for i in range(DIM)]
    return sum((d[i] * d[j] * F.col("inverse")[i * DIM + j] * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))


def distances(x: np.ndarray, mean: list[float], inverse: list[float]) -> np.ndarray:
    """Squared Mahalanobis distances of integer vectors, summed in one order wherever they are taken."""
    d = [x[:, i] / UNIT - mean[i] for i in range(DIM)]
    out = np.zeros(len(x))
    for i, j in PAIRS:
        out += d[i] * d[j] * (inverse[i * DIM + j] * (1 if i == j else 2))
    return np.maximum(out, 0.0)


def keys(x: np.ndarray, of: tuple) -> np.ndarray:
    """32-bit numbers in the order of a quantity: ("value", i), ("deviation", i, from) or ("distance", mean, inverse)."""
    if of[0] == "value":
        return x[:, of[1]] + (1 << 31)
    if of[0] == "deviation":
        return np.abs(x[:, of[1]] - of[2])
    return distances(x, *of[1:]).view(np.int64) >> 32


def moments(x: np.ndarray) -> tuple[int, list[int], list[int]]:
    return len(x), x.sum(axis=0).tolist(), [int((x[:, i] * x[:, j]).sum()) for i, j in PAIRS]


def least(x: np.ndarray, seed: int) -> tuple[int, ...]:
    """Hash and components of the vector of least hash."""
    h = np.full(len(x), seed * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for i in range(DIM):
        h = (h ^ x[:, i].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    h >>= np.uint64(1)
    at = min(np.flatnonzero(h == h.min()).tolist(), key=lambda k: tuple(x[k]))
    return int(h[at]), *x[at].tolist()


Question = tuple[str, list]


def search(n: int) -> Generator[Question, list, tuple[list[float], list[float]]]:
    """Mean and inverse covariance of a group of n documents, by questions about all of its vectors.

    ("kth", [(of, rank)]) asks for the key of that rank, ("least", [seed]) for the vector of least hash, and
    ("moments", [(mean, inverse, limit)]) for count, sums and products of what has a distance up to that key.
    """
    half = (n + DIM + 1) // 2
    middles = yield "kth", [(("value", i), (n - 1) // 2) for i in range(DIM)]
    middles = [m - (1 << 31) for m in middles]
    spreads = yield "kth", [(("deviation", i, middles[i]), (n - 1) // 2) for i in range(DIM)]
    scales = [1 / ((1.4826 * s / UNIT) ** 2 + f * f) for s, f in zip(spreads, FLOORS.values(), strict=True)]
    inverse = np.diag(scales).ravel().tolist()
    picked = yield "least", list(range(1, STARTS))
    means = [middles, *[p[1:] for p in picked]]
    live = [(math.inf, k, [v / UNIT for v in m], inverse) for k, m in enumerate(means)]
    ended, turn = [], 0
    while live:
        turn += 1
        limits = yield "kth", [(("distance", m, inv), half - 1) for _, _, m, inv in live]
        found = yield "moments", [(m, inv, limit) for (_, _, m, inv), limit in zip(live, limits, strict=True)]
        ahead = []
        for old, f in zip(live, found, strict=True):
            mean, cov = covariance(*f, SHARE)
            volume = float(np.linalg.slogdet(cov)[1])
            if volume < old[0]:
                ahead.append((volume, old[1], mean.tolist(), np.linalg.inv(cov).ravel().tolist()))
            else:
                ended.append(old)
        live = sorted(ahead)[:BEST] if turn == 2 else ahead
    _, _, mean, inverse = min(ended)
    limit = int(np.float64(chi2_quantile(0.975, DIM)).view(np.int64) >> 32)
    last = yield "moments", [(mean, inverse, limit)]
    return estimate(*last[0], 0.975)


def answered(x: np.ndarray) -> tuple[list[float], list[float]]:
    """What ``search`` finds for vectors that are all here."""

    def answer(kind: str, items: list) -> list:
        if kind == "kth":
            return [int(np.partition(keys(x, of), rank)[rank]) for of, rank in items]
        if kind == "least":
            return [least(x, seed) for seed in items]
        return [moments(x[keys(x, ("distance", mean, inverse)) <= limit]) for mean, inverse, limit in items]

    run = search(len(x))
    question = next(run)
    while True:
        try:
            question = run.send(answer(*question))
        except StopIteration as end:
            return end.value


def _vectors(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.stack([batch.column(f"x{i}").to_numpy() for i in range(DIM)], axis=1)


def _by_fit(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    fit, x = batch.column("fit").dictionary_encode(), _vectors(batch)
    code = fit.indices.to_numpy()
    for k, name in enumerate(fit.dictionary.to_pylist()):
        yield name, x[code == k]


def _kth(rows: DataFrame, asked: dict[str, list]) -> dict[str, list]:
    """Keys by rank, 16 bits at a time: at most 65536 counts for each question come to the driver."""
    high: dict[tuple[str, int], int] = {}
    rank = {(fit, k): r for fit, items in asked.items() for k, (_, r) in enumerate(items)}
    for low in (False, True):

        def count(batches: Iterator[pa.RecordBatch], low: bool = low) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[str, int], np.ndarray] = {}
            for batch in batches:
                for fit, x in _by_fit(batch):
                    for k, (of, _) in enumerate(asked.get(fit, [])):
                        v = keys(x, of)
                        v = v[v >> 16 == high[fit, k]] & 65535 if low else v >> 16
                        held[fit, k] = held.get((fit, k), 0) + np.bincount(v, minlength=1 << 16)
            for (fit, k), n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([fit] * len(at), pa.string()), pa.array(np.full(len(at), k)), pa.array(at), pa.array(n[at])], names=["fit", "k", "at", "n"])

        found = rows.mapInArrow(count, "fit string, k long, at long, n long").groupBy("fit", "k", "at").agg(F.sum("n").alias("n")).collect()
        by: dict[tuple[str, int], list] = {}
        for r in found:
            by.setdefault((r.fit, r.k), []).append((r.at, r.n))
        for name, counts in by.items():
            for at, n in sorted(counts):
                if rank[name] < n:
                    high[name] = high.get(name, 0) << 16 | at
                    break
                rank[name] -= n
    return {fit: [high[fit, k] for k in range(len(items))] for fit, items in asked.items()}


def _least(rows: DataFrame, asked: dict[str, list]) -> dict[str, list]:
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple] = {}
        for batch in batches:
            for fit, x in _by_fit(batch):
                for k, seed in enumerate(asked.get(fit, [])):
                    one = least(x, seed)
                    held[fit, k] = min(held.get((fit, k), one), one)
        out = [{"fit": fit, "k": k, "p": list(p)} for (fit, k), p in held.items()]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("fit", pa.string()), ("k", pa.int64()), ("p", pa.list_(pa.int64()))]))

    found = rows.mapInArrow(pick, "fit string, k long, p array<long>").groupBy("fit", "k").agg(F.min("p").alias("p")).collect()
    by = {(r.fit, r.k): tuple(r.p) for r in found}
    return {fit: [by[fit, k] for k in range(len(items))] for fit, items in asked.items()}


def _moments(rows: DataFrame, asked: dict[str, list]) -> dict[str, list]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fit", pa.string()), ("k", pa.int64()), ("i", pa.int64()), ("v", pa.int64())])
        for batch in batches:
            out = []
            for fit, x in _by_fit(batch):
                for k, (mean, inverse, limit) in enumerate(asked.get(fit, [])):
                    n, sums, products = moments(x[keys(x, ("distance", mean, inverse)) <= limit])
                    out += [{"fit": fit, "k": k, "i": i, "v": v} for i, v in enumerate([n, *sums, *products])]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    found = rows.mapInArrow(add, "fit string, k long, i long, v long").groupBy("fit", "k", "i").agg(F.sum(F.col("v").cast("decimal(19,0)")).alias("v")).collect()
    by = {(r.fit, r.k, r.i): int(r.v) for r in found}
    every = [[by.get((fit, k, i), 0) for i in range(1 + DIM + len(PAIRS))] for fit, items in asked.items() for k in range(len(items))]
    parts = iter([(v[0], v[1 : 1 + DIM], v[1 + DIM :]) for v in every])
    return {fit: [next(parts) for _ in items] for fit, items in asked.items()}


def _asked_of_all(rows: DataFrame, sizes: dict[str, int]) -> list[tuple[str, list[float], list[float]]]:
    """Estimates of large groups, whose questions of a kind go together."""
    runs = {fit: search(n) for fit, n in sizes.items()}
    questions = {fit: next(run) for fit, run in runs.items()}
    out = []
    while questions:
        answers: dict[str, list] = {}
        for kind, way in (("kth", _kth), ("least", _least), ("moments", _moments)):
            asked = {fit: items for fit, (of, items) in questions.items() if of == kind}
            answers |= way(rows, asked) if asked else {}
        questions = {}
        for fit, answer in answers.items():
            try:
                questions[fit] = runs[fit].send(answer)
            except StopIteration as end:
                out.append((fit, *end.value))
    return out


_FITS = "fit string, mean array<double>, inverse array<double>"


def _one_group(table: pa.Table) -> pa.Table:
    mean, inverse = answered(_vectors(table))
    of = pa.list_(pa.float64())
    return pa.table({"fit": table.column("fit")[:1], "mean": pa.array([mean], of), "inverse": pa.array([inverse], of)})


def fit(stats: DataFrame, folder: str) -> DataFrame:
    """(lang_key, source_key, mean, inverse) from all rows (lang_key, source_key, _stats) that pass the base rules."""
    spark = stats.sparkSession
    rows = stats.where(~base_failed()).select("lang_key", "source_key", *vector())
    sizes = stage(rows.groupBy("lang_key", "source_key").agg(F.count("*").alias("n")), f"{folder}/sizes")
    pooled = sizes.where(F.col("n") < MIN_ROWS).groupBy("lang_key").agg(F.sum("n").alias("pool"))
    name = F.when(F.col("n") >= MIN_ROWS, F.concat(F.lit("source\u0000"), "lang_key", F.lit("\u0000"), "source_key"))
    name = name.when(F.col("pool") >= MIN_ROWS, F.concat(F.lit("lang\u0000"), "lang_key")).otherwise(F.lit("all"))
    named = sizes.join(pooled, "lang_key", "left").select("lang_key", "source_key", "n", name.alias("fit"))
    enough = named.groupBy("fit").agg(F.sum("n").alias("size")).where(F.col("size") >= MIN_ROWS)
    groups = stage(named.drop("n").join(enough, "fit"), f"{folder}/groups")
    rows = join_small(rows, groups, ["lang_key", "source_key"], "inner").select("fit", "size", *[f"x{i}" for i in range(DIM)])
    large = {r.fit: r.size for r in groups.where(F.col("size") > GROUP_ROWS).select("fit", "size").distinct().collect()}  # of all rows, less than one in GROUP_ROWS
    if large:
        rows = stage(rows, f"{folder}/vectors")
    fits = stage(rows.where(F.col("size") <= GROUP_ROWS).drop("size").groupBy("fit").applyInArrow(_one_group, _FITS), f"{folder}/fits")
    for part in batched(sorted(large), WAVE):
        some = rows.where(F.col("fit").isin(*part))
        fits = fits.union(spark.createDataFrame(_asked_of_all(some, {k: large[k] for k in part}), _FITS))
    out = stage(groups.drop("size").join(fits, "fit").drop("fit"), f"{folder}/estimates")
    for part in ("sizes", "groups", "vectors", "fits"):
        drop(spark, f"{folder}/{part}")
    return out


def judged(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Rows (lang_key, source_key, _stats, ...) with base_failed, distance (null without estimate) and kept."""
    own = rows.columns
    out = join_small(rows.select("*", *vector()), fits, ["lang_key", "source_key"]).withColumn("distance", distance())
    out = out.withColumn("base_failed", base_failed())
    outlier = F.coalesce(F.col("distance") > chi2_quantile(CONFIDENCE, DIM), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~outlier).select(*own, "base_failed", "distance", "kept")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"lang_key": text_key("lang"), "source_key": text_key("source")})


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, distance and kept for each row of ``docs`` (doc_id, text, lang, source).

    Null, empty and blank texts have no words and fail the base rules. Null languages or sources are groups of
    their own. Repeated rows are judged, and counted, each. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    folder = workspace(docs.sparkSession, "quality")
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")]
    stats = docs.select(*columns, stats_of(F.col("text")).alias("_stats"))
    stats = stage(_keyed(stats).drop("lang", "source"), f"{folder}/stats")
    return judged(stats, fit(stats, folder)).select("doc_id", *[f"_stats.{s}" for s in STATS], "base_failed", "distance", "kept")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns.

    Estimates come from a first pass; a second one computes the statistics again beside each row, which
    spares a shuffle of texts and needs no unique id.
    """
    small_batches(docs.sparkSession)
    folder = workspace(docs.sparkSession, "quality")
    stats = docs.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), stats_of(F.col("text")).alias("_stats"))
    stats = stage(_keyed(stats).drop("lang", "source"), f"{folder}/stats")
    fits = fit(stats, folder)
    drop(docs.sparkSession, f"{folder}/stats")
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # names that clash with none used here
    rows = docs.toDF(*own.values()).withColumn("_stats", stats_of(F.col(own["text"])))
    rows = rows.withColumns({"lang_key": text_key(own["lang"]), "source_key": text_key(own["source"])})
    return judged(rows, fits).where("kept").select(*[F.col(c).alias(name) for name, c in own.items()])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).select("doc_id", *STATS[:5], "base_failed", "kept", "distance")
