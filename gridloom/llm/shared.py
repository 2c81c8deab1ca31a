"""What several operators need: the shared folder, staging, skew-safe joins and prefix sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A table of at most this many narrow rows (some 32 MB) may be broadcast.
BROADCAST_ROWS = 200_000

#: A key is hot when it holds more than one of this many rows, so no more keys than this are hot.
HOT_SHARE = 2_000


#: Rows and bytes that go to Python at a time, at most; a longer text goes by itself.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to BATCH_ROWS and BATCH_BYTES, where they are larger: texts are long, and both sides hold some batches."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = str(spark.conf.get(name))
        if not now.removesuffix("b").isdigit() or not 0 < int(now.removesuffix("b")) <= most:
            spark.conf.set(name, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset, on one machine, as in tests, a temporary folder is made and set.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not path and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="gridloom-"))
    return path or sc.getCheckpointDir()


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder's URI in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if "://" not in path:
        path = path if path.startswith("file:") else f"file://{path}"
    fs, at = _hadoop(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def _hadoop(spark: SparkSession, path: str):
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def drop(spark: SparkSession, path: str) -> None:
    fs, at = _hadoop(spark, path)
    fs.delete(at, True)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage is cut, lost executors lose nothing."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(column: str) -> Column:
    """A non-null string for each value of a nullable string column; null and the text 'null' differ."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column)))


def join_small(left: DataFrame, small: DataFrame, on: list[str], how: str = "left", salt: Column | None = None, salts: int = 64) -> DataFrame:
    """Join a table that usually is small: broadcast up to BROADCAST_ROWS rows, which are counted here.

    Beyond that, the left side is salted and the small side repeated once for each salt, so a hot
    key is spread over ``salts`` tasks.
    """
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(small), on, how)
    salt = F.pmod(F.xxhash64(*left.columns) if salt is None else salt, F.lit(salts))
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.withColumn("_salt", salt.cast("long")).join(spread, [*on, "_salt"], how).drop("_salt")


def join_skewed(left: DataFrame, right: DataFrame, key: str, rows: str, total: int, unique: Column) -> DataFrame:
    """Left outer join on ``key``, of which ``right`` has one row each and in ``rows`` its number of left rows.

    Keys that hold more than a HOT_SHARE-th of all rows, at most HOT_SHARE keys, are broadcast; the
    other rows meet in a shuffle, where rows already served get a key of their own (``unique``).
    The key must be a string.
    """
    values = [c for c in right.columns if c not in (key, rows)]
    most = max(1, total // HOT_SHARE)
    hot = right.where(F.col(rows) > most).select(key, *(F.col(c).alias(f"_hot_{c}") for c in values), F.lit(True).alias("_hot"))
    rest = right.where(F.col(rows) <= most).select(F.col(key).alias("_key"), *(F.col(c).alias(f"_rest_{c}") for c in values))
    out = left.join(F.broadcast(hot), key, "left")
    out = out.withColumn("_key", F.when(F.col("_hot"), F.concat(F.lit("\u0000"), unique.cast("string"))).otherwise(F.col(key)))
    out = out.join(rest, "_key", "left")
    for c in values:
        out = out.withColumn(c, F.coalesce(f"_hot_{c}", f"_rest_{c}"))
    return out.drop("_key", "_hot", *(f"_{k}_{c}" for k in ("hot", "rest") for c in values))


def before(df: DataFrame, keys: list[str], at: str, value: str, most: int, name: str, fan: int = 256) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same keys with a smaller ``at``.

    ``at`` is a long from 0 to ``most``, unique within the keys. Sums are taken over ranges of
    ``fan`` positions, level by level, so that no task gets more than ``fan`` rows of a key.
    """
    high, base = f"_high{most}", f"_base{most}"
    df = df.withColumn(high, F.expr(f"`{at}` div {fan}"))
    inner = Window.partitionBy(*keys, high).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn(name, F.coalesce(F.sum(value).over(inner), F.lit(0).cast("long")))
    if most < fan:
        return out.drop(high)
    sums = df.groupBy(*keys, high).agg(F.sum(value).alias("_part"))
    sums = before(sums, keys, high, "_part", most // fan, base, fan).select(*keys, high, base)
    return out.join(sums, [*keys, high]).withColumn(name, F.col(name) + F.col(base)).drop(high, base)
