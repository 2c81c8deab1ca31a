"""Bookkeeping of runs: order, chunks, batches, outcomes, workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.settings import SETTINGS
from gridloom.sources.staging import staged


def globally_numbered(rows: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """Rows numbered from 1 in a total order, without bringing them together.

    Ranges of the order are sorted apart and staged; a range's first number follows from the sizes of those before,
    one row for each.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = staged(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.expr("monotonically_increasing_id() & 8589934591")), "numbered")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    up_to = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("_part", F.coalesce(up_to, F.lit(0)).alias("_first"))
    return ranged.join(F.broadcast(first), "_part").withColumn(name, F.col("_first") + F.col("_at") + 1).drop("_part", "_at", "_first")


def chunks_of_all(tasks: DataFrame, order: list[str], size: int = SETTINGS.images_per_chunk) -> DataFrame:
    """Chunks of consecutive tasks, across documents."""
    return globally_numbered(tasks, order).withColumn("chunk", F.expr(f"(rn - 1) div {size}")).drop("rn")


def chunks_by_document(tasks: DataFrame, document: list[str], order: list[str], size: int = SETTINGS.images_per_chunk) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(*document).orderBy(*order))
    return tasks.withColumn("rn", rn.cast("long")).withColumn("chunk", F.expr(f"(rn - 1) div {size}")).drop("rn")


def document_batches(documents: DataFrame, order: list[str], size: int = SETTINGS.documents_per_batch) -> DataFrame:
    """Batches of documents, numbered from 1."""
    return globally_numbered(documents, order).withColumn("batch_no", F.expr(f"(rn - 1) div {size} + 1")).drop("rn")


def in_file_order(files: DataFrame, document: list[str], name: str, number: str, legacy: bool) -> DataFrame:
    """Place of each file within its document: by number, or in legacy mode by name, where voter_1000 is before voter_101."""
    order = F.col(name) if legacy else F.col(number)
    return files.withColumn("place", F.row_number().over(Window.partitionBy(*document).orderBy(order)).cast("long"))


def outcome_counts(outcomes: DataFrame, key: list[str], legacy_unified: bool = SETTINGS.legacy_unified) -> DataFrame:
    """(success, total) by key of outcomes (ok boolean); in legacy mode whatever was written counts."""
    good = F.count("*") if legacy_unified else F.count_if("ok")
    return outcomes.groupBy(*key).agg(good.alias("success"), F.count("*").alias("total"))


def with_totals(outcomes: DataFrame, key: list[str]) -> DataFrame:
    """Counts by key, and with null keys the grand total, in one pass."""
    return outcomes.rollup(*key).agg(F.count_if("ok").alias("success"), F.count("*").alias("total"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row: total, successful, failed, average seconds (null without rows)."""
    total = F.count("*")
    return outcomes.agg(total.alias("total"), F.count_if("ok").alias("successful"), (total - F.count_if("ok")).alias("failed"), F.try_divide(F.sum("seconds"), total).alias("avg_seconds"))


def documents_with_text(stats: DataFrame) -> DataFrame:
    """One row: documents of which any image was read."""
    return stats.agg(F.count("*").alias("total"), F.count_if(F.col("ocr_successful") > 0).alias("successful"))


def ready_for_ocr(documents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Documents whose first phase succeeded and left a folder."""
    good = outcomes.where(F.col("preprocess_success") & F.col("cleaned_dir").isNotNull())
    return documents.join(good.select("pdf_name"), "pdf_name", "left_semi")


def workers(free_gb: Column, utilization: Column, cpus: int, per_worker: float = SETTINGS.gigabytes_per_worker, careful: bool = True) -> Column:
    """Workers for a device; null figures stand for no device. ``careful``: little free memory allows one only."""
    fit = F.floor(free_gb * F.lit(0.8) / F.lit(per_worker)).cast("long")
    factor = F.when(utilization > 80, F.lit(0.5)).when(utilization > 60, F.lit(0.7)).otherwise(F.lit(1.0))
    fit = F.greatest(F.lit(1).cast("long"), F.floor(fit * factor).cast("long"))
    out = F.greatest(F.lit(1).cast("long"), F.least(fit, F.lit(cpus).cast("long")))
    if careful:
        out = F.when(free_gb < 2.0, F.lit(1).cast("long")).otherwise(out)
    return F.when(free_gb.isNull() | utilization.isNull(), F.lit(min(2, cpus)).cast("long")).otherwise(out)


def chosen_workers(asked: int | None, recommended: int, cpus: int, clamp: bool) -> int:
    """Workers to start: the recommendation unless a number is asked for, which ``clamp`` holds to it."""
    wanted = recommended if asked is None else max(1, asked)
    return min(min(wanted, recommended) if clamp else wanted, cpus)


def document_workers(cpus: int, documents: int, most: int | None = None) -> int:
    """All processors but one, no more than documents, nor than ``most``."""
    return min(x for x in (cpus - 1 or 1, documents, most) if x is not None)


def preprocess_stats(documents: DataFrame, images: DataFrame) -> DataFrame:
    """PREPROCESS rows of (pdf_name, pdf_path, cleaned_dir) and of saved images (pdf_name, first boolean, seconds).

    ``first`` marks what page 1 left. A document without other images succeeds if that one was saved; one that
    left none fails, with no folder. Seconds are the sum of its images'.
    """
    saved = images.groupBy("pdf_name").agg(F.count_if(~F.col("first")).alias("cleaned"), F.count_if("first").alias("firsts"), F.sum("seconds").alias("time_taken"))
    none = F.lit(0).cast("long")
    out = documents.join(saved, "pdf_name", "left").withColumns({"cleaned": F.coalesce("cleaned", none), "page_1_saved": F.coalesce(F.col("firsts") > 0, F.lit(False)), "time_taken": F.coalesce("time_taken", F.lit(0.0))})
    good = (F.col("cleaned") > 0) | F.col("page_1_saved")
    return out.select("pdf_name", "pdf_path", F.col("cleaned").alias("total_voters"), "cleaned", "page_1_saved", F.when(good, F.col("cleaned_dir")).alias("cleaned_dir"), good.alias("preprocess_success"), "time_taken")


def ocr_stats(documents: DataFrame, outcomes: DataFrame, legacy_unified: bool = SETTINGS.legacy_unified) -> DataFrame:
    """OCR_STATS rows of documents (pdf_name) and outcomes of images (pdf_name, first boolean, ok, seconds).

    What page 1 left is told apart and not counted as an image. In legacy mode it is one too, so it is read and counted
    twice, and whatever was written counts as read.
    """
    good = F.lit(True) if legacy_unified else F.col("ok")
    image = F.lit(True) if legacy_unified else ~F.col("first")
    seconds = F.sum(F.when(F.col("first"), 2 * F.col("seconds")).otherwise(F.col("seconds")) if legacy_unified else F.col("seconds"))
    found = outcomes.groupBy("pdf_name").agg(F.count_if(image & good).alias("ocr_successful"), F.count_if(image & ~good).alias("ocr_failed"), F.count_if(F.col("first") & good).alias("firsts"), seconds.alias("time_taken"))
    none = F.lit(0).cast("long")
    out = documents.select("pdf_name").join(found, "pdf_name", "left")
    return out.select("pdf_name", F.coalesce("ocr_successful", none).alias("ocr_successful"), F.coalesce("ocr_failed", none).alias("ocr_failed"), F.coalesce(F.col("firsts") > 0, F.lit(False)).alias("page_1_ocr_successful"), F.coalesce("time_taken", F.lit(0.0)).alias("time_taken"))


def block_counts(blocks: DataFrame, document: str, page: str) -> DataFrame:
    """Number of blocks by page, and with a null page by document, in one pass."""
    return blocks.groupingSets([[document, page], [document]], document, page).agg(F.count("*").alias("n_blocks"))
