"""From contours of a page to numbered blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions import geometry as g
from gridloom.functions.folds import keep_apart
from gridloom.settings import SETTINGS


def relevant_pages(documents: DataFrame) -> DataFrame:
    """(pdf_name, page_no) of the pages from the third to the last but one, for (pdf_name, n_pages)."""
    some = documents.where(F.col("n_pages") > 3)  # sequence() would count down
    return some.select("pdf_name", F.explode(F.sequence(F.lit(3), F.col("n_pages").cast("int") - 1)).alias("page_no"))


def contour_candidates(boxes: DataFrame, page_w: int | Column = SETTINGS.page_width, page_h: int | Column = SETTINGS.page_height) -> DataFrame:
    """Boxes (x, y, w, h, ...) that may be blocks, with padded corners x1 .. y2; sizes of pages may be columns."""
    chosen = boxes.where(g.is_contour_block("w", "h", F.lit(page_w), F.lit(page_h)))
    return chosen.withColumn("_c", g.padded("x", "y", "w", "h", F.lit(page_w), F.lit(page_h))).select(*boxes.columns, "_c.*")


def deduplicated(candidates: DataFrame, page: list[str]) -> DataFrame:
    """Candidates of each page that aren't near an earlier one, in reading order, as (page, idx, y, x, w, h, ph, pw).

    A page's boxes meet in one row; they are tens or hundreds, as a page holds no more.
    """
    block = F.struct("y", "x", "w", "h", (F.col("y2") - F.col("y1")).alias("ph"), (F.col("x2") - F.col("x1")).alias("pw"))
    pages = candidates.groupBy(*page).agg(F.array_sort(F.collect_list(block)).alias("b"))
    return pages.select(*page, F.posexplode(keep_apart(F.col("b"))).alias("idx", "k")).select(*page, "idx", "k.*")


def numbered(blocks: DataFrame, document: list[str], order: list[str], name: str = "voter_no") -> DataFrame:
    """Blocks numbered from 1 through each document, in page and block order."""
    return blocks.withColumn(name, F.row_number().over(Window.partitionBy(*document).orderBy(*order)).cast("long"))


def strict_if_many(blocks: DataFrame, page: list[str], many: int = 50) -> DataFrame:
    """Pages with more than ``many`` blocks keep the strict ones only, even if none is."""
    n = F.count("*").over(Window.partitionBy(*page))
    return blocks.withColumn("_n", n).where((F.col("_n") <= many) | g.is_strict_block("w", "h")).drop("_n")


def first_non_empty(first: DataFrame, second: DataFrame, page: list[str]) -> DataFrame:
    """Rows of ``first``, and of ``second`` for pages that ``first`` has none of."""
    return first.unionByName(second.join(first.select(*page).distinct(), page, "left_anti"))


def largest(rows: DataFrame, key: list[str], size: Column, ties: list[str]) -> DataFrame:
    """The largest row of each key, the first in order among equals, by one pass of partial maxima."""
    columns = [c for c in rows.columns if c not in key]
    order = F.struct((-size.cast("double")).alias("_size"), *[F.col(c).alias(f"_{c}") for c in ties], F.struct(*columns).alias("_row"))
    return rows.groupBy(*key).agg(F.min(order).alias("_least")).select(*key, "_least._row.*")
