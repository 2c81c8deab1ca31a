"""From ruled lines of a page to cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as g
from gridloom.functions.folds import merge_close
from gridloom.settings import SETTINGS


def line_positions(boxes: DataFrame, page: list[str], at: str, name: str) -> DataFrame:
    """Ascending distinct positions of each page as an array; a page of P pixels has P of them at most."""
    return boxes.groupBy(*page).agg(F.array_sort(F.collect_set(F.col(at).cast("long"))).alias(name))


def merged_lines(boxes: DataFrame, page: list[str], at: str, gap: int, name: str = "lines") -> DataFrame:
    return line_positions(boxes, page, at, name).withColumn(name, merge_close(F.col(name), gap))


def _stretches(lines: Column, end: int) -> Column:
    """(low, high) of the stretches between neighbouring lines, the page's edges included."""
    edges = F.concat(F.array(F.lit(0).cast("long")), lines, F.array(F.lit(end).cast("long")))
    inner = F.slice(edges, F.lit(1), F.size(edges) - 1)
    return F.zip_with(inner, F.slice(edges, F.lit(2), F.size(edges) - 1), lambda a, b: F.struct(a.alias("low"), b.alias("high")))


def grid_cells(lines: DataFrame, page: list[str], page_w: int | Column = SETTINGS.page_width, page_h: int | Column = SETTINGS.page_height) -> DataFrame:
    """(page, cell_idx, x1, y1, x2, y2, w, h): cells between the lines (h_lines, v_lines), row by row.

    Cells that are too small aren't counted. Rows and columns of a page are combined and numbered within its row,
    without a join or a shuffle.
    """
    cells = F.flatten(
        F.transform(
            _stretches(F.col("h_lines"), page_h),
            lambda r: F.transform(_stretches(F.col("v_lines"), page_w), lambda c: F.struct(c.low.alias("x1"), r.low.alias("y1"), c.high.alias("x2"), r.high.alias("y2"))),
        )
    )
    kept = F.filter(cells, lambda c: g.is_cell(c.x2 - c.x1, c.y2 - c.y1))
    out = lines.select(*page, F.posexplode(kept).alias("cell_idx", "c")).select(*page, "cell_idx", "c.*")
    return out.withColumns({"w": F.col("x2") - F.col("x1"), "h": F.col("y2") - F.col("y1")})


def viable(lines: DataFrame) -> DataFrame:
    """Pages with two lines or more in either direction."""
    return lines.where((F.size("h_lines") >= 2) & (F.size("v_lines") >= 2))


def grid_blocks(cells: DataFrame, page_w: int | Column = SETTINGS.page_width, page_h: int | Column = SETTINGS.page_height) -> DataFrame:
    return cells.where(g.is_grid_block("w", "h", F.lit(page_w), F.lit(page_h)))
