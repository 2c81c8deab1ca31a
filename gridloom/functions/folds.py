"""Ordered folds that no window frame expresses: each step looks at what earlier steps kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.settings import BLOCK, SETTINGS


def keep_apart(blocks: Column, overlap: float = SETTINGS.dedup_overlap) -> Column:
    """Of blocks (array of BLOCK structs in order) those that aren't near an earlier kept one.

    Two are near when both corner offsets stay below ``overlap`` of the smaller padded size.
    """

    def near(a: Column, b: Column) -> Column:
        dy = F.abs(a.y - b.y).cast("double") < F.least(a.ph, b.ph) * F.lit(overlap)
        dx = F.abs(a.x - b.x).cast("double") < F.least(a.pw, b.pw) * F.lit(overlap)
        return dy & dx

    def step(kept: Column, block: Column) -> Column:
        return F.when(F.exists(kept, lambda k: near(block, k)), kept).otherwise(F.concat(kept, F.array(block)))

    return F.aggregate(blocks, F.array().cast(f"array<{BLOCK.simpleString()}>"), step)


def merge_close(lines: Column, gap: int) -> Column:
    """Ascending line positions with those nearer than ``gap`` to the last one merged into the midpoint of both."""

    def step(merged: Column, at: Column) -> Column:
        last = F.element_at(merged, -1)
        middle = F.floor((last + at) / 2).cast("long")
        return F.when(at - last >= gap, F.concat(merged, F.array(at))).otherwise(F.concat(F.slice(merged, F.lit(1), F.size(merged) - 1), F.array(middle)))

    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.when(F.size(lines) == 0, lines).otherwise(F.aggregate(rest, F.slice(lines, 1, 1), step))
