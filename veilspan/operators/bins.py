"""Joins over intervals and boxes by bins.

Both sides go to all bins that they reach into, the bin is part of the join's key, and the
predicate is a condition on what meets there. A pair that meets in several bins counts in
one of them, the first that both reach into, so that no distinct is needed. A dense page is
dealt out by its bins, and pairs that are far apart never meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points of an interval's bin; pixels of a cell's side.
CHARS, PIXELS = 256, 200


def _first(start: Column, size: int) -> Column:
    return F.floor(start / F.lit(size)).cast("int")


def _last(start: Column, end: Column, size: int) -> Column:
    return F.floor(F.greatest(end - 1, start) / F.lit(size)).cast("int")


def met_intervals(left: DataFrame, right: DataFrame, key: list[str], left_span: tuple[str, str], right_span: tuple[str, str], size: int = CHARS) -> DataFrame:
    """Pairs of equal key whose half-open intervals overlap (touching isn't overlap). The sides' other columns must differ in name."""

    def binned(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        lo, hi = F.col(span[0]), F.col(span[1])
        first = _first(lo, size)
        return df.withColumn(name, first).withColumn("__bin", F.explode(F.sequence(first, F.greatest(first, _last(lo, hi, size)))))

    a, b = binned(left, left_span, "__a"), binned(right, right_span, "__b")
    (a0, a1), (b0, b1) = ((F.col(x) for x in s) for s in (left_span, right_span))
    met = (F.col("__bin") == F.greatest("__a", "__b")) & ~((a1 <= b0) | (a0 >= b1))
    return a.join(b, [*key, "__bin"]).where(met).drop("__bin", "__a", "__b")


def cells(x0: Column, y0: Column, x1: Column, y1: Column, size: int = PIXELS) -> Column:
    """gx, gy of all cells that a box reaches into, all four edges included; floor numbers, so that any numbers go."""
    gx0, gy0, gx1, gy1 = (F.floor(c / F.lit(size)).cast("int") for c in (x0, y0, x1, y1))
    column = lambda x: F.transform(F.sequence(gy0, F.greatest(gy0, gy1)), lambda y: F.struct(x.alias("gx"), y.alias("gy")))
    return F.flatten(F.transform(F.sequence(gx0, F.greatest(gx0, gx1)), column))


def in_cells(df: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column, size: int = PIXELS) -> DataFrame:
    """A row for each cell: adds __gx and __gy, and __x0 and __y0, the box's first cell."""
    rows = df.withColumns({"__x0": F.floor(x0 / F.lit(size)).cast("int"), "__y0": F.floor(y0 / F.lit(size)).cast("int"), "__cell": F.explode(cells(x0, y0, x1, y1, size))})
    return rows.withColumns({"__gx": F.col("__cell.gx"), "__gy": F.col("__cell.gy")}).drop("__cell")
