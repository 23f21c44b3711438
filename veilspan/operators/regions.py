"""Regions of a page, and whether recognised words account for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.functions import spans
from veilspan.operators import bins

#: Least area in pixels, and greatest as a share of the page.
LEAST_AREA, MOST_SHARE = 400, 0.45


def sized(regions: DataFrame) -> DataFrame:
    """Regions (x, y, w, h, page_width, page_height) that are neither specks nor frames; both bounds are kept."""
    area = F.col("w").cast("long") * F.col("h")
    return regions.where((area >= LEAST_AREA) & (area <= F.lit(MOST_SHARE) * F.col("page_width") * F.col("page_height")))


BOX = ["x", "y", "w", "h"]


def _same(page: list[str], fields: list[str]) -> Column:
    """Equal page and equal fields, those of the other side being named with ``hit_``."""
    same = F.lit(True)
    for c in [*page, *fields]:
        same = same & (F.col(c) == F.col(f"hit_{c}"))
    return same


def _held(regions: DataFrame, words: DataFrame, page: list[str], how: str) -> DataFrame:
    """By cells of a grid: a centre lies in one, a region goes to each that it reaches into."""
    cx, cy = spans.center(F.struct(*BOX))
    x, y = F.col("x"), F.col("y")
    r = bins.in_cells(regions.select(*page, *BOX).distinct(), x, y, x + F.col("w"), y + F.col("h"))
    size = F.lit(bins.PIXELS)
    w = words.select(*page, cx.alias("cx"), cy.alias("cy")).withColumns({"__gx": F.floor(F.col("cx") / size).cast("int"), "__gy": F.floor(F.col("cy") / size).cast("int")})
    met = r.join(w, [*page, "__gx", "__gy"]).where(spans.inside(F.col("cx"), F.col("cy"), {c: F.col(c) for c in BOX}))
    hits = met.select(*[F.col(c).alias(f"hit_{c}") for c in [*page, *BOX]]).distinct()
    return regions.join(hits, _same(page, BOX), how)


def accounted(regions: DataFrame, words: DataFrame, page: list[str]) -> DataFrame:
    """Regions with at least one word's centre inside."""
    return _held(regions, words, page, "left_semi")


def unaccounted(regions: DataFrame, words: DataFrame, page: list[str]) -> DataFrame:
    """Regions without any: the complement of ``accounted``."""
    return _held(regions, words, page, "left_anti")


EDGES = ["left", "top", "right", "bottom"]


def met_boxes(regions: DataFrame, truth: DataFrame, page: list[str]) -> DataFrame:
    """Pairs of a region (x, y, w, h) and an element (left, top, right, bottom) of a page that overlap in more than an edge: each pair once, in the first cell that both reach into."""
    x, y, (le, to, ri, bo) = F.col("x"), F.col("y"), (F.col(c) for c in EDGES)
    r = bins.in_cells(regions, x, y, x + F.col("w"), y + F.col("h"))
    t = bins.in_cells(truth, le, to, ri, bo).withColumnsRenamed({"__x0": "__tx0", "__y0": "__ty0"})
    owner = (F.col("__gx") == F.greatest("__x0", "__tx0")) & (F.col("__gy") == F.greatest("__y0", "__ty0"))
    met = (x < ri) & (le < x + F.col("w")) & (y < bo) & (to < y + F.col("h"))
    return r.join(t, [*page, "__gx", "__gy"]).where(owner & met).drop("__gx", "__gy", "__x0", "__y0", "__tx0", "__ty0")


def scored(regions: DataFrame, truth: DataFrame, page: list[str]) -> DataFrame:
    """For each element of a manifest (left, top, right, bottom), whether a region of its page overlaps it."""
    met = met_boxes(regions.select(*page, *BOX).distinct(), truth.select(*page, *EDGES).distinct(), page)
    hits = met.select(*[F.col(c).alias(f"hit_{c}") for c in [*page, *EDGES]]).distinct().withColumn("hit", F.lit(True))
    found = truth.join(hits, _same(page, EDGES), "left").withColumn("detected", F.coalesce("hit", F.lit(False)))
    return found.select(*truth.columns, "detected")


def matched(regions: DataFrame, truth: DataFrame, page: list[str], least: float = 0.5) -> DataFrame:
    """One-to-one pairs of regions (region_id) and elements (element_id) of a page whose intersection over union is at least ``least``: page, region_id, element_id, iou.

    Greedy by iou (ties by element, then region), in rounds: pairs that are the best of both
    their sides are taken at once, and leave with all others of those sides; each round takes
    one pair at least of every page that has any, and on pages of ordinary layout nearly all.
    """
    met = met_boxes(regions, truth, page)
    wide = F.least(F.col("right"), F.col("x") + F.col("w")) - F.greatest("left", "x")
    high = F.least(F.col("bottom"), F.col("y") + F.col("h")) - F.greatest("top", "y")
    shared = wide.cast("double") * high
    union = F.col("w").cast("double") * F.col("h") + (F.col("right") - F.col("left")).cast("double") * (F.col("bottom") - F.col("top")) - shared
    left = scratch.written(met.select(*page, "region_id", "element_id", (shared / union).alias("iou")).where(F.col("iou") >= least), "region-pairs")
    taken = left.limit(0)
    while not left.isEmpty():
        rank = F.struct(F.col("iou"), *[-F.col(c) if dict(left.dtypes)[c] in ("int", "bigint") else F.col(c) for c in ("element_id", "region_id")])
        ranked = left.withColumn("rank", rank)
        for side in ("region_id", "element_id"):
            ranked = ranked.withColumn(f"best_{side}", F.max("rank").over(Window.partitionBy(*page, side)))
        marked = scratch.written(ranked.withColumn("both", (F.col("rank") == F.col("best_region_id")) & (F.col("rank") == F.col("best_element_id"))).select(*left.columns, "both"), "region-round")
        won = marked.where("both").drop("both")
        taken = taken.unionByName(won)
        rest = marked.where("not both").drop("both")
        for side in ("region_id", "element_id"):
            rest = rest.join(won.select(*page, side), [*page, side], "left_anti")
        left = scratch.written(rest, "region-pairs")
    return taken


def match_rates(pairs: DataFrame, regions: DataFrame, truth: DataFrame, page: list[str]) -> DataFrame:
    """By the elements' type: element_type, n_elements, n_matched, recall, mean_iou; and in the row without a type all elements, with n_regions and precision."""
    found = truth.join(pairs, [*page, "element_id"], "left")
    sums = [F.count(F.lit(1)).alias("n_elements"), F.count("iou").alias("n_matched"), F.avg("iou").alias("mean_iou")]
    n = regions.agg(F.count(F.lit(1)).alias("n_regions"))
    each = found.groupBy("element_type").agg(*sums).withColumn("n_regions", F.lit(None).cast("long"))
    all_ = found.agg(*sums).withColumn("element_type", F.lit(None).cast("string")).withColumn("n_regions", n.scalar())
    both = each.unionByName(all_)
    return both.select("element_type", "n_elements", "n_matched", (F.col("n_matched") / F.col("n_elements")).alias("recall"), "mean_iou", "n_regions", (F.col("n_matched") / F.col("n_regions")).alias("precision"))
