"""Character spans and pixel boxes: predicates, score floor, overlap resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspan.functions.text import let, scan

SCORE_FLOOR = 0.30
#: An entity, and the warning of a drop that leaves text uncovered.
ENTITY = "struct<entity_type:string,start:int,end:int,score:double,text:string>"
WARNING = "struct<dropped_type:string,dropped_start:int,dropped_end:int,dropped_score:double,winner_type:string,winner_start:int,winner_end:int,winner_score:double,exposed:array<struct<start:int,end:int>>>"


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Half-open: touching isn't overlap."""
    return ~((a_end <= b_start) | (a_start >= b_end))


def above_floor(entities: Column, floor: float = SCORE_FLOOR) -> Column:
    """Entities whose score, 0 where it is missing, reaches the floor."""
    return F.filter(entities, lambda e: F.coalesce(e["score"], F.lit(0.0)) >= F.lit(floor))


def priority(e: Column) -> Column:
    """The smaller key wins: higher score, then longer, then earlier, then by type."""
    return F.struct((-e["score"]).alias("a"), (e["start"] - e["end"]).alias("b"), e["start"].alias("c"), e["entity_type"].alias("d"))


def priority_columns() -> list[Column]:
    """The same key, from columns of rows, for the order of a window."""
    return [-F.col("score"), F.col("start") - F.col("end"), F.col("start"), F.col("entity_type")]


def uncovered(lo: Column, hi: Column, by_lo: Column, by_hi: Column) -> Column:
    """Up to two pieces of [lo, hi) that an overlapping [by_lo, by_hi) leaves over."""
    left = F.when(lo < by_lo, F.struct(lo.alias("start"), by_lo.alias("end")))
    right = F.when(hi > by_hi, F.struct(by_hi.alias("start"), hi.alias("end")))
    return F.filter(F.array(left, right), lambda f: f.isNotNull())


def resolve(entities: Column) -> Column:
    """Survivors and warnings of a left fold in order of start and priority.

    The fold holds one entity at a time. One that overlaps it replaces it if its key is
    smaller, and is dropped if not; one that doesn't closes it. So an entity may be
    dropped for a winner that is dropped itself later on: neither the set of entities
    without a better neighbour nor a best-first choice is the same. Where no entity overlaps
    the one before it, nothing is replaced or dropped, and there is no fold.
    """
    return let(entities, _resolved)


def _resolved(entities: Column) -> Column:
    item = f"struct<at:int,key:struct<a:double,b:int,c:int,d:string>,e:{ENTITY}>"
    ordered = F.array_sort(F.transform(entities, lambda e: F.struct(e["start"].alias("at"), priority(e).alias("key"), e.alias("e")).cast(item)))
    none_done, none_said = F.array().cast(f"array<{ENTITY}>"), F.array().cast(f"array<{WARNING}>")

    def note(winner: Column, loser: Column) -> Column:
        bare = uncovered(loser["start"], loser["end"], winner["start"], winner["end"])
        said = F.struct(
            loser["entity_type"].alias("dropped_type"), loser["start"].alias("dropped_start"), loser["end"].alias("dropped_end"), loser["score"].alias("dropped_score"),
            winner["entity_type"].alias("winner_type"), winner["start"].alias("winner_start"), winner["end"].alias("winner_end"), winner["score"].alias("winner_score"),
            bare.alias("exposed"),
        )
        leaves = (loser["start"] < winner["start"]) | (loser["end"] > winner["end"])
        return F.when(leaves, F.array(said)).otherwise(none_said)

    def step(cur: Column, nxt: Column) -> tuple[Column, dict[str, Column]]:
        met = cur.isNotNull() & overlap(cur["e"]["start"], cur["e"]["end"], nxt["e"]["start"], nxt["e"]["end"])
        wins = nxt["key"] < cur["key"]
        closed = F.when(met | cur.isNull(), none_done).otherwise(F.array(cur["e"]))
        said = F.when(~met, none_said).when(wins, note(nxt["e"], cur["e"])).otherwise(note(cur["e"], nxt["e"]))
        return F.when(met & ~wins, cur).otherwise(nxt), {"resolved": closed, "warnings": said}

    def finish(acc: Column) -> Column:
        last = F.when(acc["state"].isNull(), acc["resolved"]).otherwise(F.concat(acc["resolved"], F.array(acc["state"]["e"])))
        return F.struct(last.alias("resolved"), acc["warnings"].alias("warnings"))

    alone = F.struct(entities.cast(f"array<{ENTITY}>").alias("resolved"), none_said.alias("warnings"))

    def by_order(o: Column) -> Column:
        meets = F.transform(o, lambda x, i: (i > 0) & overlap(F.get(o, i - 1)["e"]["start"], F.get(o, i - 1)["e"]["end"], x["e"]["start"], x["e"]["end"]))
        apart = F.struct(F.transform(o, lambda x: x["e"]).alias("resolved"), none_said.alias("warnings"))
        fold = scan(o, F.lit(None).cast(item), {"resolved": ENTITY, "warnings": WARNING}, step, finish)
        return F.when(F.forall(meets, lambda m: F.coalesce(~m, F.lit(False))), apart).otherwise(fold)

    return F.when(F.size(entities) <= 1, alone).otherwise(let(ordered, by_order))


def center(box: Column) -> tuple[Column, Column]:
    return box["x"] + box["w"] / F.lit(2.0), box["y"] + box["h"] / F.lit(2.0)


def inside(cx: Column, cy: Column, box: Column) -> Column:
    """Point in box, all four edges included."""
    return cx.between(box["x"], box["x"] + box["w"]) & cy.between(box["y"], box["y"] + box["h"])


def padded(box: Column, width: Column, height: Column, pad: int = 3) -> Column:
    """left, top, right, bottom of a box grown by ``pad`` and held to the page."""
    return F.struct(
        F.greatest(F.lit(0), box["x"] - pad).alias("left"), F.greatest(F.lit(0), box["y"] - pad).alias("top"),
        F.least(width, box["x"] + box["w"] + pad).alias("right"), F.least(height, box["y"] + box["h"] + pad).alias("bottom"),
    )


def box_of_points(x0: Column, y0: Column, x1: Column, y1: Column, page_height: Column, dpi: int = 200) -> Column:
    """Points from the bottom left to a pixel box left, top, right, bottom, rounded half to even."""

    def px(v: Column) -> Column:
        return F.bround(v * dpi / 72.0, 0).cast("int")

    return F.struct(px(x0).alias("left"), px(page_height - y1).alias("top"), px(x1).alias("right"), px(page_height - y0).alias("bottom"))
