"""The review between propose and apply: proposals as rows, a log of edits, and what both come to.

A proposal's id is a hash of its page and of the span and type that were detected, so that it
stays the same when the page is proposed again, and an edit of it keeps its meaning. An edit
names a proposal, a version and an action; of the edits of one proposal the highest version
counts. Actions:

* ``accept``: the proposal as it is
* ``reject``: no substitution there
* ``move``: start and end of the edit
* ``retype``: entity_type of the edit
* ``add``: a span that wasn't proposed: start, end and entity_type of the edit; its id is that
  of such a proposal

Edits that come to nothing are reported, not applied: ``stale`` ones, whose proposal isn't
there any more, and ``invalid`` ones, whose span isn't in the page's text or whose action
isn't known; the proposal stays as it was. Numbers and placeholders are given out
after the edits, so that values of one type share a number again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan.functions import spans
from veilspan.functions.text import newlines, piece
from veilspan.operators import anonymize, overlaps

ACTIONS = ("accept", "reject", "move", "retype", "add")
STATUS = {"accept": "accepted", "reject": "rejected", "move": "moved", "retype": "retyped", "add": "added"}
#: Columns of an edit besides its page.
EDIT = ("proposal_id", "version", "action", "start", "end", "entity_type")
#: Columns of a proposal besides its page and id.
PROPOSED = ("entity_type", "start", "end", "score", "value", "breaks")


def proposal_id(page: list[str], start: Column, end: Column, entity_type: Column) -> Column:
    """16 hexadecimal digits of the SHA-256 of page, span and type."""
    parts = [*[F.col(c).cast("string") for c in page], start.cast("string"), end.cast("string"), entity_type]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def proposals(pages: DataFrame, page: list[str], floor: float = spans.SCORE_FLOOR) -> DataFrame:
    """A row for each entity that ``anonymize.propose`` would replace: page, proposal_id, entity_type, start, end, score, value, breaks."""
    rows = anonymize.normalized_rows(pages, page, floor)
    return rows.select(*page, proposal_id(page, F.col("start0"), F.col("end0"), F.col("entity_type")).alias("proposal_id"), "entity_type", "start", "end", "score", "value", "breaks")


def spelled(edits: DataFrame, page: list[str]) -> DataFrame:
    """page, proposal_id, edit: each edit with its proposal's id, also where it names a span only."""
    own = F.coalesce("proposal_id", proposal_id(page, F.col("start"), F.col("end"), F.col("entity_type")))
    return edits.select(*page, own.alias("proposal_id"), F.struct(*[F.col(c) for c in EDIT[1:]]).alias("edit"))


def merged(pages: DataFrame, proposed: DataFrame, edits: DataFrame, page: list[str]) -> DataFrame:
    """Proposals and edits put together: page, proposal_id, status, entity_type, start, end, score, value, breaks, version, n_edits.

    status is ``proposed`` (no edit), one of STATUS, ``stale`` or ``invalid``. Rows that are
    rejected or stale have no span; an invalid edit leaves the proposal's, if there is one. The
    text is only read for spans that an edit gives. Of the edits of a proposal that of the highest
    version counts; of several with one version the last by action, span and type. Edits and proposals meet in windows of a
    page, so that rows which are dealt out by page stay where they are.
    """
    last = spelled(edits, page).join(pages.select(*page, "text"), page, "left")
    lo, hi = F.col("edit.start"), F.col("edit.end")
    fits = F.col("edit.action").isin("move", "add") & (lo >= 0) & (lo < hi) & (hi <= F.length("text"))
    last = last.select(*page, "proposal_id", F.struct("edit", F.when(F.coalesce(fits, F.lit(False)), piece(F.col("text"), lo, hi)).alias("cut")).alias("last"))
    given = F.struct(*[F.col(c) for c in PROPOSED]).alias("own")
    met = proposed.select(*page, "proposal_id", given).unionByName(last, allowMissingColumns=True)
    same = Window.partitionBy(*page, "proposal_id")
    # edits come to one row of their own only where there is no proposal
    nth = F.row_number().over(same.orderBy(F.col("own").isNull()))
    met = met.withColumns({"last": F.max("last").over(same), "n_edits": F.count("last").over(same), "nth": nth}).where("own is not null or nth = 1")
    both = met.select(*page, "proposal_id", *[F.col(f"own.{c}").alias(c) for c in PROPOSED], "last.edit", "last.cut", "n_edits")
    action, there = F.col("edit.action"), F.col("start").isNotNull()
    gives = action.isin("move", "add")
    known = F.coalesce(action.isin(*ACTIONS), F.lit(False))
    both = both.withColumns({
        "gives": F.coalesce(gives, F.lit(False)),
        "status": F.when(F.col("edit").isNull(), "proposed").when(~known, "invalid").when(~there & (action != "add"), "stale").otherwise(F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv])[action]),
    })
    bad = F.col("gives") & (F.col("status") != "stale") & F.col("cut").isNull()
    bad = bad | (F.col("status").isin("retyped", "added") & (F.coalesce("edit.entity_type", F.lit("")) == ""))
    both = both.withColumn("status", F.when(bad, "invalid").otherwise(F.col("status")))
    out, moved = F.col("status").isin("rejected", "stale"), F.col("status").isin("moved", "added")

    def field(name: str, new: Column, when: Column) -> Column:
        return F.when(out, None).when(when, new).otherwise(F.col(name)).alias(name)

    return both.select(
        *page, "proposal_id", "status",
        field("entity_type", F.col("edit.entity_type"), F.col("status").isin("retyped", "added")),
        field("start", F.col("edit.start"), moved), field("end", F.col("edit.end"), moved),
        "score", field("value", F.replace("cut", F.lit("\n"), F.lit(" ")), moved), field("breaks", newlines(F.col("cut")), moved),
        F.col("edit.version").alias("version"), F.coalesce("n_edits", F.lit(0)).alias("n_edits"),
    )


def numbered(reviewed: DataFrame, page: list[str], fmt: Callable[[Column, Column], Column] = anonymize.square) -> DataFrame:
    """The rows of ``merged`` that are substituted, with number, placeholder, replacement and first_start."""
    return anonymize.numbered(reviewed.where("start is not null"), page, fmt)


def placed(reviewed: DataFrame, page: list[str], fmt: Callable[[Column, Column], Column] = anonymize.square) -> DataFrame:
    """All rows of ``merged``, with what ``numbered`` adds; null where nothing is substituted. No row is looked up by another."""
    rows = anonymize.numbered(reviewed.withColumn("__there", F.col("start").isNotNull()), [*page, "__there"], fmt)
    return rows.withColumns({c: F.when(F.col("__there"), F.col(c)) for c in ("number", "placeholder", "replacement", "first_start")}).drop("__there")


def substitutions(pages: DataFrame, reviewed: DataFrame, page: list[str], fmt: Callable[[Column, Column], Column] = anonymize.square) -> DataFrame:
    """For each page what ``anonymize.apply`` takes, as ``anonymize.propose`` gives it, from the rows of ``merged``; with n_overlaps: how many spans begin before the one before them ends, which ``apply`` refuses."""
    found = anonymize.gathered(pages, numbered(reviewed, page, fmt), page)
    bad = overlaps.clashes(reviewed.where("start is not null"), page)
    return found.join(bad, page, "left").withColumn("n_overlaps", F.coalesce("n_overlaps", F.lit(0)))
