"""Recognizers and phrase lists as tables.

A recognizer is a row: entity_type, pattern, score, and what may be null: context (labels
that lift the score), boost, least, window, needs. Rows become expressions, which all pages
share; their number is bounded, as each is a search through each text.

A phrase list may have any number of rows: a phrase is found by joins on words, so that 10^5
phrases aren't 10^5 searches. Words are runs of letters and digits. A page's words that begin
some phrase are joined to the numbers of words that phrases with that first word have, and
the words from there on, so many of them, to the phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.functions.text import let, literal_array
from veilspan.operators import detect

#: Most rows of recognizers; most words of a phrase.
MOST_RECOGNIZERS, MOST_WORDS = 500, 16
#: Phrases, and first words of phrases, that are broadcast; bits of the bitmap of more phrases, as a power of two.
BROADCAST_PHRASES, MOST_BITS = 500_000, 26
WORD = r"[\p{L}\p{N}]+"
#: Columns that may be null or missing, with what holds then.
OPTIONAL = {"context": (), "boost": 0.50, "least": 0.55, "window": 40, "needs": ""}


def recognizers(table: DataFrame) -> tuple[detect.Recognizer, ...]:
    """The rows of a table as recognizers, in order of type and pattern. More than MOST_RECOGNIZERS, a score outside 0 to 1 and a pattern that Java can't read are errors."""
    given = [c for c in ("entity_type", "pattern", "score", *OPTIONAL) if c in table.columns]
    rows = table.select(*given).limit(MOST_RECOGNIZERS + 1).collect()
    if len(rows) > MOST_RECOGNIZERS:
        raise ValueError(f"more than {MOST_RECOGNIZERS} recognizers; words and names go into a phrase list")
    made = []
    for r in rows:
        if not r["entity_type"] or not r["pattern"] or r["score"] is None or not 0 <= r["score"] <= 1:
            raise ValueError(f"no type, pattern or score from 0 to 1: {r}")
        table.sparkSession.sparkContext._jvm.java.util.regex.Pattern.compile(r["pattern"])
        more = {k: r[k] if k in given and r[k] is not None else v for k, v in OPTIONAL.items()}
        more["context"] = tuple(x.lower() for x in more["context"])
        made.append(detect.Recognizer(r["entity_type"], r["pattern"], float(r["score"]), **more))
    return tuple(sorted(made, key=lambda m: (m.entity_type, m.pattern, m.score)))


def words_of(text: Column) -> Column:
    """The words of a phrase or a text, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def phrase_index(phrases: DataFrame) -> DataFrame:
    """phrases: entity_type, phrase, score. first, size, words (joined by a space), entity_type, score (the best of equal ones). Phrases without words, and of more than MOST_WORDS, are errors."""
    w = words_of(F.col("phrase"))
    bad = (F.size("w") == 0) | (F.size("w") > MOST_WORDS)
    rows = phrases.select("entity_type", F.col("score").cast("double").alias("score"), "phrase", w.alias("w"))
    size = F.when(bad, F.raise_error(F.concat(F.lit(f"no words, or more than {MOST_WORDS}: "), F.col("phrase"))).cast("int")).otherwise(F.size("w"))
    rows = rows.select("entity_type", "score", size.alias("size"), F.get("w", F.lit(0)).alias("first"), F.array_join("w", " ").alias("words"))
    return rows.groupBy("first", "size", "words", "entity_type").agg(F.max("score").alias("score"))


def found(pages: DataFrame, key: list[str], index: DataFrame, texts: bool = True) -> DataFrame:
    """Each place where a phrase of an index stands: key, entity_type, start, end, score and, with ``texts``, text. Case and what is between words don't count; all places count, also overlapping ones: ``overlaps.resolved`` chooses. pages: key, text.

    The words from a place on are cut out of the page's own list, so that words needn't meet
    again. Places go to the phrases of their size by broadcast, the sizes with the fewest
    phrases first, as long as those are few; places of other sizes pass a bitmap of the phrases
    before they are shuffled.
    """
    index = scratch.written(index, "phrases")
    sizes = {r["size"]: r["n"] for r in index.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MOST_WORDS rows
    few, held = [], 0
    for size in sorted(sizes, key=lambda s: (sizes[s], s)):
        held += sizes[size]
        if held <= BROADCAST_PHRASES:
            few.append(size)
    many = sorted(set(sizes) - set(few))
    out = ["words", "entity_type", "score"]
    met = _places(pages, key, index, few, max(few, default=1), texts).join(F.broadcast(index.where(F.col("size").isin(few)).select(*out)), "words")
    if many:
        large = index.where(F.col("size").isin(many)).select(*out)
        met = met.unionByName(_maybe(_places(pages, key, index, many, max(many), texts), large, sum(sizes[s] for s in many)).join(large, "words"))
    return met.select(*key, "entity_type", "start", "end", "score", *(["text"] if texts else []))


def _places(pages: DataFrame, key: list[str], index: DataFrame, sizes: list[int], longest: int, texts: bool) -> DataFrame:
    """key, start, end, words (lower case, joined by a space) and, with ``texts``, text: so many words from each place on where a phrase may begin, for each of these sizes."""
    whole = F.coalesce("text", F.lit(""))

    def listed(found: Column, gaps: Column | None) -> Column:
        def word(m: Column, i: Column) -> Column:
            said = [] if gaps is None else [F.get(gaps, i).alias("gap"), m["text"].alias("said")]
            return F.struct(F.lower(m["text"]).alias("t"), m["start"].alias("s"), m["end"].alias("e"), *said)

        return let(F.transform(found, word), lambda all_: F.transform(all_, lambda x, i: F.struct(x["t"].alias("first"), F.slice(all_, i + 1, F.lit(longest)).alias("ahead"))))

    places = detect.offsets(whole, WORD)
    ahead = let(F.split(whole, WORD, -1), lambda gaps: listed(places, gaps)) if texts else listed(places, None)
    rows = pages.select(*key, F.explode(ahead).alias("w")).select(*key, "w.first", "w.ahead")
    begins = index.where(F.col("size").isin(sizes)).groupBy("first").agg(F.collect_set("size").alias("sizes"))  # at most MOST_WORDS of them
    if begins.limit(BROADCAST_PHRASES + 1).count() <= BROADCAST_PHRASES:
        rows = rows.join(F.broadcast(begins), "first")
    else:
        rows = rows.withColumn("sizes", F.array(*[F.lit(s) for s in sizes]))
    rows = rows.select(*key, "ahead", F.explode("sizes").alias("size")).where(F.size("ahead") >= F.col("size"))
    some = F.slice("ahead", F.lit(1), F.col("size"))
    said = F.array_join(F.transform(some, lambda x, i: F.when(i == 0, x["said"]).otherwise(F.concat(x["gap"], x["said"]))), "").alias("text") if texts else None
    return rows.select(*key, F.get("ahead", F.lit(0))["s"].alias("start"), F.element_at(some, -1)["e"].alias("end"), F.array_join(F.transform(some, lambda x: x["t"]), " ").alias("words"), *([said] if texts else []))


def _maybe(places: DataFrame, phrases: DataFrame, n: int) -> DataFrame:
    """The places whose words have their bit in a bitmap of the phrases. Its size is bounded: with more phrases than bits it lets more places pass, never fewer."""
    bits = min(max((16 * n).bit_length(), 16), MOST_BITS)
    h = F.pmod(F.xxhash64("words"), F.lit(1 << bits))
    own = phrases.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    dense = phrases.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "word").join(own, "word", "left")
    packed = dense.groupBy().agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("w")).select(F.col("w.bits").alias("bitmap"))
    bitmap = scratch.written(packed, "phrase-bits")
    slot = places.withColumn("slot", h)
    word = F.element_at(bitmap.scalar(), (F.shiftright("slot", 6) + 1).cast("int"))
    return slot.withColumn("word", word).where("shiftrightunsigned(word, cast(slot & 63 as int)) & 1 = 1").drop("slot", "word")


def without(entities: DataFrame, denied: DataFrame) -> DataFrame:
    """Entities whose text isn't denied for their type. denied: entity_type (null: of any type), text; compared as they are."""
    own = denied.select(F.col("entity_type").alias("d_type"), F.col("text").alias("d_text")).distinct()
    typed = entities.join(own.where("d_type is not null"), (F.col("entity_type") == F.col("d_type")) & (F.col("text") == F.col("d_text")), "left_anti")
    return typed.join(own.where("d_type is null").drop("d_type"), F.col("text") == F.col("d_text"), "left_anti")


def detected(pages: DataFrame, key: list[str], table: DataFrame, index: DataFrame | None = None, denied: DataFrame | None = None, allowed: tuple[str, ...] = detect.ALLOWED) -> DataFrame:
    """Entities of pages by a table of recognizers, an index of phrases and a table of denied texts: a row for each, as ``found`` gives them."""
    by_pattern = pages.select(*key, F.explode(detect.detect(F.col("text"), recognizers(table), allowed)).alias("e")).select(*key, "e.entity_type", "e.start", "e.end", "e.score", "e.text")
    rows = by_pattern
    if index is not None:
        rows = rows.unionByName(found(pages, key, index).where(~F.array_contains(literal_array(allowed), F.col("text"))))
    return rows if denied is None else without(rows, denied)
