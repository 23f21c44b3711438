"""Mixing sources to target weights.

The words of each source form one stream, in a pseudorandom but fixed order of its
documents, cut into blocks of ``block`` words, whatever the source's size; the last one is what
is left. The mix is a number of output shards of ``shard_slots`` slots. Each slot of a
shard draws its source, in proportion to what each source has to give, so that a shard's
counts by source are a multinomial draw. What a source is drawn beyond what it has to give
is left out, and what is missing is drawn in further shards in the same way, until one
shard holds all that is left. The slots of a source, counted over all shards, are mapped
through a pseudorandom permutation of the source's block indexes (one pass after the
other, each of them ending with the last block), and the blocks are joined to the slots by
that index. A source's last slot takes only so many words of its block as its target still
lacks, so that totals are exact to a word.

All of it is DataFrame code over tables of sources, shards and slots; the driver gets sums
only, and nothing depends on how many sources, shards or documents there are.

Defined results:

* a null text has no words; rows without words are never taken
* a null source is a source of its own, the last one
* rows with a null or repeated doc_id are separate rows of the stream
* an empty table gives an empty mix
* no block, and so no document, is taken more than ``max_epochs`` times
* the order of rows and partitions of the input doesn't matter: reruns agree
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan import scratch
from veilspan.llm import sums

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Rounds of the swap-or-not shuffle.
ROUNDS = 24
#: What ``mixed_documents`` adds to the columns of documents.
PLACE = ("mix_shard", "mix_slot", "mix_place", "mix_ends")


@dataclass(frozen=True)
class Recipe:
    """weights repeat over the sources in code point order."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    max_epochs: int = 2
    block: int = 256
    shard_slots: int = 8192
    rows_per_bucket: int = 2_000
    seed: int = 17


def n_words(text: Column) -> Column:
    """Number of words."""
    t = F.coalesce(text, F.lit(""))
    parts = F.size(F.split(t, f"{SPACE}+"))
    return (parts - F.when(t.rlike(f"^{SPACE}"), 1).otherwise(0) - F.when(t.rlike(f"{SPACE}\\z") | (t == ""), 1).otherwise(0)).cast("long")


def with_targets(sources: DataFrame, recipe: Recipe) -> DataFrame:
    """``sources`` (rank, size) with ``target``: words for each by weight, at most ``max_epochs`` times its own; what is over goes to the others by weight.

    The words for a unit of weight rise until no further source is over; the driver gets a
    row for each weight of the recipe, of whole numbers, so that reruns agree.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in recipe.weights]), (F.col("rank") % len(recipe.weights) + 1).cast("int"))
    table = sources.withColumn("weight", weight).withColumn("most", recipe.max_epochs * F.col("size"))
    total = recipe.share * (sources.agg(F.sum("size")).first()[0] or 0)
    unit, before = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(unit) > F.col("most")
        found = table.groupBy("weight").agg(F.count_if(~over).alias("free"), F.count_if(over).alias("over"), F.sum(F.when(over, F.col("most")).otherwise(0)).alias("held")).collect()
        free, held, n_over = sum(r["weight"] * r["free"] for r in sorted(found)), sum(r["held"] for r in found), sum(r["over"] for r in found)
        if n_over == before or not free:
            return table.withColumn("target", F.when(over, F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(unit))).drop("weight", "most")
        unit, before = (total - held) / free, n_over


def draws(quotas: DataFrame, recipe: Recipe) -> DataFrame:
    """shard, sid, first, n: how many slots of a shard are a source's, and the first of them in the source's count. ``quotas``: sid, quota, a written table."""
    spark = quotas.sparkSession
    left = quotas.select("sid", F.col("quota").alias("left"), F.lit(0).cast("long").alias("given")).where("quota > 0")
    out, shard, turn = None, 0, 0
    while total := left.agg(F.sum("left")).first()[0] or 0:
        if total <= recipe.shard_slots:
            plan = left.select(F.lit(shard).cast("long").alias("shard"), "sid", F.col("given").alias("first"), F.col("left").alias("n"))
            return plan if out is None else out.unionByName(plan)
        shards = total // recipe.shard_slots
        width = -(-total // (4 * left.count()))
        lots = sums.before(left, [], "sid", "left", "lo").withColumn("hi", F.col("lo") + F.col("left"))
        cells = lots.select("sid", "lo", "hi", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})")).alias("cell"))
        slots = spark.range(shards * recipe.shard_slots).withColumn("lot", F.pmod(F.xxhash64(F.lit(recipe.seed), F.lit(turn), "id"), F.lit(total))).withColumn("cell", F.expr(f"lot div {width}"))
        drawn = slots.join(cells, "cell").where("lo <= lot and lot < hi").groupBy(F.expr(f"id div {recipe.shard_slots}").alias("at"), "sid").agg(F.count(F.lit(1)).alias("drawn"))
        drawn = sums.before(scratch.written(drawn, "mix-drawn"), ["sid"], "at", "drawn", "upto").join(left, "sid")
        held = F.least(F.col("drawn"), F.greatest(F.col("left") - F.col("upto"), F.lit(0)))
        plan = drawn.select((F.lit(shard) + F.col("at")).alias("shard"), "sid", (F.col("given") + F.col("upto")).alias("first"), held.alias("n")).where("n > 0")
        plan = scratch.written(plan, "mix-plan")
        got = plan.groupBy("sid").agg(F.sum("n").alias("got"))
        left = left.join(got, "sid", "left").select("sid", (F.col("left") - F.coalesce("got", F.lit(0))).alias("left"), (F.col("given") + F.coalesce("got", F.lit(0))).alias("given")).where("left > 0")
        left = scratch.written(left, "mix-left")
        out, shard, turn = plan if out is None else out.unionByName(plan), shard + shards, turn + 1
    return out if out is not None else spark.createDataFrame([], "shard long, sid long, first long, n long")


def permuted(index: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, for any n: a swap-or-not shuffle. In each round i and (k - i) mod n trade places if a hash of the larger says so."""

    def one(i: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - i, n)
        return F.when(F.xxhash64(key, r, F.greatest(i, other), F.lit("swap")).bitwiseAND(F.lit(1)) == 1, other).otherwise(i)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), one)


class Mix:
    """``sized``: a row for each document; ``slots``: a row for each block of each shard; ``pieces``: what the mix takes, a row for each part of a document in each slot."""

    def __init__(self, docs: DataFrame, recipe: Recipe = Recipe(), keep_text: bool = False):
        self.recipe = recipe
        own = F.struct(*docs.columns).alias("row")
        base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), F.xxhash64("text", "source").alias("h"), *([own] if keep_text else []))
        base = base.withColumn("spot", F.xxhash64(F.lit(recipe.seed), "doc_id", "h"))
        if not keep_text:  # with texts, a copy would be as large as the documents: they are read twice
            base = scratch.written(base, "mix-sized")

        # sources by code point: their targets, blocks and slots
        sources = base.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        sources = scratch.written(sums.numbered(sources, [F.col("source").asc_nulls_last()], "rank"), "mix-sources")
        sources = with_targets(sources, recipe)
        whole, block = F.bround("target").cast("long"), recipe.block
        sources = sources.withColumn("blocks", F.ceil(F.col("size") / block).cast("long")).withColumn("whole", whole)
        # whole passes, each of exactly its source's words, whole blocks of one more, and words of one more block
        sources = sources.withColumn("rest", F.when(F.col("size") > 0, F.expr("whole % size")).otherwise(0)).withColumn("words", F.expr(f"rest % {block}"))
        passes = F.when(F.col("size") > 0, F.expr("whole div size * blocks")).otherwise(0)
        quota = (passes + F.expr(f"rest div {block}") + (F.col("words") > 0).cast("long")).cast("long")
        cut_to = F.when(F.col("words") > 0, F.col("words")).otherwise(block).cast("long")
        buckets = F.greatest(F.ceil(F.col("n") / recipe.rows_per_bucket), F.lit(1)).cast("long")
        sources = sources.select(F.col("rank").alias("sid"), "source", "n", F.col("size").alias("source_size"), "target", "blocks", buckets.alias("buckets"), quota.alias("quota"), cut_to.alias("cut_to"))
        sources = scratch.written(sources, "mix-targets")

        # places in the streams: a prefix sum within each bucket, and one over the buckets' totals
        rows = sums.lookup(base, sources.drop("blocks", "quota", "cut_to"), "source", "n").drop("n", "source")
        rows = rows.withColumn("bucket", F.pmod(F.col("spot"), F.col("buckets"))).drop("buckets")
        light = rows.select("sid", "bucket", "size")
        totals = sums.before(light.groupBy("sid", "bucket").agg(F.sum("size").alias("words")), ["sid"], "bucket", "words", "bucket_at").drop("words")
        within = Window.partitionBy("sid", "bucket").orderBy("spot", "doc_id", "size", "h")
        rows = rows.withColumn("rank", F.row_number().over(within)).withColumn("upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        rows = rows.join(totals, ["sid", "bucket"])
        self.sized = rows.withColumn("at", F.col("bucket_at") + F.col("upto") - F.col("size")).drop("bucket_at", "upto", "spot", "h")

        plan = draws(sources.select("sid", "quota"), recipe)
        # a row of the plan is many slots: they are dealt out before they are made
        spark = docs.sparkSession
        plan = plan.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard", "sid")
        slots = plan.select("shard", "sid", F.explode(F.expr("sequence(first, first + n - 1)")).alias("count"))
        held = scratch.written(plan.groupBy("sid").agg(F.sum("n").alias("n")).join(sources.select("sid", "blocks", "quota", "cut_to"), "sid"), "mix-slots")
        slots = sums.lookup(slots, held, "sid", "n").drop("n")
        slots = slots.withColumn("epoch", F.expr("count div blocks"))
        most = F.greatest(F.col("blocks") - 1, F.lit(1))  # the last block, which may be short, ends each pass
        place = F.col("count") % F.col("blocks")
        slots = slots.withColumn("block", F.when(place == F.col("blocks") - 1, place).otherwise(permuted(place % most, most, F.struct(F.lit(recipe.seed), F.col("sid"), F.col("epoch")))))
        slots = slots.withColumn("most", F.when(F.col("count") == F.col("quota") - 1, F.col("cut_to")).otherwise(F.lit(block).cast("long")))
        # the blocks of a shard in a pseudorandom order
        in_shard = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(recipe.seed), "sid", "count"), "sid", "count")
        self.slots = slots.withColumn("slot", (F.row_number().over(in_shard) - 1).cast("long")).select("shard", "slot", "sid", "block", "most")

        def cut(words: Column | None) -> Column:
            """A document's parts by block, each with its own words only."""

            def one(k: Column) -> Column:
                lo = F.greatest(F.col("at"), k * block) - F.col("at")
                hi = F.least(F.col("at") + F.col("size"), (k + 1) * block) - F.col("at")
                text = [] if words is None else [F.array_join(F.slice(words, (lo + 1).cast("int"), (hi - lo).cast("int")), "").alias("text")]
                return F.struct(k.alias("block"), lo.alias("from_word"), hi.alias("to_word"), F.greatest(F.col("at") - k * block, F.lit(0)).alias("place"), *text)

            return F.transform(F.sequence(F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}")), one)

        # the words of a text are found once, however many blocks it lies in
        def found(text: Column) -> Column:
            return F.regexp_extract_all(text, F.lit(f"{SPACE}*{WORD}"), F.lit(0))

        cells = F.element_at(F.transform(F.array(found(F.col("row.text"))), cut), 1) if keep_text else cut(None)
        rest = [F.struct(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "text"]).alias("row")] if keep_text else []
        parts = self.sized.where("size > 0").select("sid", "bucket", "rank", "size", *rest, F.explode(cells).alias("cell")).select("*", "cell.*").drop("cell")
        left = F.col("most") - F.col("place")
        pieces = self.slots.join(parts, ["sid", "block"]).where(left > 0)
        short = left < F.col("to_word") - F.col("from_word")
        if keep_text:
            pieces = pieces.withColumn("text", F.when(short, F.array_join(F.slice(found(F.col("text")), F.lit(1), left.cast("int")), "")).otherwise(F.col("text")))
        self.pieces = pieces.withColumn("to_word", F.when(short, F.col("from_word") + left).otherwise(F.col("to_word")))

    def taken(self) -> DataFrame:
        """For each document: doc_id, size, source_size, target, taken."""
        got = self.pieces.groupBy("sid", "bucket", "rank").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
        rows = self.sized.join(got, ["sid", "bucket", "rank"], "left")
        return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The mix of a written table: a row for each piece, with all columns of its document, its own words as ``text`` and their ``n_chars``, and PLACE.

    PLACE is the shard, the slot in it, the word of the slot at which the piece begins, and
    whether the piece ends its document: in the order of the first three, the pieces are the
    mix. Columns of these names in ``docs`` are replaced. A document that is taken twice comes
    twice, one that isn't taken doesn't come.
    """
    clean = docs.drop(*PLACE)
    pieces = Mix(clean, recipe, keep_text=True).pieces

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        return F.length("text").cast(dict(clean.dtypes)[name]).alias(name) if name == "n_chars" else F.col("row").getField(name).alias(name)

    place = (F.col("shard"), F.col("slot"), F.col("place"), F.col("to_word") == F.col("size"))
    return pieces.select(*[column(c) for c in clean.columns], *[v.alias(n) for v, n in zip(place, PLACE, strict=True)])
