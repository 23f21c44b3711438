"""Near-duplicate documents by bottom-k sketches from one hash function.

1. A document's set is its distinct word shingles, hashed to 64 bits by a key that is drawn
   from all rows: words and shingles that differ have equal hashes by chance only (2**-64 for
   each two), also where somebody wrote them to that end. Its sketch is the ``K`` smallest hashes. Rows with equal sets are one node, named by a number of one of its rows.
2. Inverted lists of retained values: two sketches of sets with a Jaccard index of 0.8
   share many values (for sets of at most K all that the index asks for; beyond, fewer
   than ``least_shared`` in K have a chance below 1e-10). So it is enough to list a
   node under its rarest retained values, as many as leave fewer than that out; with
   ``MEET - 1`` more, such a pair meets in at least ``MEET`` lists. Values that one node
   alone retains need no list.
3. Lists of at most ``SHORT`` nodes give their pairs; one that meets in no longer list has to
   meet in ``MEET`` of them. A longer list first gives pairs
   with one lead node; once links have joined nodes to components, its nodes outside the
   lead's component are compared with all its nodes of other components, in blocks of
   bounded size that emit no pairs, only the links that join components.
4. The sketch of the union of a pair estimates its index and drops pairs far below the
   threshold; whole sets confirm the others.
5. Components of the links, between documents: smallest reachable id, by propagation with
   pointer jumps. A doc_id with rows of different texts is in several nodes and joins them.

Defined results:

* a null text, and one without words, has an empty set: it is linked with nothing
* a null doc_id has a null component and is kept
* rows with equal doc_ids count as one document: links of any of them link it
* equal sets are linked whatever their size
* a text of any length is one row of one task, which takes some 2 bytes for each of its bytes
  and 40 for each of its words
* other columns of the input don't matter, whatever their names
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.llm import sums
from veilspan.llm.arrow import get, slices, small_batches, text_bytes

K, SHORT, MISS = 64, 24, 1e-10
#: How many listed values a pair shares before its sketches are looked at, if its sets must share as many; each more lists one more value of a node.
MEET = 4
#: Lists of ids up to this length are broadcast (8 bytes each for semi joins, 24 where rows are found by them); longer ones are shuffled.
BROADCAST_IDS = 1_000_000
#: Rows and hashes of each side of a block.
BLOCK_ROWS, BLOCK_HASHES = 512, 1 << 18


def least_shared(percent: int, k: int = K) -> int:
    """The most values of k that a pair at the threshold shares but for a chance below MISS, each of the union's k smallest being shared with the index as its chance."""
    p, chance, t = percent / 100, 0.0, 0
    while t < k:
        chance += math.comb(k, t) * p**t * (1 - p) ** (k - t)
        if chance > MISS:
            break
        t += 1
    return max(1, t)


_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        for k, p in enumerate((_P, _P_INV)):
            steps = np.full(max(n + 1, 1 << 20), p, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][: n + 1], _powers[1][: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Bytes that are searched for words together; words up to so many bytes are hashed 8 bytes at a time, all words at once.
SEARCHED, LONG_WORD = 4 << 20, 256
#: What hashes are drawn by: two numbers that nobody who wrote a text could know.
Key = tuple[int, int]


def key_of(docs: DataFrame) -> Key:
    """From hashes (``h``) of all rows: the same in each run over the same rows, and not to be known from some of them. Hashes by it don't meet but by chance, whatever texts are made for."""
    r = docs.agg(F.count("h").alias("n"), F.bit_xor("h").alias("x"), F.min("h").alias("a"), F.max("h").alias("b"), F.bit_xor(F.xxhash64("h")).alias("y")).first()
    digest = hashlib.sha256(repr(tuple(r)).encode()).digest()
    return int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:16], "little")


def word_places(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all texts begin and end. ``at``: places where texts begin, and the end of the last."""
    starts, ends = [], []
    for lo in range(0, len(data), SEARCHED):
        word = ~_SPACE[data[lo : lo + SEARCHED]]
        before = np.concatenate([[lo > 0 and not _SPACE[data[lo - 1]]], word[:-1]])
        own = at[np.searchsorted(at, lo) : np.searchsorted(at, lo + len(word))] - lo
        cut = own[word[own] & before[own]]  # a text begins within what would be one word
        begins, stops = word & ~before, ~word & before
        begins[cut] = stops[cut] = True
        starts.append(np.flatnonzero(begins) + lo)
        ends.append(np.flatnonzero(stops) + lo)
    if len(data) and not _SPACE[data[-1]]:
        ends.append(np.array([len(data)]))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(starts or none), np.concatenate(ends or none)


def word_hashes(data: np.ndarray, at: np.ndarray, key: Key) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased), and the documents' places among them."""
    starts, ends = word_places(data, at)
    low = np.zeros(len(data) + 8, np.uint8)
    low[:-8] = _LOWER[data]
    eight = np.ndarray(len(data) + 1, "<u8", low, strides=(1,))  # the 8 bytes from each place on
    size = ends - starts
    k1, k2 = np.uint64(key[0]), np.uint64(key[1])
    h = mix(size.astype(np.uint64) + k1)
    open_ = np.flatnonzero(size <= LONG_WORD)
    done = 0
    while len(open_):
        left = size[open_] - done
        own = eight[starts[open_] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(8 - left, 0)).astype(np.uint64))
        h[open_] = mix(h[open_] ^ own) + k2
        done += 8
        open_ = open_[left > 8]
    secret = k1.tobytes() + k2.tobytes()
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(low[starts[i] : ends[i]], digest_size=8, key=secret).digest(), "little")
    return mix(h), np.searchsorted(starts, at)


def shingle_sets(column: pa.Array, words: int, key: Key) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    h, at = word_hashes(*text_bytes(column), key)
    if len(h) >= words:
        s = np.zeros(len(h) - words + 1, np.uint64)
        for j in range(words):
            s = mix(s + h[j : len(h) - words + 1 + j])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            own = np.sort(s[a : b - words + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:  # the whole sequence is one shingle
            one = np.array([b - a], np.uint64)
            for x in h[a:b]:
                one = mix(one + x)
            yield mix(one ^ np.uint64(0x5851F42D4C957F2D))
        else:
            yield np.zeros(0, np.uint64)


def sketches(docs: DataFrame, words: int, key: Key, k: int = K) -> DataFrame:
    """For each row: id and h, as they come, n (set size), d1 and d2 (a digest of the set), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            n, d1, d2, low = [], [], [], []
            for own in shingle_sets(get(batch, "text"), words, key):
                n.append(len(own))
                d1.append(int(mix(own + np.uint64(1)).sum(dtype=np.uint64).astype(np.int64)))
                d2.append(int(mix(own ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).astype(np.int64)))
                low.append(own[:k].view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in low])]).astype(np.int32)
            sketch = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(low)))
            yield pa.RecordBatch.from_arrays([get(batch, "id"), get(batch, "h"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), sketch], ["id", "h", "n", "d1", "d2", "sketch"])

    return docs.mapInArrow(run, "id long, h long, n long, d1 long, d2 long, sketch array<long>")


def chosen(rows: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``id`` is (or isn't) in ``ids``, a written table; broadcast up to BROADCAST_IDS."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if small else ids, "id", how)


def index(nodes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """The inverted lists: v, id, n, shared (how many of the node's retained values others retain). nodes: id, n, sketch."""
    smallest = math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 62  # smaller sets have no partner but equals
    values = nodes.where(F.col("n") >= smallest).select("id", "n", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = values.join(shared, "v").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("own"))  # at most k for each row
    held = F.least("n", F.lit(k))
    exact = F.col("n") - F.expr(f"(n * {percent} + 99) div 100") + 1
    sketched = held - least_shared(percent, k) + 1
    # with n * 100 <= k * percent, a partner's sketch is its whole set too
    prefix = F.when(F.col("n") * 100 <= k * percent, exact).otherwise(F.greatest(sketched, F.when(F.col("n") <= k, exact).otherwise(1)))
    lists = lists.withColumn("take", prefix + (MEET - 1) - (held - F.size("own")))
    return lists.where("take > 0").select("id", "n", F.size("own").alias("shared"), F.explode(F.expr("slice(own, 1, cast(take as int))")).alias("e")).select("e.v", "id", "n", "shared")


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """Pairs whose union sketch doesn't rule them out. Where both sketches are whole sets, the index itself decides."""
    least = least_shared(percent, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            cols = []
            for name in ("sa", "sb"):
                c = get(batch, name)
                cols.append((c.values.to_numpy(zero_copy_only=False).view(np.uint64), c.offsets.to_numpy()))
            na, nb = get(batch, "na").to_numpy(), get(batch, "nb").to_numpy()
            for i in range(batch.num_rows):
                a, b = (v[o[i] : o[i + 1]] for v, o in cols)
                both = np.sort(np.concatenate([a, b]))
                same = both[1:][both[1:] == both[:-1]]
                if na[i] <= k and nb[i] <= k:
                    keep.append(100 * len(same) >= percent * (len(both) - len(same)))
                else:
                    union = np.concatenate([both[:1], both[1:][both[1:] != both[:-1]]])
                    keep.append(np.searchsorted(same, union[min(k, len(union)) - 1], "right") >= least)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    n = nodes.select("id", "n", "sketch")
    left = n.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = n.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def texts_of(docs: DataFrame, rows: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What gives id, text, a row for each node in a written table of id. docs: doc, h, text; rows, a written table: id, doc, h (a hash of doc and text)."""
    repeated = not rows.groupBy("doc", "h").count().where("count > 1").isEmpty()

    def texts(ids: DataFrame) -> DataFrame:
        own = scratch.written(chosen(rows, ids).withColumnRenamed("doc", "own"), "near-rows")
        small = own.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        found = docs.join(F.broadcast(own) if small else own, "h").where("doc = own").select("id", "text")
        return found.dropDuplicates(["id"]) if repeated else found

    return texts


def _confirmed(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], words: int, percent: int, key: Key) -> DataFrame:
    """Pairs whose whole sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(get(batch, "sa"), get(batch, "sb"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (len(a) + len(b) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = scratch.written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")
    found = _sets(texts, ids, words, key)
    joined = pairs.join(found.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(found.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    links = scratch.written(joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").distinct(), "near-links")
    scratch.drop(found)
    return links


def components(links: DataFrame) -> DataFrame:
    """id, comp for each id that ``links`` (a, b; a written table) names: the smallest id that links reach."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = scratch.written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "id"), "near-label")
    while True:
        near = both.join(label.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("low")).withColumnRenamed("a", "id")
        lower = label.join(near, "id").select("id", F.least("comp", "low").alias("to"), F.col("comp").alias("was"))
        jump = label.select(F.col("id").alias("to"), F.col("comp").alias("far"))
        new = scratch.written(lower.join(jump, "to").select("id", F.least("to", "far").alias("comp"), "was"), "near-label")
        scratch.drop(label)
        label = new.select("id", "comp")
        if new.where("comp <> was").isEmpty():
            return label


def _sets(texts: Callable[[DataFrame], DataFrame], ids: DataFrame, words: int, key: Key) -> DataFrame:
    """id, s (sorted hashes as bytes) for the nodes that ``ids``, a written table, names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([get(batch, "id"), pa.array([s.tobytes() for s in shingle_sets(get(batch, "text"), words, key)], pa.binary())], ["id", "s"])

    with small_batches(ids.sparkSession):
        return scratch.written(texts(ids).mapInArrow(run, "id long, s binary"), "near-sets")


def block_links(sides: np.ndarray, ids: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between different components of a block that join what its whole sets join: at most one less than its rows. Rows of side 0 are compared with those of side 1."""
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    if not len(left) or not len(right):
        return []
    size = np.array([len(s) for s in sets])
    a = np.concatenate([sets[i] for i in left])
    b = np.concatenate([sets[i] for i in right])
    shared = np.intersect1d(a, b)
    rows_a, rows_b = np.repeat(np.arange(len(left)), size[left]), np.repeat(np.arange(len(right)), size[right])
    keep_a, keep_b = np.isin(a, shared), np.isin(b, shared)
    at_a, at_b = np.searchsorted(shared, a[keep_a]), np.searchsorted(shared, b[keep_b])
    rows_a, rows_b = rows_a[keep_a], rows_b[keep_b]
    same = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(shared), 2048):  # counts of shared shingles, some columns at a time
        m = min(2048, len(shared) - lo)
        x, y = np.zeros((len(left), m), np.float32), np.zeros((len(right), m), np.float32)
        own = (at_a >= lo) & (at_a < lo + m)
        x[rows_a[own], at_a[own] - lo] = 1
        own = (at_b >= lo) & (at_b < lo + m)
        y[rows_b[own], at_b[own] - lo] = 1
        same += x @ y.T
    same = np.rint(same).astype(np.int64)
    good = (100 * same >= percent * (size[left][:, None] + size[right][None, :] - same)) & (comps[left][:, None] != comps[right][None, :])
    up: dict[int, int] = {}

    def find(c: int) -> int:
        while up.get(c, c) != c:
            c = up[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(good), strict=True):
        x, y = find(int(comps[left[i]])), find(int(comps[right[j]]))
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((int(ids[left[i]]), int(ids[right[j]])))
    return out


def _between(groups: DataFrame, texts: Callable[[DataFrame], DataFrame], words: int, percent: int, key: Key) -> DataFrame:
    """Links between different components of one list's nodes. groups: lead, id, n, comp, main (of the lead's component).

    Nodes outside the main component are compared with all, in blocks of bounded size, by
    products of matrices; a block gives only the links that join components in it.
    """
    outer, own = ~F.col("main"), F.col("main")
    sizes = groups.groupBy("lead").agg(*[f.alias(c) for f, c in ((F.count_if(outer), "m_out"), (F.sum(F.when(outer, F.col("n"))), "n_out"), (F.count_if(own), "m_in"), (F.sum(F.when(own, F.col("n"))), "n_in"), (F.count(F.lit(1)), "members"))])

    def parts(m: str, n: str):
        return F.greatest(F.ceil(F.coalesce(m, F.lit(0)) / F.lit(BLOCK_ROWS)), F.ceil(F.coalesce(n, F.lit(0)) / F.lit(BLOCK_HASHES)), F.lit(1)).cast("int")

    plan = sizes.where("m_out > 0").select("lead", "members", parts("m_out", "n_out").alias("k_out"), parts("m_in", "n_in").alias("k_in"))
    rows = scratch.written(sums.lookup(groups, scratch.written(plan, "near-plan"), "lead", "members").drop("members"), "near-groups")
    sets = _sets(texts, scratch.written(rows.select("id").distinct(), "near-ids"), words, key)
    h = F.xxhash64("id", "lead")
    own = F.pmod(h, F.when(F.col("main"), F.col("k_in")).otherwise(F.col("k_out"))).cast("int")
    rows = rows.withColumn("own", own)

    def cell(i, j, side: int):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    every_out, every_in = F.sequence(F.lit(0), F.col("k_out") - 1), F.sequence(F.lit(0), F.col("k_in") - 1)
    # cells (i, j): block i of the outer nodes by block j of the outer nodes (j < k_out) or of the main ones
    as_main = F.transform(every_out, lambda i: cell(i, F.col("k_out") + F.col("own"), 1))
    as_left = F.concat(F.transform(F.filter(every_out, lambda j: j >= F.col("own")), lambda j: cell(F.col("own"), j, 0)), F.transform(every_in, lambda j: cell(F.col("own"), F.col("k_out") + j, 0)))
    as_right = F.transform(F.filter(every_out, lambda i: i <= F.col("own")), lambda i: cell(i, F.col("own"), 1))
    placed = rows.withColumn("cell", F.explode(F.when(F.col("main"), as_main).otherwise(F.concat(as_left, as_right))))
    full = placed.select("lead", "id", "comp", "cell.*").join(sets, "id")

    def run(table: pa.Table) -> pa.Table:
        links = block_links(table["side"].to_numpy(), table["id"].to_numpy(), table["comp"].to_numpy(), [np.frombuffer(x.as_buffer(), np.uint64) for x in table["s"]], percent)
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    links = scratch.written(full.groupBy("lead", "i", "j").applyInArrow(run, "a long, b long"), "near-links")
    scratch.drop(sets)
    return links


def linked(texts: Callable[[DataFrame], DataFrame], nodes: DataFrame, words: int, percent: int, key: Key) -> DataFrame:
    """Links between nodes, enough for their components: a, b, each of them confirmed."""
    lists = scratch.written(index(nodes, percent), "near-index")
    # the lead of a list: the node that shares most of its retained values with others, by far the middle one of a group of copies
    rank = F.shiftleft(F.col("shared").cast("long"), 56) + F.shiftrightunsigned(F.xxhash64("id"), 8)
    sizes = lists.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.max_by("id", rank).alias("lead")).where("m > 1")
    rows = scratch.written(lists.join(sizes, "v"), "near-lists")
    scratch.drop(lists)
    short = rows.where(F.col("m") <= SHORT)
    other = short.select("v", F.col("id").alias("b"), F.col("n").alias("nb"))
    near = F.least("n", "nb") * 100 >= F.greatest("n", "nb") * percent
    pairs = short.select("v", F.col("id").alias("a"), "n").join(other, "v").where((F.col("a") < F.col("b")) & near)
    needed = F.least(F.lit(MEET), F.max(F.expr(f"(greatest(n, nb) * {percent} + 99) div 100")))
    pairs = pairs.groupBy("a", "b").agg((F.count(F.lit(1)) >= needed).alias("meets")).where("meets").select("a", "b")
    group = scratch.written(rows.where(F.col("m") > SHORT).select("lead", "id", "n").distinct(), "near-groups")
    star = group.where("id <> lead").select(F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b"))
    first = scratch.written(_estimated(pairs.union(star).distinct(), nodes, percent), "near-pairs")
    scratch.drop(rows)
    links = _confirmed(first, texts, words, percent, key)
    if group.isEmpty():
        return links

    label = components(links)
    placed = group.join(label, "id", "left").select("lead", "id", "n", F.coalesce("comp", "id").alias("comp"))
    leads = group.groupBy("lead").agg(F.count(F.lit(1)).alias("members")).join(label.withColumnRenamed("id", "lead"), "lead", "left")
    leads = scratch.written(leads.select("lead", "members", F.coalesce("comp", "lead").alias("main_comp")), "near-leads")
    placed = sums.lookup(placed, leads, "lead", "members").select("lead", "id", "n", "comp", (F.col("comp") == F.col("main_comp")).alias("main"))
    placed = scratch.written(placed, "near-split")
    if placed.where("not main").isEmpty():
        return links
    return scratch.written(links.union(_between(placed, texts, words, percent, key)), "near-links")


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """For each row of ``docs``: doc_id, n_shingles, component_id, kept. See the module for the cases."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("doc", "text"))
    key = key_of(docs)
    with small_batches(docs.sparkSession):
        all_ = sketches(docs.withColumnRenamed("doc", "id"), words, key).withColumnRenamed("id", "doc")
        all_ = scratch.written(all_.withColumn("id", F.monotonically_increasing_id()), "near-sketches")  # id: the row's number
    some = all_.where("n > 0 and doc is not null")
    classes = scratch.written(some.groupBy("d1", "d2", "n").agg(F.min("id").alias("node"), F.min("doc").alias("first"), F.count(F.lit(1)).alias("m")), "near-classes")
    copies = classes.where("m > 1")
    member = some.select("id", "doc", "d1", "d2", "n").join(copies.select("d1", "d2", "n", "node", "first"), ["d1", "d2", "n"]).select("id", "doc", "node", "first")
    member = scratch.written(member, "near-members")  # row id is one of node, whose smallest doc_id is first
    nodes = chosen(some.select("id", "n", "sketch"), scratch.written(member.where("id <> node").select("id"), "near-copies"), "left_anti")

    links = linked(texts_of(docs, some.select("id", "doc", "h")), nodes, words, percent, key)
    named = some.select(F.col("id").alias("a"), F.col("doc").alias("doc_a")), some.select(F.col("id").alias("b"), F.col("doc").alias("doc_b"))
    between = links.join(named[0], "a").join(named[1], "b").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    edges = scratch.written(between.union(member.select(F.col("first").alias("a"), F.col("doc").alias("b"))).where("a <> b").distinct(), "near-edges")
    label = components(edges)
    out = all_.select(F.col("doc").alias("id"), "n").join(label, "id", "left")
    out = out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("comp", "id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
