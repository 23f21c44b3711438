import random
import re

import pytest
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.llm import mixing, sums
from veilspan.llm.mixing import Mix, Recipe, mixed_documents


def targets(sizes, recipe):
    """By weight, at most max_epochs times the size; what is over goes to the others, again and again."""
    weight = [recipe.weights[i % len(recipe.weights)] for i in range(len(sizes))]
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), recipe.share * sum(sizes)
    while free:
        unit = left / sum(weight[i] for i in free)
        over = {i for i in free if weight[i] * unit > recipe.max_epochs * sizes[i]}
        for i in over or free:
            out[i] = recipe.max_epochs * sizes[i] if over else weight[i] * unit
        left -= sum(out[i] for i in over)
        free = free - over if over else set()
    return out


@pytest.mark.parametrize("sizes", [[100, 1000, 10], [0, 0], [5], [0, 7, 3], [10**9, 1, 1, 1, 50, 10**6], list(range(1, 400))])
def test_targets_reshare_the_excess(spark, sizes):
    table = spark.createDataFrame(list(enumerate(sizes)), "rank long, size long")
    got = {r.rank: r.target for r in mixing.with_targets(table, Recipe()).collect()}
    assert [got[k] for k in range(len(sizes))] == pytest.approx(targets(sizes, Recipe()))


def test_sums_and_numbers(spark, monkeypatch):
    monkeypatch.setattr(sums, "GROUP", 3)
    rng = random.Random(5)
    rows = [(k, i, rng.randrange(9)) for k in range(3) for i in range(20) if rng.random() < 0.7]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    want = {(k, i): sum(x for a, b, x in rows if a == k and b < i) for k, i, _ in rows}
    assert {(r.k, r.i): r.o for r in sums.before(df, ["k"], "i", "v", "o").collect()} == want
    names = [None, "", "a", "B", "é", "😀", "\uffff", "z" * 50, *[f"n{i}" for i in range(300)]]
    got = {r.s: r.o for r in sums.numbered(spark.createDataFrame([(n,) for n in names], "s string"), [F.col("s").asc_nulls_last()], "o").collect()}
    assert sorted(got, key=got.get) == sorted(names, key=lambda n: (n is None, [ord(c) for c in n or ""]))
    assert sorted(got.values()) == list(range(len(names)))


@pytest.mark.parametrize("most", [200_000, 0])
def test_lookup(spark, monkeypatch, most):
    monkeypatch.setattr(sums, "MOST_ROWS", most)
    monkeypatch.setattr(sums, "HOT_SHARE", 0.2)
    rows = spark.createDataFrame([("hot" if i % 2 else None if i % 3 else f"s{i}", i) for i in range(200)], "s string, i int")
    table = rows.groupBy("s").agg(F.count("*").alias("n")).withColumn("mark", F.concat(F.lit("m"), F.coalesce("s", F.lit("null"))))
    out = sums.lookup(rows, table, "s", "n").collect()
    assert sorted(r.i for r in out) == list(range(200)) and all(r.mark == "m" + (r.s or "null") for r in out)


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        out = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3))).collect()]
        assert sorted(out) == list(range(n))
        if n == 1000:
            assert sum(a == b for a, b in enumerate(out)) < 20


@pytest.mark.parametrize("quota", [[10, 0, 5000, 33], [3], [], [1] * 500, [2, 9000] * 3])
def test_draws_give_the_quotas(spark, quota):
    table = scratch.written(spark.createDataFrame(list(enumerate(quota)), "sid long, quota long"), "q")
    plan = [tuple(r) for r in mixing.draws(table, Recipe(shard_slots=100)).select("shard", "sid", "first", "n").collect()]
    for s, q in enumerate(quota):
        own = sorted((f, n) for _, x, f, n in plan if x == s)
        assert sum(n for _, n in own) == q
        assert all(f == sum(n for _, n in own[:k]) for k, (f, n) in enumerate(own))
    shards = {}
    for k, _, _, n in plan:
        shards[k] = shards.get(k, 0) + n
    assert all(n <= 100 for n in shards.values())


def test_counts_of_shards_are_multinomial(spark):
    """Chi-squared of the full shards' counts against the quotas' shares: near its degrees of freedom, neither far above (another share) nor below (no chance)."""
    quota = [50_000, 30_000, 20_000]
    table = scratch.written(spark.createDataFrame(list(enumerate(quota)), "sid long, quota long"), "q")
    plan = mixing.draws(table, Recipe(shard_slots=500)).where("shard < 150").collect()
    assert sum(r.n for r in plan) == 75_000
    chi = sum((r.n - 500 * quota[r.sid] / 100_000) ** 2 / (500 * quota[r.sid] / 100_000) for r in plan)
    assert 200 < chi < 420  # 300 degrees of freedom, standard deviation 24.5


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = Mix(docs).taken().collect()
    again = Mix(docs.repartition(7)).taken().collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    src = {r.doc_id: (r.source, r.text) for r in docs.collect()}
    totals, taken, want = {}, {}, {}
    for r in out:
        s, text = src[r.doc_id]
        assert r.size == len(words(text)) and 0 <= r.taken <= 2 * r.size
        totals[s] = totals.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        want[s] = (r.source_size, r.target)
    names = sorted(totals)
    for s, t in zip(names, targets([totals[s] for s in names], Recipe()), strict=True):
        assert want[s] == (totals[s], pytest.approx(t))
        assert abs(taken[s] - t) <= max(2, 0.01 * t)


def test_pieces_are_the_words_taken(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    taken = {r.doc_id: r.taken for r in Mix(docs).taken().collect()}
    src = {r.doc_id: r for r in docs.collect()}
    got = {}
    mixed = mixed_documents(docs).collect()
    for r in mixed:
        assert r.text in src[r.doc_id].text and r.source == src[r.doc_id].source and r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
    assert got == {i: n for i, n in taken.items() if n}
    # the pieces of a slot follow each other without a gap, and only the last words of a document end it
    slots = {}
    for r in sorted(mixed, key=lambda r: (r.mix_shard, r.mix_slot, r.mix_place)):
        assert r.mix_place == slots.get((r.mix_shard, r.mix_slot), 0)
        slots[r.mix_shard, r.mix_slot] = r.mix_place + len(words(r.text))
        whole = words(src[r.doc_id].text)
        assert not r.mix_ends or whole[-len(words(r.text)) :] == words(r.text)
    assert max(slots.values()) == 256
    full = {i for i, n in taken.items() if n and n % len(words(src[i].text)) == 0}
    assert {r.doc_id for r in mixed if r.mix_ends} >= full


def test_shards_hold_the_counts_that_were_drawn(spark, small):
    docs, recipe = spark.read.parquet(f"{small}/documents.parquet"), Recipe(block=16, shard_slots=64)
    mix = Mix(docs, recipe)
    drawn = {(r.shard, r.sid): r.n for r in mix.slots.groupBy("shard", "sid").agg(F.count("*").alias("n")).collect()}
    names = sorted({r.source for r in docs.select("source").distinct().collect()})
    got = {}
    for r in mixed_documents(docs, recipe).select("mix_shard", "mix_slot", "source").distinct().collect():
        got[r.mix_shard, names.index(r.source)] = got.get((r.mix_shard, names.index(r.source)), 0) + 1
    assert got == drawn and len({k for k, _ in got}) > 10 and len({s for _, s in got}) == len(names)


def test_many_sources(make_docs, monkeypatch):
    monkeypatch.setattr(sums, "MOST_ROWS", 50)
    docs = make_docs([(i, f"a{i} " * (1 + i % 5), "en", f"s{i % 3000:05d}" if i % 2 else "hot") for i in range(4000)], clash=False)
    out = Mix(docs).taken().collect()
    src = {r.doc_id: r.source for r in docs.collect()}
    sizes, got, want = {}, {}, {}
    for r in out:
        s = src[r.doc_id]
        sizes[s], got[s], want[s] = sizes.get(s, 0) + r.size, got.get(s, 0) + r.taken, r.target
    names = sorted(sizes)
    assert [want[s] for s in names] == pytest.approx(targets([sizes[s] for s in names], Recipe()))
    assert all(abs(got[s] - want[s]) <= 0.5 for s in names) and len(names) > 1400


def test_other_columns_are_kept(make_docs):
    docs = make_docs([(i, f"t{i} x y", "en", "ab"[i % 2]) for i in range(20)]).withColumn("mix_slot", F.lit("mine")).withColumn("row", F.col("doc_id") * 7)
    out = mixed_documents(docs)
    assert out.columns == [c for c in docs.columns if c != "mix_slot"] + list(mixing.PLACE)
    assert all(r.row == 7 * r.doc_id and r.rank == r.lang == "en" for r in out.collect())


def test_blocks_of_small_sources_are_as_long(make_docs):
    size = {"a": 5000, "b": 300, "c": 700, "d": 256, "e": 3}
    docs = make_docs([(k, " ".join(f"{s}{i}" for i in range(n)), "en", s) for k, (s, n) in enumerate(size.items())], clash=False)
    want = {s: round(t) for s, t in zip(size, targets(list(size.values()), Recipe()), strict=True)}
    got = {s: [] for s in size}
    for r in mixed_documents(docs).collect():
        own = words(r.text)
        assert own == [f"{r.source}{i}" for i in range(int(own[0][1:]), int(own[0][1:]) + len(own))]
        got[r.source].append(len(own))
    assert {s: sum(n) for s, n in got.items()} == want
    for s, n in got.items():  # all pieces but the last of each pass, and of the mix, are whole blocks
        assert sum(x < 256 for x in n) <= 3 and max(n) == min(256, size[s])
    assert {r.source: r.taken for r in Mix(docs).taken().join(docs.select("doc_id", "source"), "doc_id").collect()} == want


def test_cases(make_docs):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n ", "en", "b"), (4, " x\ty ", "en", None), (None, "p q r", "en", "b"), (5, "same", "en", "b"), (5, "same", "en", "b"), (6, "w " * 30_000, "en", "c")]
    out = Mix(make_docs(rows)).taken().collect()
    assert len(out) == len(rows)
    assert sorted(r.size for r in out) == sorted(len(words(r[1])) for r in rows)
    assert all(r.taken <= 2 * r.size for r in out)


def test_empty(make_docs):
    assert Mix(make_docs([])).taken().count() == 0
