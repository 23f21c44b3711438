"""Harvest of terms against a plain count, and a store that keeps versions."""

import math
import random
import re

import pytest

from veilspan.operators import terms
from veilspan.sources.glossary import GlossaryStore


def plain(rows, least=3, ratio=10.83):
    found = [(set(re.findall(r"(?<![\w\[])[A-Z][a-z]{3,}(?![\w\]])", x)), set(re.findall(r"(?<![\w\[])[A-Z][a-z]{3,}(?![\w\]])", y))) for _, x, y in rows]
    n, a, b, both = len(rows), {}, {}, {}
    for x, y in found:
        for t in x:
            a[t] = a.get(t, 0) + 1
        for t in y:
            b[t] = b.get(t, 0) + 1
        for s in x:
            for t in y:
                both[s, t] = both.get((s, t), 0) + 1
    scored = {}
    for (s, t), k in both.items():
        ra, cb = a[s], b[t]
        cells = [(k, ra, cb), (ra - k, ra, n - cb), (cb - k, n - ra, cb), (n - ra - cb + k, n - ra, n - cb)]
        v = round(2 * sum(o * math.log(o * n / (r * c)) for o, r, c in cells if o), 6)
        if k >= least and k * n > ra * cb and v >= ratio:
            scored[s, t] = (v, k)
    of_s = {s: min((t for x, t in scored if x == s), key=lambda t: (-scored[s, t][0], -scored[s, t][1], t)) for s, _ in scored}
    of_t = {t: min((s for s, x in scored if x == t), key=lambda s: (-scored[s, t][0], -scored[s, t][1], s)) for _, t in scored}
    return {(s, t) for s, t in scored if of_s[s] == t and of_t[t] == s}


def test_harvest(spark):
    rng = random.Random(8)
    words = {f"Term{chr(97 + i)}": f"Wort{chr(97 + i)}" for i in range(20)}
    rows = []
    for i in range(400):
        some = rng.sample(sorted(words), rng.randrange(1, 5))
        said = [words[w] for w in some if rng.random() < 0.9]
        rows.append((i, "The " + " and ".join(some) + " met [PERSON_1] Abc", " und ".join(said) + (" Immer da" if rng.random() < 0.8 else "")))
    df = spark.createDataFrame(rows, "id int, original string, translated string")
    got = {(r.term, r.translation) for r in terms.harvested(df, ["id"]).collect()}
    assert got == plain(rows)
    assert got == set(words.items())
    assert terms.harvested(df.where("id < 0"), ["id"]).count() == 0


def content(store, version=None):
    return {r.fold: (r.translation, r.verified) for r in store.read(version).collect()}


def test_versions_batches_and_verified_rows(spark, tmp_path):
    store = GlossaryStore(spark, f"{tmp_path}/glossary")
    assert store.latest() == 0 and store.read().count() == 0
    first = spark.createDataFrame([("Court", "Mahkeme"), ("Order", "Karar")], "term string, translation string")
    assert store.upsert(first, "q", 0) == 1
    assert store.verify(spark.createDataFrame([("court", "Mahkeme (resmi)")], "fold string, translation string")) == 2
    again = spark.createDataFrame([("COURT", "other"), ("order", "Emir"), ("Seal", "Mühür")], "term string, translation string")
    assert store.upsert(again, "q", 1) == 3
    want = {"court": ("Mahkeme (resmi)", True), "order": ("Emir", False), "seal": ("Mühür", False)}
    assert content(store) == want
    # the same batches again, also by a store that is opened anew
    assert store.upsert(again, "q", 1) == 3 and GlossaryStore(spark, f"{tmp_path}/glossary").upsert(first, "q", 0) == 3
    assert content(store) == want and store.versions() == [1, 2, 3]
    assert store.upsert(first.limit(0), "other writer", 0) == 4 and content(store) == want
    assert content(store, 1) == {"court": ("Mahkeme", False), "order": ("Karar", False)}


def test_a_writer_that_comes_second_goes_on_from_the_first(spark, tmp_path, monkeypatch):
    a, b = (GlossaryStore(spark, f"{tmp_path}/glossary") for _ in "ab")
    x, y = (spark.createDataFrame([(t, t.lower())], "term string, translation string") for t in ("Xxxx", "Yyyy"))
    real, done = a.latest, []

    def stale():
        if not done:
            done.append(b.upsert(y, "b", 0))
            return 0
        return real()

    monkeypatch.setattr(a, "latest", stale)
    assert a.upsert(x, "a", 0) == 2
    assert content(b) == {"xxxx": ("xxxx", False), "yyyy": ("yyyy", False)}
    assert len(list((tmp_path / "glossary/data").iterdir())) == 2


def test_a_failed_write_changes_nothing(spark, tmp_path, monkeypatch):
    store = GlossaryStore(spark, f"{tmp_path}/glossary")
    df = spark.createDataFrame([("Court", "Mahkeme")], "term string, translation string")
    store.upsert(df, "q", 0)
    monkeypatch.setattr(store, "_committed", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        store.upsert(df.selectExpr("'Other' AS term", "translation"), "q", 1)
    monkeypatch.undo()
    assert content(store) == {"court": ("Mahkeme", False)} and store.upsert(df, "q", 1) == 2


def test_a_stream_writes_to_it(spark, tmp_path):
    store = GlossaryStore(spark, f"{tmp_path}/glossary")
    for part in ([("Court", "a")], [("Order", "b"), ("Court", "c")]):
        spark.createDataFrame(part, "term string, translation string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema("term string, translation string").parquet(f"{tmp_path}/in")
        source.writeStream.foreachBatch(store.sink("harvest")).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert content(store) == {"court": ("c", False), "order": ("b", False)}
    store.sink("harvest")(spark.createDataFrame([("Court", "late")], "term string, translation string"), 1)
    assert content(store)["court"] == ("c", False)
