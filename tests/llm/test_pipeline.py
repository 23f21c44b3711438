import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.test_near_dedup import brute as near_brute
from veilspan import scratch
from veilspan.llm import decontam, mixing, quality, tokens


@pytest.fixture(scope="module")
def stages(spark):
    sf, out = "/root/testdata/sf0.001", []
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, fn in cp.STAGES:
        got = fn(spark, docs, sf)
        kept = spark.createDataFrame(got.collect(), got.schema)
        out.append((name, docs, kept))
        docs = kept
    return sf, {name: (before, after) for name, before, after in out}


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(stages):
    _, s = stages
    for name, (before, after) in s.items():
        if name == "mixing":
            assert after.columns == [*before.columns, *mixing.PLACE]
        elif name != "tokens":
            assert after.schema == before.schema


def test_quality(spark, stages):
    sf, s = stages
    before, after = s["quality"]
    scores = quality.classify(before, quality.fit(before, spark.read.parquet(f"{sf}/labels.parquet"))).collect()
    assert ids(after) == {r.doc_id for r in scores if r.predicted}
    assert 0 < after.count() < before.count()


def test_near_dedup(stages):
    _, s = stages
    before, after = s["near_dedup"]
    want = {i for i, _, _, kept in near_brute([(r.doc_id, r.text) for r in before.collect()]) if kept}
    assert ids(after) == want and len(want) < before.count()


def test_decontamination(spark, stages):
    sf, s = stages
    before, after = s["decontamination"]
    found = decontam.leaks(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    assert ids(after) == ids(before) - {r.doc_id for r in found} and found


def test_mixing(stages):
    _, s = stages
    before, after = s["mixing"]
    taken = {r.doc_id: r.taken for r in mixing.Mix(before).taken().collect() if r.taken}
    got = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert got == taken


def test_tokens(stages):
    """The files hold the mix: pieces by shard and slot, end ids at the ends of documents only."""
    _, s = stages
    before, after = s["tokens"]
    t = Tokenizer.from_file(tokens.default_path())
    at, want = 0, []
    for r in sorted(before.collect(), key=lambda r: (r.mix_shard, r.mix_slot, r.mix_place)):
        own = t.encode(r.text, add_special_tokens=False).ids + ([0] if r.mix_ends else [])
        want.append((r.doc_id, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    assert sorted(map(tuple, after.collect()), key=lambda r: r[1]) == want


def test_run_leaves_no_tables_of_its_stages(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "root", lambda spark: str(tmp_path))
    out = cp.run(spark, small)
    assert out.count() > 0
    left = {p.name.split("-")[0] for p in tmp_path.iterdir()}
    assert left == {"pipeline", "tokens", "token"}


def test_files_follow_the_mix(spark, small):
    """Read back, the ids of each slot are those of its pieces, and the counts by source of each shard those that were drawn."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    recipe = mixing.Recipe(block=32, shard_slots=128)
    mixed = mixing.mixed_documents(docs, recipe)
    mixed = spark.createDataFrame(mixed.collect(), mixed.schema)
    table = tokens.write(mixed, order=mixing.PLACE[:3], ends="mix_ends")
    flat = [i for r in sorted(table.collect(), key=lambda r: (r.shard, r.seq)) for i in tokens.unpack(bytes(r.data), r.starts).tolist()]
    t = Tokenizer.from_file(tokens.default_path())
    rows, want = sorted(mixed.collect(), key=lambda r: (r.mix_shard, r.mix_slot, r.mix_place)), []
    for r in rows:
        want += t.encode(r.text, add_special_tokens=False).ids + ([0] if r.mix_ends else [])
    assert flat == want and sum(r.mix_ends for r in rows) < len(rows)
    taken = sum(r.taken // r.size for r in mixing.Mix(docs, recipe).taken().where("size > 0").collect())
    assert sum(r.mix_ends for r in rows) >= taken


def test_cases(spark, make_docs, tmp_path):
    """Nulls, empty tables and columns with clashing names go through all stages."""
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in ([], [(1, None), (None, "x"), (2, ""), (2, ""), (3, "long " * 50_000, None, None), (4, "a b c d e f g")]):
        docs = make_docs(rows)
        for c in ("gone", "leak_id", "leak_hash"):
            docs = docs.withColumn(c, docs["lang"])
        for name, fn in cp.STAGES:
            got = fn(spark, docs, str(tmp_path))
            docs = spark.createDataFrame(got.collect(), got.schema)
            if name != "tokens":  # other columns keep their values
                assert all(r[c] == r.lang for r in docs.collect() for c in ("id", "score", "gone", "h", "leak_id", "rank"))
        assert docs.count() == 0 or rows
