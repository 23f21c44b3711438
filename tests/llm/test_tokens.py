import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veilspan.llm import sums, tokens


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 60_000), st.just(7)), min_size=1, max_size=60).map(lambda x: x * 43))
def test_blocks_round_trip(ids):
    flat = np.array(ids, np.uint32)
    starts, data = tokens.pack(flat)
    assert len(starts) == -(-len(flat) // tokens.BLOCK) and (tokens.unpack(data, starts) == flat).all()


def test_exceptions_are_patched():
    flat = np.full(1000, 9, np.uint32)
    flat[[3, 500]] = 2**31
    starts, packed = tokens.pack(flat)
    assert len(packed) < 40 and (tokens.unpack(packed, starts) == flat).all()


TEXTS = ["", "<|endoftext|>", "a<|endoftext|>b", "<|endoftext", "|>", "see <|endoftext|> , <|endoftext|>and. more (text) " * 300, "<|im_start|>x", "a", " a", "a ", "a  b", "a   b", "a \n b", "\n\n x  ", "don't we'll I'd", "tab\tand\x0bmore \x1c odd nbsp 　x", "é😀 ğ  İ", "<|endoftext|> x<|endoftext|>", "1234 5,6.7  8", "x" * 50_000, "the end. " * 9_000, "a  b  c", " \x1f \x85 z"]


def direct(texts):
    t = Tokenizer.from_file(tokens.default_path())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_encoder_gives_the_tokenizers_ids():
    ids, at = tokens.Encoder(tokens.default_path()).encode(pa.array(TEXTS))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == direct(TEXTS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(" \n\t ab'sé.1 \x1c\x85 "), st.characters(codec="utf-8")), max_size=40).map("".join))
def test_encoder_on_any_text(text):
    if not hasattr(test_encoder_on_any_text, "e"):
        test_encoder_on_any_text.e = tokens.Encoder(tokens.default_path())
    e = test_encoder_on_any_text.e
    want = e.tokenizer.encode(text, add_special_tokens=False).ids
    assert e.encode(pa.array([text]))[0].tolist() == want
    # next to each other texts are still encoded alone
    ids, at = e.encode(pa.array([text, "<|endo", "ftext|> x. y", text]))
    assert ids[at[0] : at[1]].tolist() == want == ids[at[3] : at[4]].tolist() and ids[at[1] : at[3]].tolist() == sum(direct(["<|endo", "ftext|> x. y"]), [])


def test_table(spark, make_docs):
    rows = list(enumerate(TEXTS)) + [(90, None), (None, "null id"), (50, "b"), (50, "a")] + [(60, f"t{k}") for k in range(40)]
    docs = make_docs(rows)
    h = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h[r[1]], r[1] or ""))
    table = tokens.write(docs)
    want, at = [], 0
    for (i, _), ids in zip(ordered, direct([t for _, t in ordered]), strict=True):
        ids = [*ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, tokens.read(spark, table).collect()), key=lambda r: r[1]) == want
    seg = max(table.collect(), key=lambda r: len(r.starts))
    flat = tokens.unpack(bytes(seg.data), seg.starts)
    assert (tokens.ids_at(bytes(seg.data), seg.starts, 1500, 3000) == flat[1500:3000]).all()


def test_other_order_and_ends(spark, make_docs):
    docs = make_docs([(9, "one two"), (3, "three"), (3, "four"), (None, None), (7, "five")])
    place = {"one two": (0, 2, False), "three": (0, 10, True), "four": (1, 0, None), "five": (None, 5, False), None: (1, 1, True)}
    extra = spark.createDataFrame([(t, *p) for t, p in place.items()], "t string, shard int, slot int, last boolean")
    table = tokens.write(docs.join(extra, F.col("text").eqNullSafe(F.col("t"))), order=("shard", "slot"), ends="last")
    want, at = [], 0
    for i, text in ((7, "five"), (9, "one two"), (3, "three"), (3, "four"), (None, None)):
        ids = direct([text])[0] + ([] if place[text][2] is False else [0])
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, tokens.read(spark, table).collect()), key=lambda r: r[1]) == want


def test_starts_over_groups_of_shards(spark, monkeypatch):
    monkeypatch.setattr(sums, "GROUP", 3)
    table = spark.createDataFrame([(k, s, [k + 1, s]) for k in range(11) if k != 4 for s in range(2)], "shard int, seq int, counts array<long>")
    n = {k: 2 * k + 3 for k in range(11) if k != 4}
    assert {r.shard: r.before for r in tokens.shard_starts(table).collect()} == {k: sum(v for j, v in n.items() if j < k) for k in n}


def test_empty(spark, make_docs):
    assert tokens.read(spark, tokens.write(make_docs([]))).count() == 0
