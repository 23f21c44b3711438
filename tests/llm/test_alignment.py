import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veilspan.llm import alignment as al


@pytest.fixture(scope="module")
def plainly():
    """Ids and byte ends of a whole text by each library, without pieces, labels or scans."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    as_byte = al.byte_of_character()

    def run(text):
        if not text:
            return [], [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(as_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return [], [], [], []

        def ends(parts):
            out, at = [], 0
            for p in parts:
                at += len(p)
                out.append(at)
            return out

        return ids_a, ids_b, ends(bytes_a), ends(bytes_b)

    return run


def aligned(ids_a, ids_b, ends_a, ends_b):
    groups, links, at_a, at_b = [], [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        a, b = ends_a.index(cut, at_a) + 1, ends_b.index(cut, at_b) + 1
        groups.append(f"{','.join(map(str, ids_a[at_a:a]))}|{','.join(map(str, ids_b[at_b:b]))}")
        at_a, at_b = a, b
    starts_a, starts_b = ([0, *e][: len(e)] for e in (ends_a, ends_b))
    first = 0
    for x, s, e in zip(ids_a, starts_a, ends_a, strict=True):
        while first < len(ids_b) and ends_b[first] <= s:
            first += 1
        k = first
        while k < len(ids_b) and starts_b[k] < e:
            links.append((x, ids_b[k]))
            k += 1
    return groups, links


def brute(rows, plainly):
    docs = [(i, *plainly(t)) for i, t in rows]
    found = [(i, len(a), len(b), *aligned(a, b, x, y)) for i, a, b, x, y in docs]
    held = Counter(p for r in found for p in set(r[4]))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return sorted([(i, a, b, len(g), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, a, b, g, links in found], key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()], key=str)


ROWS = [
    (1, None), (2, ""), (3, " "), (4, "  two before, one after "), (5, "plain words of a text, plain words"), (5, "plain words of a text, plain words"),
    (None, "tab\there\nand  double  spaces   here\r\n \n x"), (7, "<|endoftext|> and <s> </s> <0x0A> <unk> [PAD]"), (8, "has ▁ in it"), (9, "▁"),
    (10, "Größe naïve   x y　 z \x1c w\x85 v"), (11, "日本語のテキスト and 中文 😀 👩‍👩‍👧 é"), (12, "\x00 nul \x7f ﻿ bom"), (13, "x" * 5000), (14, "a b " * 3000), (15, " lead"), (16, "trail "), (17, "\n"), (18, "don't we'll I'M 12345 3.14 $5.00!!"),
]


@pytest.mark.parametrize("most", [2_000_000, 40, 0])
def test_cases(make_docs, plainly, monkeypatch, most):
    """Counts come from what workers hold, from both, and from the join alone."""
    monkeypatch.setattr(al, "MOST_PAIRS", most)
    assert got(al.alignment(make_docs(ROWS))) == brute(ROWS, plainly)


def test_empty(make_docs):
    assert al.alignment(make_docs([])).count() == 0


def test_whole_table(spark, small, plainly):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert got(al.alignment(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()], plainly)


_own = []


def own():
    if not _own:
        _own.append(al.Aligner(*al.default_paths()))
    return _own[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=" \n\tab.'  é日▁", max_size=12), st.text(max_size=8)), min_size=1, max_size=4))
def test_pieces_give_what_whole_texts_give(plainly, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for text, (ok, n, said, keys, times) in zip(texts, own().measure(texts), strict=True):
        a, b, x, y = plainly(text)
        if not text or not a:
            assert not ok or not text
            continue
        groups, links = aligned(a, b, x, y)
        assert ok and n.tolist() == [len(a), len(b), len(groups), len(links)] and said == ";".join(groups)
        assert {(k // len(own().b_bytes), k % len(own().b_bytes)): t for k, t in zip(keys.tolist(), times.tolist(), strict=True)} == Counter(links)


def test_windows(make_docs, plainly, monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdeé\n .") for _ in range(rng.randrange(9))) for _ in range(2000))
    assert " ".join(al.windows(text)) == text
    want = brute([(1, text), (2, "a b")], plainly)
    al._aligners.clear()
    monkeypatch.setattr(al, "WINDOW", 500)
    parts = list(al.windows(text))
    assert " ".join(parts) == text and len(parts) > 10
    assert len(al.pieces(text)) == sum(len(al.pieces(p)) for p in parts)
    del want


def test_a_text_of_many_windows(make_docs, plainly):
    rng = random.Random(2)
    words = [f"w{rng.randrange(300)}" for _ in range(600_000)]
    rows = [(1, " ".join(words)), (2, "w1 w2 w3")]
    out = got(al.alignment(make_docs(rows)))
    a, b, x, y = plainly(rows[0][1])
    cuts = sorted(set(x) & set(y))
    assert out[0][1:5] == (len(a), len(b), len(cuts), len(a) + len(b) - len(cuts))


def test_groups_are_given_as_text(make_docs, plainly):
    rows = al.measured(make_docs(ROWS), *al.default_paths(), groups=True).select("doc_id", "groups").collect()
    want = [(i, ";".join(aligned(*plainly(t))[0])) for i, t in ROWS]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
