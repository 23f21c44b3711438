r"""Alignment of two tokenizers' tokens by the bytes that they cover.

A is a byte-level BPE, B a sentencepiece BPE with byte fallback. Both encode a text with one
space before it, their tokens cover the same bytes, and

1. each byte gets a label: ``n`` (no token ends there), ``a`` or ``b`` (one of A's or of B's
   does) or ``x`` (both do);
2. a regex scan cuts the label string after each ``x``; how many labels of each kind a span
   has says which tokens of A and of B make a group;
3. each labelled byte is a link: it ends the bytes that one token of A and one of B share.

No token of either reaches over the place between something that isn't white space and a
space before more text, so texts are cut there, and each distinct piece is encoded, labelled and
scanned once for a while by a worker; a document is the row of its pieces. Counts of linked
id pairs go to Spark summed over a task's documents, which are bounded by the vocabularies.
The commonest pairs, at most ``MOST_PAIRS`` of them, are then looked up in a sorted list that
each worker has; links of other pairs, which few documents have each, are joined.

Texts go through in windows of about 1 MB that end at such places; a text without any is one
piece, whose size the libraries must bear (some 60 bytes for each of its bytes).

Defined results:

* a null text and an empty one have no tokens; neither has one whose tokens of B don't give its
  bytes back (U+2581 stands for a space there): zeros, and no groups
* strings of special tokens in texts are plain text
* each row is a document: equal rows, and rows with equal or null doc_ids, count one by one
* other columns of the input don't matter, whatever their names; an empty table gives none
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.llm import tokens
from veilspan.llm.arrow import get, release, slices, small_batches, spread

#: Pairs that workers hold (16 bytes each), and pairs that a task sums up before it gives them out.
MOST_PAIRS, PENDING = 2_000_000, 2_000_000
#: Characters of a text that are worked on together; distinct pieces, and bytes of them, that a worker remembers.
WINDOW, REMEMBERED, REMEMBERED_BYTES = 1 << 20, 300_000, 32 << 20
#: A place to cut: a space after something that isn't white space, with more to come.
_CUT = re.compile(r"(?<=\S) (?=.)", re.S)
#: Texts without any of these are cut at each space.
_ODD = re.compile(r"\s |\A | \Z")
_SPAN = re.compile(rb"[nab]*x")
_LABEL = np.frombuffer(b"nabx", np.uint8)
MEASURED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_character() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes bytes as: printable ones as themselves, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def pieces(text: str) -> list[str]:
    """What a text, with a space before it, is encoded in: each piece stands for itself with a space before it."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def windows(text: str) -> Iterator[str]:
    """Parts of a text that end at places to cut."""
    lo = 0
    while (cut := _CUT.search(text, lo + WINDOW)) is not None:
        yield text[lo : cut.start()]
        lo = cut.end()
    yield text[lo:]


class Aligner:
    """Both tokenizers, and what distinct pieces come to."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.b = tokens.Encoder(a_path, plain=True), sentencepiece.SentencePieceProcessor(model_file=b_path)
        as_byte = byte_of_character()
        written = [self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.tokenizer.get_vocab_size())]
        # added tokens, which are never used here, may have other characters
        self.a_bytes = [bytes(as_byte[c] for c in w) if all(c in as_byte for c in w) else w.encode() for w in written]
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.a_said, self.b_said = ([str(i) for i in range(len(t))] for t in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        #: For each piece: whether its bytes come back, tokens of A and B, groups, links, and where its links begin.
        self.rows = np.zeros((0, 6), np.int64)
        self.links = np.zeros(0, np.int64)
        self.groups: list[str] = []

    def ids_of_a(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and how many each has."""
        self.a.learn(raw)
        place = np.array([self.a.known[p] for p in raw], np.int64)
        start, size = np.frombuffer(self.a.starts, np.int64)[place], np.frombuffer(self.a.sizes, np.int32)[place].astype(np.int64)
        ids = self.a.pool[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())].astype(np.int64)
        self.a.forget()
        return ids, size

    def ids_of_b(self, new: list[str], raw: list[bytes]) -> tuple[list[int], list[int]]:
        """The same for B. Many pieces are encoded in a row, where that gives their bytes back and ends tokens with them."""
        ids, sizes = [], []
        for lo in range(0, len(new), 64):
            some, row = new[lo : lo + 64], b"".join(raw[lo : lo + 64])
            together = self.b.encode(" ".join(some))
            upto = np.cumsum(self.b_size[together]) if together else np.zeros(0, np.int64)
            ends = np.cumsum([len(p) for p in raw[lo : lo + 64]])
            last = np.searchsorted(upto, ends)
            apart = all(p and not p[0].isspace() and not p[-1].isspace() for p in some)
            if apart and len(upto) and upto[-1] == ends[-1] and (upto[last] == ends).all() and b"".join(map(self.b_bytes.__getitem__, together)) == row:
                ids += together
                sizes += np.diff(last + 1, prepend=0).tolist()
            else:
                for own in self.b.encode(some):
                    ids += own
                    sizes.append(len(own))
        return ids, sizes

    def learn(self, new: list[str]) -> None:
        """Encode, label and scan pieces."""
        raw = [b" " + p.encode() for p in new]
        a, n_a = self.ids_of_a(raw)
        b, n_b = self.ids_of_b(new, raw)
        b, n_b = np.array(b, np.int64), np.array(n_b, np.int64)
        good, at_a, at_b = [], 0, 0
        for p, x, y in zip(raw, n_a.tolist(), n_b.tolist(), strict=True):
            good.append(b"".join(map(self.a_bytes.__getitem__, a[at_a : at_a + x].tolist())) == p == b"".join(map(self.b_bytes.__getitem__, b[at_b : at_b + y].tolist())))
            at_a, at_b = at_a + x, at_b + y
        good = np.array(good, bool)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        rows = np.zeros((len(new), 6), np.int64)
        rows[:, 0], rows[good, 1], rows[good, 2] = good, n_a[good], n_b[good]
        groups = [""] * len(new)
        links = np.zeros(0, np.int64)
        if len(a):
            size = np.array([len(p) for p in raw])[good]
            end_a, end_b, ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(size)
            label = np.zeros(ends[-1], np.uint8)
            label[end_a - 1] += 1
            label[end_b - 1] += 2
            said, cuts = self.scanned(_LABEL[label].tobytes(), a.tolist(), b.tolist())
            upto = np.searchsorted(cuts, ends, "right")
            rows[good, 3] = np.diff(upto, prepend=0)
            for k, x, y in zip(np.flatnonzero(good).tolist(), [0, *upto.tolist()], upto.tolist(), strict=False):
                groups[k] = ";".join(said[x:y])
            byte = np.flatnonzero(label)
            links = a[np.searchsorted(end_a - 1, byte)] * len(self.b_bytes) + b[np.searchsorted(end_b - 1, byte)]
            rows[good, 4] = np.diff(np.searchsorted(byte, ends), prepend=0)
        rows[:, 5] = len(self.links) + np.cumsum(rows[:, 4]) - rows[:, 4]
        self.links = np.concatenate([self.links, links])
        self.known.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.rows = np.concatenate([self.rows, rows])
        self.groups += groups
        self.held += sum(map(len, raw))

    def scanned(self, labels: bytes, a: list[int], b: list[int]) -> tuple[list[str], list[int]]:
        """The groups as text, and where they end."""
        said, cuts, at_a, at_b = [], [], 0, 0
        names_a, names_b = [self.a_said[i] for i in a], [self.b_said[i] for i in b]
        for m in _SPAN.finditer(labels):
            lo, hi = m.span()
            if hi - lo == 1:
                n_a = n_b = 1
            else:
                n_a, n_b = labels.count(b"a", lo, hi) + 1, labels.count(b"b", lo, hi) + 1
            said.append(f"{','.join(names_a[at_a : at_a + n_a])}|{','.join(names_b[at_b : at_b + n_b])}")
            cuts.append(hi)
            at_a, at_b = at_a + n_a, at_b + n_b
        return said, cuts

    def measure(self, texts: list[str]) -> Iterator[tuple[bool, np.ndarray, str, np.ndarray, np.ndarray]]:
        """For each text: whether its bytes come back, numbers (tokens of A and B, groups, links), groups, and its distinct links and how often it has them."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.forget()
        parts, at = [], [0]
        for t in texts:
            parts += pieces(t)
            at.append(len(parts))
        own = [self.known.get(p, -1) for p in parts]
        if -1 in own:
            new = list(dict.fromkeys(p for p, k in zip(parts, own, strict=True) if k < 0))
            for lo in range(0, len(new), 20_000):
                self.learn(new[lo : lo + 20_000])
            own = [self.known[p] for p in parts]
        del parts
        rows = self.rows[np.array(own, np.int64)]
        sums = np.zeros((len(own) + 1, 5), np.int64)
        np.cumsum(rows[:, :5], axis=0, out=sums[1:])
        sums = np.diff(sums[at], axis=0)
        size = rows[:, 4]
        flat = self.links[np.repeat(rows[:, 5] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        all_pairs = len(self.a_bytes) * len(self.b_bytes)
        key, times = np.unique(np.repeat(np.arange(len(texts)), sums[:, 4]) * all_pairs + flat, return_counts=True)
        cut = np.searchsorted(key, np.arange(len(texts) + 1) * all_pairs)
        for k in range(len(texts)):
            lo, hi = at[k], at[k + 1]
            yield sums[k, 0] == hi - lo, sums[k, 1:], ";".join(map(self.groups.__getitem__, own[lo:hi])), key[cut[k] : cut[k + 1]] - k * all_pairs, times[cut[k] : cut[k + 1]]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each worker."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their times."""
    if len(keys) == 1:
        return keys[0], times[0]
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate(times), len(key)).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Numbers below 2**32, their bytes dealt out by place, as they are then more alike."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def measured(docs: DataFrame, a_path: str, b_path: str, groups: bool = False) -> DataFrame:
    """For each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 (empty without tokens), its distinct links and how often it has them, packed; with ``groups`` also its groups (``a1,a2|b1;a3|b2,b3``)."""

    def one(own: Aligner, text: str):
        """A text of several windows."""
        good, numbers, said, keys, times, first = True, np.zeros(4, np.int64), hashlib.sha256(), [], [], True
        for part in windows(text):
            ((ok, n, g, k, t),) = own.measure([part])
            good, numbers = good and ok, numbers + n
            said.update(("" if first else ";").encode() + g.encode())
            keys, times = (list(x) for x in zip(summed([*keys, k], [*times, t]), strict=True))
            first = False
        return good, numbers, said.hexdigest(), keys[0], times[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in slices(batches, "text"):
            texts = get(batch, "text").to_pylist()
            if len(texts) == 1 and len(texts[0]) > 2 * WINDOW and not groups:
                found = [one(own, texts[0])]
            else:
                found = [(ok, n, g if groups else hashlib.sha256(g.encode()).hexdigest(), k, t) for ok, n, g, k, t in own.measure(texts)]
            out = []
            for text, (ok, n, g, key, times) in zip(texts, found, strict=True):
                if not text or not ok:
                    n, g, key, times = np.zeros(4, np.int64), "", key[:0], times[:0]
                out.append((*n.tolist(), g, packed(np.diff(key, prepend=0)), packed(times)))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([get(batch, "doc_id"), *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups" if groups else "groups_sha256", "pairs", "times"])
        own.forget()  # the worker goes on to other tasks
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return spread(rows).mapInArrow(run, MEASURED.replace("groups_sha256", "groups") if groups else MEASURED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """key, n: how many rows have each link. What tasks give out is summed up before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, waiting = [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(times[0])], ["key", "n"])

        for batch in batches:
            for data in get(batch, "pairs"):
                key = np.cumsum(unpacked(data.as_buffer()))
                if len(key):
                    keys.append(key)
                    times.append(np.ones(len(key), np.int64))
                    waiting += len(key)
                if waiting > PENDING:
                    keys, times = ([x] for x in summed(keys, times))
                    waiting = len(keys[0])
                    if waiting > PENDING // 2:
                        yield out()
                        keys, times, waiting = [], [], 0
        if keys:
            keys, times = ([x] for x in summed(keys, times))
            yield out()
        del keys, times
        release()

    return rows.select("pairs").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """For each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is in as many documents as any pair of its A id), count_sum (those numbers, over all links), groups_sha256. See the module for the cases."""
    spark = docs.sparkSession
    paths = a_path or default_paths()[0], b_path or default_paths()[1]
    sizes = Aligner(*paths)
    all_b = len(sizes.b_bytes)
    if len(sizes.a_bytes) * all_b >= 1 << 32:
        raise ValueError("ids of a pair don't fit 32 bits")
    with small_batches(spark):
        rows = scratch.written(measured(docs, *paths).withColumn("row", F.monotonically_increasing_id()), "align-rows", compression="zstd")
        counts = scratch.written(pair_counts(rows).withColumn("a", F.expr(f"key div {all_b}")), "align-counts")
        # a row for each id of A at most, and 64 of the powers of two
        best = counts.groupBy("a").agg(F.max("n").alias("best"))
        top = np.zeros(len(sizes.a_bytes), np.int64)
        for r in best.collect():
            top[r["a"]] = r["best"]
        powers = sorted(((r["p"], r["m"]) for r in counts.groupBy(F.floor(F.log2("n")).alias("p")).agg(F.count(F.lit(1)).alias("m")).collect()), reverse=True)
        least, many, whole = 1 << 62, 0, True
        for p, m in powers:
            if many + m > MOST_PAIRS:
                whole = False
                break
            least, many = 1 << p, many + m
        held = counts.where(F.col("n") >= least).select("key", "n").toArrow()  # at most MOST_PAIRS
        key, n = (held.column(c).to_numpy() for c in ("key", "n"))
        order = np.argsort(key)
        table = spark.sparkContext.broadcast((key[order], n[order], top))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, number, most = table.value
            for batch in batches:
                out = []
                for pairs, often in zip(get(batch, "pairs"), get(batch, "times"), strict=True):
                    key, times = np.cumsum(unpacked(pairs.as_buffer())), unpacked(often.as_buffer())
                    at = np.searchsorted(known, key)
                    found = np.zeros(len(key), bool)
                    inside = at < len(known)
                    found[inside] = known[at[inside]] == key[inside]
                    n = number[at[found]]
                    out.append((int(times[found][n == most[key[found] // all_b]].sum()), int((times[found] * n).sum()), key[~found], times[~found]))
                same = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([*[get(batch, c) for c in same], *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], [*same, "n_best", "count_sum", "keys", "often"])

        found = scratch.written(rows.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, keys array<long>, often array<long>"), "align-found")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if whole:
        return found.select(out)
    # what workers don't hold: pairs in fewer than ``least`` documents, so that no key has many rows
    rare = counts.where(F.col("n") < least).join(F.broadcast(best.withColumnRenamed("a", "id_a")), F.col("a") == F.col("id_a")).select("key", "n", (F.col("n") == F.col("best")).alias("is_best"))
    links = found.select("row", F.explode(F.arrays_zip("keys", "often")).alias("l")).select("row", F.col("l.keys").alias("key"), F.col("l.often").alias("times"))
    more = links.join(rare, "key").groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("more_sum"), F.sum(F.when(F.col("is_best"), F.col("times"))).alias("more_best"))
    all_ = found.drop("keys", "often").join(more, "row", "left")
    return all_.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).select(out)
