"""Token-ID output: patched frame-of-reference files.

File format. A token table is a Parquet folder whose rows are segments; a segment holds
whole rows of documents, in ascending order over the table (shard, then seq):

* ``shard``, ``seq``: place of the segment; ``first``: ids of the shard before it
* ``doc_ids``, ``counts``: its documents and their numbers of ids (end id included)
* ``starts``: byte offset of each block in ``data``, an index for random access
* ``data``: the blocks of ``BLOCK`` ids one after the other (the last may be shorter)

A block is a header (uint32 minimum, uint16 ids, uint8 width, uint16 exceptions), the
ids less the minimum, low ``width`` bits each, packed from the lowest bit on and padded
to a byte, then the exceptions: uint16 places and uint32 whole differences of those that
don't fit ``width``. The width is that of the ``PERCENTILE``th percentile of the block's
differences, or of their maximum where that takes fewer bytes.

Encoding splits a text where no token of a byte-level BPE can reach over, and encodes each
distinct part once for a while; the ids are those that the library gives for the whole text
by its plain call. Rows are dealt out by range of their order, also within one doc_id, so
that no id is one task's work.

Defined results:

* a null text is empty: its only id is the end id
* rows come in the order of doc_id, a null one first; with equal doc_ids in the order of the
  xxhash64 of their texts, then of the texts
* ``order`` names other columns to order by; ``ends`` a boolean column that says after which
  rows an end id comes: a row without one goes on into the next
* strings of added tokens in a text are those tokens, as the library has it
* an empty table gives an empty token table
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.llm import sums
from veilspan.llm.arrow import get, release, slices, small_batches, text_bytes
from veilspan.llm.near_dedup import powers

BLOCK, PERCENTILE, SEGMENT_IDS, END_ID = 1024, 98.0, 1 << 17, 0
#: Text bytes for each shard, and distinct parts that a worker remembers.
SHARD_BYTES, REMEMBERED = 24 << 20, 400_000
#: Most shards whose starts are broadcast (12 bytes each).
MOST_BROADCAST = 1_000_000
HEADER = struct.Struct("<IHBH")
SCHEMA = "shard int, seq int, first long, doc_ids array<long>, counts array<long>, starts array<int>, data binary"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLANK = frozenset(b"\t\n\x0b\x0c\r ")
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?|*#%&$\"()[]")] = True
#: First bytes of other white space: texts with any are encoded whole.
_ODD = np.zeros(256, bool)
_ODD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts. Distinct parts are encoded by the library once, until too many are remembered. ``plain``: strings of added tokens are plain text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        # texts that hold an added token are encoded whole
        self.special = [] if plain else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a byte-level token has a character for each of its bytes
        size = self.tokenizer.get_vocab_size()
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts, self.sizes, self.pool, self.used = array("q"), array("i"), np.zeros(1 << 20, np.uint32), 0

    def remember(self, parts: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.known.update(zip(parts, range(len(self.starts), len(self.starts) + len(parts)), strict=True))
        self.starts.frombytes((self.used + np.cumsum(sizes) - sizes).astype(np.int64).tobytes())
        self.sizes.frombytes(sizes.astype(np.int32).tobytes())
        self.used += len(ids)

    def learn(self, parts: list[bytes]) -> None:
        """Parts that begin with white space and end with something else are encoded many in a row, as no token reaches over; how many ids are whose follows from the ids' lengths in bytes."""
        lone, row = [], []
        for p in parts:
            # white space that isn't ASCII ends in c2 and a byte, or in e1 to e3 and two bytes
            odd = p[-1] > 127 and (p[-2] == 0xC2 or 0xE1 <= p[-3:][0] <= 0xE3)
            (lone if odd or p[0] not in _BLANK or p[-1] in _BLANK else row).append(p)
        for lo in range(0, len(row), 4096):
            some = row[lo : lo + 4096]
            joined = [b"".join(some[k : k + 64]).decode() for k in range(0, len(some), 64)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
            ends = np.cumsum([len(p) for p in some])
            upto = np.cumsum(self.lengths[ids])
            last = np.searchsorted(upto, ends)
            if upto[-1] == ends[-1] and (upto[last] == ends).all():
                self.remember(some, np.diff(last + 1, prepend=0), ids)
            else:
                lone += some
        for lo in range(0, len(lone), 4096):
            some = lone[lo : lo + 4096]
            own = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in some], add_special_tokens=False)]
            self.remember(some, np.array([len(i) for i in own]), np.array([x for i in own for x in i], np.uint32))

    def cuts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places where parts begin: before white space that follows something else, and before a mark that follows a letter or digit. No token of a byte-level BPE reaches over these. Texts with other white space than ASCII's, or with an added token, are one part."""
        space = _SPACE[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = (space[1:] & ~space[:-1]) | (_MARK[data[1:]] & _ALNUM[data[:-1]])
        raw = data.tobytes()
        for token in self.special:
            place = raw.find(token)
            while place >= 0:
                d = int(np.searchsorted(at, place, "right")) - 1
                if place + len(token) <= at[d + 1]:
                    cut[at[d] : at[d + 1]] = False
                    place = raw.find(token, int(at[d + 1]))
                else:  # it reaches over the text's end
                    place = raw.find(token, place + 1)
        odd = np.flatnonzero(_ODD[data])
        for d in np.unique(np.searchsorted(at, odd, "right") - 1).tolist() if len(odd) else []:
            if _OTHER_SPACE.search(raw[at[d] : at[d + 1]].decode("utf-8", "replace")):
                cut[at[d] : at[d + 1]] = False
        cut[at[:-1][at[:-1] < at[1:]]] = True
        return np.flatnonzero(cut)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the n+1 places where they begin and end."""
        data, at = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        if len(self.known) > REMEMBERED:
            self.forget()
        begin = self.cuts(data, at)
        end = np.append(begin[1:], len(data))
        up, down = powers(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        total[1:] = data
        total[1:] += np.uint64(1)
        total[1:] *= up[:-1]
        np.cumsum(total, out=total)
        h = (total[end] - total[begin]) * down[begin]
        del total
        order = np.argsort(h)
        h = h[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        first, inverse = order[new], np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(new) - 1
        del h, order, new
        same = begin[first][inverse]
        # equal hashes must be equal bytes: else each part is looked up by itself
        size = end - begin
        gap = np.repeat((same - begin).astype(np.int32), size)
        if (size != size[first][inverse]).any() or (data != data[np.arange(len(data), dtype=np.int32) + gap]).any():
            first = inverse = np.arange(len(begin))
        del gap
        raw, known = data.tobytes(), self.known
        parts = [raw[x:y] for x, y in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
        place = [known.get(p, -1) for p in parts]
        if -1 in place:
            self.learn(list(dict.fromkeys(p for p, k in zip(parts, place, strict=True) if k < 0)))
            place = [known[p] for p in parts]
        place = np.array(place, np.int64)
        start, count = np.frombuffer(self.starts, np.int64)[place][inverse], np.frombuffer(self.sizes, np.int32)[place][inverse].astype(np.int64)
        ends = np.cumsum(count)
        ids = self.pool[np.repeat(start - ends + count, count) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.searchsorted(begin, at)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Starts of blocks, and the blocks. Those of equal length and width are packed together."""
    out: list[bytes] = []
    whole = len(ids) // BLOCK
    for flat in (ids[: whole * BLOCK].reshape(whole, BLOCK), ids[whole * BLOCK :].reshape(1, -1)):
        if not flat.size:
            continue
        low = flat.min(1)
        diff = flat - low[:, None]
        n = flat.shape[1]
        order = np.sort(diff, axis=1)
        bits = lambda v: np.frexp(v.astype(np.float64))[1].astype(np.int64)  # noqa: E731  bit length, exact below 2**53
        width, top = bits(order[:, int(np.ceil((n - 1) * PERCENTILE / 100))]), bits(order[:, -1])
        over = (diff >> np.minimum(width, 31).astype(np.uint32)[:, None] >> (width > 31).astype(np.uint32)[:, None]) != 0
        n_over = over.sum(1)
        plain = n_over * 48 >= n * (top - width)
        width[plain], n_over[plain], over[plain] = top[plain], 0, False
        packed: list[bytes] = [b""] * len(flat)
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            cell = "<u2" if w <= 16 else "<u4"
            bit = np.unpackbits(diff[rows].astype(cell).view(np.uint8), axis=1, bitorder="little").reshape(len(rows), n, -1)[:, :, :w]
            for r, b in zip(rows.tolist(), np.packbits(bit.reshape(len(rows), -1), axis=1, bitorder="little"), strict=True):
                packed[r] = b.tobytes()
        for r, p in enumerate(packed):
            tail = b""
            if n_over[r]:
                where = np.flatnonzero(over[r])
                tail = where.astype("<u2").tobytes() + diff[r, where].astype("<u4").tobytes()
            out.append(HEADER.pack(int(low[r]), n, int(width[r]), int(n_over[r])) + p + tail)
    return np.concatenate([[0], np.cumsum([len(b) for b in out])])[:-1].astype(int).tolist(), b"".join(out)


def unpack(data: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``."""
    heads = [HEADER.unpack_from(data, s) for s in starts]
    out: list[np.ndarray | None] = [None] * len(starts)
    shapes: dict[tuple[int, int], list[int]] = {}
    for k, (_, n, w, _) in enumerate(heads):
        shapes.setdefault((n, w), []).append(k)
    for (n, w), rows in shapes.items():
        size, cell = (n * w + 7) // 8, 16 if w <= 16 else 32
        raw = np.frombuffer(b"".join([data[starts[k] + HEADER.size : starts[k] + HEADER.size + size] for k in rows]), np.uint8).reshape(len(rows), size)
        bit = np.zeros((len(rows), n, cell), np.uint8)
        if w:
            bit[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little")[:, : n * w].reshape(len(rows), n, w)
        diff = np.packbits(bit.reshape(len(rows), -1), axis=1, bitorder="little").view(f"<u{cell // 8}").astype(np.uint32)
        for k, d in zip(rows, diff, strict=True):
            low, _, _, n_over = heads[k]
            if n_over:
                at = starts[k] + HEADER.size + size
                d[np.frombuffer(data, "<u2", n_over, at)] = np.frombuffer(data, "<u4", n_over, at + 2 * n_over)
            out[k] = d + np.uint32(low)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def ids_at(data: bytes, starts: list[int], lo: int, hi: int) -> np.ndarray:
    """Ids lo to hi of a segment, by reading only the blocks that hold them."""
    if hi <= lo:
        return np.zeros(0, np.uint32)
    first = lo // BLOCK
    got = unpack(data, starts[first : (hi - 1) // BLOCK + 1])
    return got[lo - first * BLOCK : hi - first * BLOCK]


def _segment(shard: int, seq: int, first: int, doc_ids: list, counts: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
    starts, data = pack(np.concatenate(ids))
    cells = [[shard], [seq], [first], [doc_ids], [counts], [starts], [data]]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], ["shard", "seq", "first", "doc_ids", "counts", "starts", "data"])


def write(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, order: tuple[str, ...] = (), ends: str | None = None) -> DataFrame:
    """Encode all ``docs`` into a token table in the shared folder and return it as read back."""
    spark, path = docs.sparkSession, tokenizer or default_path()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [f"o{k}" for k in range(len(order))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col(ends), F.lit(True)).alias("ends") if ends else F.lit(True).alias("ends"), *[F.col(c).alias(n) for c, n in zip(order, names, strict=True)])
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-size // SHARD_BYTES))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, own = TaskContext.get().partitionId(), encoder(path)
        seq = first = held = 0
        doc_ids, counts, ids = [], [], []
        for batch in slices(batches, "text"):
            flat, at = own.encode(get(batch, "text"))
            docs_here = get(batch, "doc_id").to_pylist()
            ending = get(batch, "ends").to_numpy(zero_copy_only=False)
            with_end = np.insert(flat, at[1:][ending], end_id)
            at = at + np.concatenate([[0], np.cumsum(ending)])
            lo = 0
            while lo < len(docs_here):  # as many whole documents as fill the segment
                hi = min(len(docs_here), int(np.searchsorted(at, at[lo] + SEGMENT_IDS - held, "left")))
                hi = max(hi, lo + 1)
                doc_ids += docs_here[lo:hi]
                counts += np.diff(at[lo : hi + 1]).tolist()
                ids.append(with_end[at[lo] : at[hi]])
                held += int(at[hi] - at[lo])
                if held >= SEGMENT_IDS:
                    yield _segment(shard, seq, first, doc_ids, counts, ids)
                    seq, first, held, doc_ids, counts, ids = seq + 1, first + held, 0, [], [], []
                lo = hi
        if doc_ids:
            yield _segment(shard, seq, first, doc_ids, counts, ids)
        own.forget()  # the worker goes on to other tasks
        release()

    # by numbers alone: the texts of a sample would go to the driver
    by = [F.col(n).asc_nulls_first() for n in (*names, "doc_id")]
    h = F.xxhash64("text")
    ordered = rows.repartitionByRange(shards, *by, h).sortWithinPartitions(*by, h, "text").select("doc_id", "text", "ends")
    with small_batches(spark):
        return scratch.written(ordered.mapInArrow(encode, SCHEMA), "tokens", compression="uncompressed")


def shard_starts(tokens: DataFrame) -> DataFrame:
    """shard and before: the ids of all shards before it."""
    n = F.expr("aggregate(counts, 0L, (a, x) -> a + x)")
    per = tokens.select("shard", n.alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    return sums.before(per, [], "shard", "n", "before").drop("n")


def read(spark: SparkSession, tokens: DataFrame) -> DataFrame:
    """For each row of documents in a token table: doc_id, start, n_tokens, ids_crc32, decoded from its files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["data"], row["starts"]).astype("<u4")
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"]), pa.array(counts), pa.array(crc, pa.int64()), pa.array([row["shard"]] * len(crc), pa.int32())], ["doc_id", "own_start", "n_tokens", "ids_crc32", "shard"])

    rows = tokens.mapInArrow(decode, "doc_id long, own_start long, n_tokens long, ids_crc32 long, shard int")
    before = scratch.written(shard_starts(tokens), "token-starts")
    small = before.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    joined = rows.join(F.broadcast(before) if small else before, "shard")
    return joined.select("doc_id", (F.col("before") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32")
