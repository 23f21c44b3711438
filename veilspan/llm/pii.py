r"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans: email, ip, card and phone, each leftmost and without
overlap within its kind, checked afterwards. The field adds spans that the patterns
miss, such as a repeated number in another notation.

The field labels tokens (runs without white space, less punctuation around them) that
have a digit, ``@`` or ``+``, or lie in a base span. All other tokens carry no evidence
and are fixed to ``O``, which cuts the chain; base spans' tokens are fixed to their kind.
Neighbouring tokens share chain potentials. Tokens of one document with the same key (an
address's local part, the last seven digits, or the whole token; of a number's last token,
the last seven digits of the whole number) share skip potentials, each with the next one of
its key, so that there are never more edges than tokens. Loopy
sum-product message passing gives each token's beliefs; it stops for each document by itself,
so that what else is in a batch doesn't matter. A run of tokens believed to be of one kind,
that overlaps no base span, is an added span.

Weights are learned by pseudo-likelihood from the base spans, and from mentions that are
added to the sample's texts for learning only: each base span again in another notation
(``NOTATIONS``), with its kind as label, and the same notation of made-up digits or names, with
no label. So the field learns that a shape alone is no evidence and that a shared key is.
The base spans are those of a bounded sample: at most
``SAMPLE`` distinct documents with a digit or ``@``, those with the smallest hash of their
id, as long as their texts fit into ``SAMPLE_BYTES``.

Defined results:

* a null text is empty; it has no spans
* rows with a null or repeated doc_id are looked at one by one
* without any base span in the sample, the field adds nothing
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan.llm.arrow import get, slices, text_bytes
from veilspan.llm.sample import sampled

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_BYTES = 2000, 4 << 20
#: Longest name of a feature that is remembered with its number.
NAME = 60
FEATURES, SWEEPS, DAMPING, STEPS, RATE, BELIEF, SEED = 1 << 12, 12, 0.3, 150, 0.1, 0.9, 3

_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SIGN = frozenset("0123456789@+")
_EDGE = ".,;:!?\"'()[]{}<>|"
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")


def luhn(digits: str) -> bool:
    back = digits[::-1]
    return (sum(map(int, back[0::2])) + sum(int(d) * 2 - 9 * (d > "4") for d in back[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost match around each ``@``: from the start of the run of local characters before it. Takes time in proportion to the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > free and _LOCAL.match(text[lo - 1]):
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            yield lo, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def stable(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=4).digest(), "little") % FEATURES


def shape(token: str) -> str:
    return _RUNS.sub(lambda m: f"9{min(len(m[0]), 9)}" if m[0][0].isdigit() else "a", token)


def key(token: str) -> str:
    if "@" in token:
        return token.lower().split("@")[0] + "@"
    digits = _NOT_DIGIT.sub("", token)
    return digits[-7:] if len(digits) >= 7 else token.lower()


class Graph:
    """Tokens of some documents: label 0 is O, 1 to 4 the kinds; fixed is -1 where the field decides."""

    def __init__(self) -> None:
        self.doc: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.feats: list[list[int]] = []
        self.fixed: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.known: dict[str, int] = {}

    def feature(self, name: str) -> int:
        if name in self.known:
            return self.known[name]
        number = stable(name)
        if len(name) <= NAME:
            self.known[name] = number
        return number

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        """``base``: (kind, start, end) of what is known."""
        spans = sorted((a, b, k + 1) for k, a, b in base)
        at, before, was_in, last = 0, "^", False, {}
        rows = []
        for m in _TOKEN.finditer(text):
            token = m[0]
            while at < len(spans) and spans[at][1] <= m.start():
                at += 1
            label = spans[at][2] if at < len(spans) and spans[at][0] < m.end() else 0
            if not label and _SIGN.isdisjoint(token):
                before, was_in = "a", False
                continue
            core = token.strip(_EDGE)
            if not core:
                before, was_in = shape(token), False
                continue
            lo = m.start() + token.index(core)
            here = len(self.doc)
            mine = shape(token)
            self.doc.append(doc)
            self.span.append((lo, lo + len(core)))
            self.fixed.append(label if label else -1)
            digits = sum(c.isdigit() for c in core)
            self.feats.append([self.feature(f"shape {mine}"), self.feature(f"core {shape(core)}"), self.feature(f"before {before}|{mine}"), self.feature(f"digits {min(digits, 20)} {'@' in core}"), self.feature(f"dots {min(core.count('.'), 5)} {core[0] == '+'}"), self.feature("bias")])
            if was_in:
                self.chain.append((here - 1, here))
            k = key(core)
            if label > 2 and m.end() >= spans[at][1]:
                k = key(text[spans[at][0] : spans[at][1]])
            if k in last:
                self.skip.append((last[k], here))
            last[k] = here
            rows.append(here)
            before, was_in = mine, True

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return (np.array(self.feats, np.int64).reshape(-1, 6), np.array(self.fixed, np.int64), np.array(self.chain, np.int64).reshape(-1, 2), np.array(self.skip, np.int64).reshape(-1, 2))


L = len(KINDS) + 1


class Field:
    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        """Weights: FEATURES x L, L x L from left to right, L x L between equal keys."""
        self.unary, self.chain, self.skip = unary, chain, skip

    def beliefs(self, graph: Graph) -> np.ndarray:
        feats, fixed, chain, skip = graph.arrays()
        local = self.unary[feats].sum(1)
        bound = fixed >= 0
        local[bound] = -1e3
        local[bound, fixed[bound]] = 0
        a, b = np.concatenate([chain[:, 0], skip[:, 0]]), np.concatenate([chain[:, 1], skip[:, 1]])
        pot = np.concatenate([np.broadcast_to(self.chain, (len(chain), L, L)), np.broadcast_to(self.skip, (len(skip), L, L))])
        # messages along each edge: from a to b, then from b to a
        src, dst = np.concatenate([a, b]), np.concatenate([b, a])
        pot = np.concatenate([pot, pot.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        msg = np.zeros((len(src), L))
        doc = np.unique(np.array(graph.doc, np.int64), return_inverse=True)[1][src] if len(src) else src
        open_ = np.arange(len(src))  # the edges of documents whose messages still move
        for _ in range(SWEEPS if len(src) else 0):
            total = local.copy()
            np.add.at(total, dst, msg)
            out = (total[src[open_]] - msg[back[open_]])[:, :, None] + pot[open_]
            top = out.max(1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(1, keepdims=True)))[:, 0, :]
            new -= new.max(1, keepdims=True)
            moved = np.zeros(doc.max() + 1)
            np.maximum.at(moved, doc[open_], np.abs(new - msg[open_]).max(1))
            msg[open_] = DAMPING * msg[open_] + (1 - DAMPING) * new
            open_ = open_[moved[doc[open_]] >= 1e-4]
            if not len(open_):
                break
        total = local.copy()
        np.add.at(total, dst, msg)
        total -= total.max(1, keepdims=True)
        p = np.exp(total)
        return p / p.sum(1, keepdims=True)


#: Other ways to write what is found, by kind, from its digits (an address's local part and host): {0} to {3} are groups of them.
NOTATIONS = (
    ("{0}@{1}", "<{0}@{1}>", "{0}@{1},"),
    (),
    ("{0}.{1}.{2}.{3}", "{0}/{1}/{2}/{3}", "{0}_{1}_{2}_{3}", "({0}/{1}/{2}/{3})"),
    ("({0}) {1}-{2}", "{0}-{1}-{2}", "{0}.{1}.{2}", "{0}{1}{2}", "{0}/{1}-{2}", "{0} {1}-{2}"),
)


def again(kind: int, text: str, rng: random.Random) -> list[tuple[str, bool]]:
    """Two mentions for learning: one of a span in another notation, and one of something made up in the same; whether it is the span."""
    form = rng.choice(NOTATIONS[kind])
    if kind == 0:
        local, host = text.split("@")[0], text.split("@")[1].split(".")[0]
        other = "".join(rng.choice("0123456789") if c.isdigit() else rng.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in local)
        return [(form.format(local, host), True), (form.format(other, host), False)]
    digits = _NOT_DIGIT.sub("", text)
    made = "".join(rng.choice("0123456789") for _ in digits)
    cut = (lambda d: [d[-10:-7], d[-7:-4], d[-4:]]) if kind == 3 else (lambda d: [d[:4], d[4:8], d[8:12], d[12:]])
    return [(form.format(*cut(digits)), True), (form.format(*cut(made)), False)]


def lesson(text: str, rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A text with mentions added for learning, and what is known of it."""
    known = base_spans(text)
    more = []
    for kind, a, b in known:
        if NOTATIONS[kind]:
            more += [(kind, *m) for m in again(kind, text[a:b], rng)]
    rng.shuffle(more)
    for kind, said, true in more:
        text += " " + rng.choice(("again", "or", "by", "at", "see"))
        lo, text = len(text) + 1, f"{text} {said}"
        if true and not base_spans(said):
            known.append((kind, lo, len(text)))
        elif base_spans(said):  # it happens to fit a pattern: then it is known anyway
            known += [(k, lo + a, lo + b) for k, a, b in base_spans(said)]
    return text, sorted(known)


def train(graph: Graph) -> Field | None:
    """Pseudo-likelihood: each token given its neighbours' labels, base spans being the truth and all else O."""
    feats, fixed, chain, skip = graph.arrays()
    y = np.maximum(fixed, 0)
    if not y.any():
        return None
    w, c, k = np.zeros((FEATURES, L)), np.zeros((L, L)), np.zeros((L, L))
    params = [w, c, k]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        z = w[feats].sum(1)
        np.add.at(z, chain[:, 1], c[y[chain[:, 0]]])
        np.add.at(z, chain[:, 0], c.T[y[chain[:, 1]]])
        np.add.at(z, skip[:, 1], k[y[skip[:, 0]]])
        np.add.at(z, skip[:, 0], k.T[y[skip[:, 1]]])
        p = np.exp(z - z.max(1, keepdims=True))
        err = p / p.sum(1, keepdims=True)
        err[np.arange(len(y)), y] -= 1
        err /= len(y)
        gw, gc, gk = np.zeros_like(w), np.zeros_like(c), np.zeros_like(k)
        np.add.at(gw, feats.ravel(), np.repeat(err, feats.shape[1], 0))
        for e, g in ((chain, gc), (skip, gk)):
            np.add.at(g, y[e[:, 0]], err[e[:, 1]])
            np.add.at(g.T, y[e[:, 1]], err[e[:, 0]])
        for i, g in enumerate((gw + 1e-5 * w, gc + 1e-5 * c, gk + 1e-5 * k)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            params[i] -= RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Field(w, c, k)


def added(graph: Graph, belief: np.ndarray, base: dict[int, list[tuple[int, int, int]]]) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of tokens that are believed to be of one kind and overlap no base span, by document: (kind, start, end)."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    best = belief.argmax(1)
    ok = (best > 0) & (belief[np.arange(len(best)), best] >= BELIEF) & (np.array(graph.fixed, np.int64) < 0)
    next_to = {b: a for a, b in graph.chain}
    runs: list[list[int]] = []
    for i in np.flatnonzero(ok).tolist():
        if runs and next_to.get(i) == runs[-1][-1] and best[i] == best[runs[-1][-1]]:
            runs[-1].append(i)
        else:
            runs.append([i])
    for run in runs:
        doc, lo, hi = graph.doc[run[0]], graph.span[run[0]][0], graph.span[run[-1]][1]
        if all(hi <= a or b <= lo for _, a, b in base.get(doc, [])):
            out.setdefault(doc, []).append((int(best[run[0]]) - 1, lo, hi))
    return out


def marked(batch: pa.RecordBatch) -> list[tuple[int, str]]:
    """Rows whose text has a digit, ``@`` or ``+``: all that a base span or a token of the field needs."""
    data, at = text_bytes(get(batch, "text"))
    sign = ((data >= 48) & (data <= 57)) | (data == 64) | (data == 43)
    rows = np.unique(np.searchsorted(at, np.flatnonzero(sign), "right") - 1)
    texts = get(batch, "text").take(pa.array(rows)).to_pylist()
    return list(zip(rows.tolist(), texts, strict=True))


def fit(docs: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Field | None:
    """Learn from the base spans of a sample, whose texts go to the driver."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text rlike '[0-9@]'")
    some = sampled(lambda below: texts.where(below), docs.count(), sample, sample_bytes)
    if some is None:
        return None
    graph, rng = Graph(), random.Random(SEED)
    for d, row in enumerate(sorted(some.select("doc_id", "text").collect())):
        graph.add(d, *lesson(row["text"], rng))
    return train(graph)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def detect(docs: DataFrame, field: Field | None) -> DataFrame:
    """For each row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, "text"):
            base, graph = {}, Graph()
            for d, text in marked(batch):
                base[d] = base_spans(text)
                if own is not None:
                    graph.add(d, text, base[d])
            more = added(graph, own.beliefs(graph), base) if graph.doc else {}
            n = batch.num_rows
            counts = np.zeros((len(KINDS), n), np.int64)
            digest, spans = [nothing] * n, [""] * n
            for d, found in base.items():
                if found or d in more:
                    for k, _, _ in found:
                        counts[k, d] += 1
                    digest[d] = hashlib.sha256(_joined(found).encode()).hexdigest()
                    spans[d] = _joined(found + more.get(d, []))
            yield pa.RecordBatch.from_arrays([get(batch, "doc_id"), *[pa.array(c) for c in counts], pa.array(digest), pa.array(spans), pa.array([len(more.get(d, [])) for d in range(n)], pa.int64())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
