"""Toxicity by a subsequence string kernel and a support vector machine.

A sentence is read in units: its words, and its pairs of neighbouring words with
what stands between them. Two units are alike by their common subsequences of three
letters, gaps allowed, each weighted by DECAY to the length it spans (inserted
characters, signs and blanks cost a factor each and do not break the match, up to
``REACH`` characters beyond the first letter); the kernel is normalised. So an insult
counts when a blank cuts it in two, and a phrase of ordinary words when it is the phrase that is toxic. Units
of the sentences of labelled documents serve as Nystroem landmarks, a linear machine with squared
hinge loss is trained in the landmark space, a sentence scores as its most toxic unit, and a
document as its most toxic sentence. Labels are known by document
only, so the sentences that carry a toxic label are found in rounds: the highest
scoring one of each toxic document against the highest scoring one of every
other document. A logistic curve turns the score into a probability.

As the machine is linear in the landmark space, it folds into one weight for each
letter triple: scoring is a table look-up over the distinct units of a chunk.
Bytes of other scripts share 37 symbols.

Defined cases: null and empty texts score as a text without toxic words; letters
without labels, null labels and labels without documents are ignored, a document
labelled twice is toxic if either row says so, of rows that share a doc_id each is learned; other columns stay; no rows give
no rows; without labelled documents of both classes every score is the share of
toxic ones (0 without any); of units with equal scores or odds the first by bytes counts; units of a labelled text
under three bytes are no training units; a text is scored as a whole, in memory that grows with the longest one.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import LOWER, byte_chunks, doc_bytes, gather, mix64, release, span_hash, word_spans

__all__ = ["Model", "fit", "train", "training_sample", "score", "triples"]

DECAY, REACH, CHUNK = 0.6, 5, 1 << 18
#: Bits of a symbol, and codes of three of them.
BITS = 6
SPACE = 1 << 3 * BITS
#: Letters 1-26, digits that stand for letters, bytes of other scripts dealt over the rest; all else is a gap.
SYMBOL = np.zeros(256, np.int32)
SYMBOL[97:123] = np.arange(1, 27)
for _digit, _letter in zip(b"013457", b"oieast"):
    SYMBOL[_digit] = SYMBOL[_letter]
SYMBOL[128:] = 27 + np.arange(128) % ((1 << BITS) - 27)
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
#: Bytes of a pair of words, at most.
PAIR = 32
_STEPS = [(a, b) for a in range(1, REACH) for b in range(1, REACH + 1 - a)]
_WHOLE = np.zeros(SPACE, np.float32)
_codes = np.arange(SPACE)
_WHOLE[(_codes >> 2 * BITS > 0) & (_codes >> BITS & (1 << BITS) - 1 > 0) & (_codes & (1 << BITS) - 1 > 0)] = 1


def triples(word: bytes) -> dict[int, float]:
    """Weights of all gapped letter triples of a lower-case word."""
    s, out = SYMBOL[np.frombuffer(word, np.uint8)].tolist(), {}
    for a, b in _STEPS:
        for i in range(len(s) - a - b):
            x, y, z = s[i], s[i + a], s[i + a + b]
            if x and y and z:
                c = (x << 2 * BITS) | (y << BITS) | z
                out[c] = out.get(c, 0.0) + DECAY ** (a + b + 1)
    return out


def unit(word: bytes) -> tuple[list[int], np.ndarray]:
    """The word in the space of triples, length 1: places and weights."""
    t = triples(word)
    w = np.fromiter(t.values(), np.float64, len(t))
    return list(t), w / np.sqrt((w * w).sum()) if len(t) else w


def words(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the units of lower-case bytes, by document: words (letters set apart by single spaces
    count as one) and pairs of neighbouring words of a sentence, from the first letter of one to the last of the other."""
    start, end, doc = word_spans(flat, offsets)
    if not len(start):
        return start, end, doc
    single = (end - start == 1) & (SYMBOL[flat[start]] > 0)
    joined = np.zeros(len(start), bool)
    joined[1:] = single[1:] & single[:-1] & (start[1:] == end[:-1] + 1) & (doc[1:] == doc[:-1])
    first = np.flatnonzero(~joined)
    last = np.concatenate((first[1:], [len(start)])) - 1
    start, end, doc = start[first], end[last], doc[first]
    close = (doc[1:] == doc[:-1]) & (start[1:] - end[:-1] <= 2) & ~_STOP[flat[end[:-1] - 1]] & (flat[end[:-1]] != 10) & (end[1:] - start[:-1] <= PAIR)
    i = np.flatnonzero(close)
    start, end, doc = (np.concatenate(x) for x in ((start, start[i]), (end, end[i + 1]), (doc, doc[i])))
    order = np.argsort(doc, kind="stable")
    return start[order], end[order], doc[order]


def units(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``words`` and their hashes, read a chunk of documents at a time: the working numbers of a
    byte, some hundred bytes, are held for one chunk only, and a unit keeps 20 bytes."""
    place = np.int32 if len(flat) < 1 << 31 else np.int64
    parts = []
    for i, j in byte_chunks(offsets, CHUNK):
        part = flat[offsets[i]:offsets[j]]
        start, end, doc = words(part, offsets[i:j + 1] - offsets[i])
        parts.append(((start + offsets[i]).astype(place), (end + offsets[i]).astype(place), (doc + i).astype(np.int32), span_hash(part, start, end)))
    return tuple(np.concatenate(x) for x in zip(*parts))


@dataclass
class Model:
    weight: np.ndarray  # of each triple
    bias: float
    slope: float
    shift: float

    def word_scores(self, flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Decision value of each word."""
        _, at, which = np.unique(span_hash(flat, start, end), return_index=True, return_inverse=True)
        text, who = gather(flat, start[at], (end - start)[at])
        s, heads = SYMBOL[text], np.searchsorted(who, np.arange(len(at)))
        n = len(s)
        value, norm = np.zeros(n, np.float32), np.zeros(n, np.float32)
        for reach in range(2, REACH + 1):
            m = n - reach
            if m <= 0:
                break
            same = who[reach:] == who[:m]
            for a in range(1, reach):
                code = (s[:m] << 2 * BITS) | (s[a:a + m] << BITS) | s[reach:]
                code *= same
                value[:m] += np.float32(DECAY ** (reach + 1)) * self.weight[code]
                norm[:m] += np.float32(DECAY ** (2 * reach + 2)) * _WHOLE[code]
        value, norm = np.add.reduceat(value, heads), np.add.reduceat(norm, heads)
        out = value / np.sqrt(np.maximum(norm, 1e-9))
        # Triples that a word repeats make its length greater than this sum; exact where it can matter.
        for k in np.flatnonzero(out + self.bias > 0):
            w = triples(text[heads[k]:heads[k] + (end - start)[at[k]]].tobytes())
            out[k] = value[k] / np.sqrt(sum(x * x for x in w.values())) if w else 0.0
        return (out + self.bias)[which]

    def decide(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Decision value of each document; without words, that of a word like none."""
        out = np.full(len(offsets) - 1, min(self.bias, 0.0), np.float64)
        for i, j in byte_chunks(offsets, CHUNK):
            part, local = LOWER[flat[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
            start, end, doc = words(part, local)
            if len(start):
                np.maximum.at(out, doc + i, self.word_scores(part, start, end))
        return out

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -50, 50)))


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the vectors inside the margin; the last entry is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, share = np.zeros(x.shape[1]), np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    for _ in range(30):
        inside = y * (x @ w) < 1
        a, c = x[inside], (cost * share / len(y))[inside]
        new = np.linalg.solve(np.eye(len(w)) * 1e-3 + (a * c[:, None]).T @ a, (a * c[:, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-6):
            break
        w = 0.5 * w + 0.5 * new
    return w


def _logistic(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, ridge-regularised, by Newton's method."""
    x, w = np.stack([s, np.ones(len(s))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(2), x.T @ (y - p) - 0.1 * w)
    return float(w[0]), float(w[1])


def fit(texts: list[str], labels: list[int], landmarks: int = 192, rounds: int = 4) -> Model:
    """Trains on whole texts with labels 0 and 1."""
    y = np.array(labels, int)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(SPACE, np.float32), 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    flat, offsets = doc_bytes(pa.array(texts, pa.large_string()))
    flat = LOWER[flat]
    start, end, doc, sign = units(flat, offsets)
    taken_out = lambda i: flat[start[i]:end[i]].tobytes()
    bounds = np.searchsorted(doc, np.arange(len(y) + 1, dtype=doc.dtype))
    # Units by number: their strings are taken out of the text only where they are needed.
    long = np.flatnonzero(end - start >= 3)
    kinds, first, kind = np.unique(sign[long], return_index=True, return_inverse=True)
    del sign
    first = long[first]
    string = lambda k: taken_out(first[k])
    pairs = np.unique(doc[long].astype(np.int64) * max(len(kinds), 1) + kind)
    del long
    of, kind = pairs // max(len(kinds), 1), pairs % max(len(kinds), 1)
    edge, spread, chance = np.searchsorted(of, np.arange(len(y) + 1)), np.bincount(kind, minlength=len(kinds)), mix64(kinds)
    # Copies of one text would lend its units a weight of their own: each group counts once.
    taken, own = set(), np.zeros(len(y), bool)
    for d in sorted(range(len(y)), key=lambda d: (-y[d], d)):
        rare = kind[edge[d]:edge[d + 1]]
        rare = kinds[rare[spread[rare] <= max(2, len(y) // 200)]]
        signs = {(k, int(mix64(rare + np.uint64(k + 1)).min())) for k in range(4)} if len(rare) >= 5 else set()
        own[d] = len(signs & taken) < 2
        taken |= signs
    seen = [np.bincount(kind[own[of] & (y[of] == t)], minlength=len(kinds)) for t in (0, 1)]
    sure, n0 = int(y[own].sum()), int((1 - y[own]).sum())
    odds = np.where(seen[1] > 0, (np.log((seen[1] + 0.5) / (sure + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))) * np.sqrt(seen[1]), 0.0)
    shared = np.flatnonzero(seen[1] >= max(min(3, sure), 1)).tolist()
    good = [string(k) for k in sorted(shared, key=lambda k: (-odds[k], string(k)))[:landmarks * 2 // 3]]
    ordinary = np.flatnonzero((seen[0] > 0) & (seen[1] == 0))
    plain = [string(k) for k in ordinary[np.argsort(chance[ordinary], kind="stable")][:3000].tolist()]
    most = [mine[odds[mine] == odds[mine].max()].tolist() for d in np.flatnonzero(y == 1) for mine in [kind[edge[d]:edge[d + 1]]] if len(mine)]
    likely = [max(string(k) for k in ties) for ties in most]
    marks = [w for w in good + plain[:landmarks - len(good)] if triples(w)]
    if not marks:
        return Model(np.zeros(SPACE, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    # The landmarks' own triples, numbered; all others are 0 with every landmark.
    codes = np.array(sorted({c for m in marks for c in triples(m)}), np.int64)
    number = np.full(SPACE, len(codes), np.int32)
    number[codes] = np.arange(len(codes))
    base = np.zeros((len(codes) + 1, len(marks)), np.float32)
    for k, m in enumerate(marks):
        places, weights = unit(m)
        base[number[places], k] = weights
    values, vectors = np.linalg.eigh(base.T @ base)
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])  # kernel of the landmarks to the power -1/2
    known: dict[bytes, np.ndarray] = {}

    def features(ws: list[bytes]) -> np.ndarray:
        for w in ws:
            if w not in known:
                places, weights = unit(w)
                known[w] = (weights @ base[number[places]]) @ root
        return np.stack([known[w] for w in ws])

    places = [unit(w) for w in good]

    def borne_out(w: bytes) -> bool:
        """Alike a word that several toxic documents share; else the label is not this word's doing."""
        own = np.zeros(SPACE)
        at, weights = unit(w)
        own[at] = weights
        return any(x @ own[c] >= 0.5 for c, x in places)

    positive = [w for w in likely if borne_out(w)] or good
    negative = list(plain)
    best, model = -np.inf, None
    for _ in range(rounds):
        x = features(positive + negative)
        w = _machine(x, np.array([1.0] * len(positive) + [-1.0] * len(negative)))
        tried = Model(np.zeros(SPACE, np.float32), float(w[-1]), 1.0, 0.0)
        tried.weight[codes] = (base @ (root @ w[:-1]))[:-1]
        tried.weight[_WHOLE == 0] = 0
        scores = np.concatenate([tried.word_scores(flat[offsets[i]:offsets[j]], start[a:b] - offsets[i], end[a:b] - offsets[i])
                                 for i, j in byte_chunks(offsets, CHUNK) for a, b in [(bounds[i], bounds[j])] if b > a])
        top = [bounds[d] + int(np.argmax(scores[bounds[d]:bounds[d + 1]])) if bounds[d + 1] > bounds[d] else None for d in range(len(y))]
        # The round whose scores tell the labelled documents apart best is kept.
        decision = np.array([min(tried.bias, 0.0) if t is None else max(scores[t], min(tried.bias, 0.0)) for t in top])
        tried.slope, tried.shift = _logistic(decision, y)
        p = np.clip(tried.probability(decision), 1e-9, 1 - 1e-9)
        fits = float(np.where(y == 1, np.log(p), np.log(1 - p)).mean())
        if fits > best:
            best, model = fits, tried
        witness = lambda k: [taken_out(i) for i, t in zip(top, y) if t == k and i is not None]
        positive, negative = [w for w in witness(1) if borne_out(w)] or good, sorted({*negative, *witness(0)})
    return model


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``most`` rows of two numbers
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") > 0).cast("int").alias("toxic")))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = 4000) -> tuple[list[str], list[int]]:
    """Texts and toxic labels of at most ``most`` labelled documents (lowest hashes of
    doc_id first) whose crc32 of the id's text mod 4 is not 2."""
    rows = sorted(map(tuple, _sample(docs, labels, most).collect()))
    return [r[1] for r in rows], [r[2] for r in rows]


def train(docs: DataFrame, labels: DataFrame, most: int = 4000) -> Model:
    """``fit`` on the ``training_sample``, in one task: the sample is bounded by ``most``, and only the model comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        model = pickle.dumps(fit([r[1] for r in rows], [r[2] for r in rows]))
        del rows
        release()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    models = _sample(docs, labels, most).repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(models[0].model) if models else fit([], [])


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability of a toxic text in ``column`` (which replaces one of that name)."""
    docs = docs.drop(column)
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = shared.value
            p = m.probability(m.decide(*doc_bytes(b.column(at))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], names=[*b.schema.names, column])
        release()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
