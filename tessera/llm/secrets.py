"""Secret scans by grammar inference.

Fixed patterns give the labelled credentials of all documents, of which a bounded sample is learned.
For each kind a prefix tree is grown over them and its states are merged where a
Hoeffding test finds their statistics compatible, recursively, into a
probabilistic automaton; ordinary long tokens give a background automaton in the
same way. Every token of every text is then scored: format likelihood against
background, in nats a symbol, from the length of the shortest learned credential on. Tokens above the margin are added to what the
patterns find; nothing the patterns find is ever taken away.

Symbols are classes of characters (hex letters, other lower case, upper case,
digits, each sign), a class spreading its probability evenly.

Defined cases: a null text is empty and has no spans; repeated rows and null ids
stay; other columns are ignored; no rows give no rows; without any credential
nothing is added; a text is searched as a whole, in memory that grows with the longest one.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from typing import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["base_spans", "Automaton", "fit", "Model", "scan", "KINDS"]

KINDS = ("assign", "access", "hex", "format")
# The patterns of the base kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = r"[A-Za-z0-9+/_.=-]{%d,}"
_PLAIN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_WORD = re.compile(r"(?:passw|secre|token|api_?k)", re.ASCII | re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, credential) of the fixed patterns, leftmost and not overlapping within a kind."""
    out = []
    if _WORD.search(text):
        out += [(m.start(), "assign", m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


_CLASS = {c: k for k, cs in {"h": "abcdef", "l": "ghijklmnopqrstuvwxyz", "U": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "d": "0123456789"}.items() for c in cs}
_SIZE = {"h": 6, "l": 20, "U": 26, "d": 10}


def _symbols(s: str) -> list[str]:
    return [_CLASS.get(c, c) for c in s]


class Automaton:
    """Prefix tree with counts, merged into a deterministic probabilistic automaton."""

    def __init__(self, strings: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.through: list[dict[str, int]] = [{}]
        self.ends, self.visits = [0], [0]
        for s in strings:
            q = 0
            self.visits[0] += 1
            for a in _symbols(s):
                if a not in self.next[q]:
                    self.next[q][a] = len(self.next)
                    self.next.append({})
                    self.through.append({})
                    self.ends.append(0)
                    self.visits.append(0)
                self.through[q][a] = self.through[q].get(a, 0) + 1
                q = self.next[q][a]
                self.visits[q] += 1
            self.ends[q] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _differs(self, x: int, m: int, y: int, n: int) -> bool:
        return m > 0 and n > 0 and abs(x / m - y / n) > self.bound * (1 / math.sqrt(m) + 1 / math.sqrt(n))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            m, n = self.visits[p], self.visits[q]
            if self._differs(self.ends[p], m, self.ends[q], n):
                return False
            for a in {*self.next[p], *self.next[q]}:
                if self._differs(self.through[p].get(a, 0), m, self.through[q].get(a, 0), n):
                    return False
                if a in self.next[p] and a in self.next[q]:
                    todo.append((self.next[p][a], self.next[q][a]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Adds the tree below q to the state p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.ends[p] += self.ends[q]
            self.visits[p] += self.visits[q]
            for a, n in self.through[q].items():
                self.through[p][a] = self.through[p].get(a, 0) + n
                if a in self.next[p]:
                    todo.append((self.next[p][a], self.next[q][a]))
                else:
                    self.next[p][a] = self.next[q][a]

    def _merge(self) -> None:
        red = [0]
        while True:
            kept = set(red)
            blue = [(p, a, q) for p in red for a, q in self.next[p].items() if q not in kept]
            if not blue:
                return
            p, a, q = max(blue, key=lambda b: (self.visits[b[2]], -b[0]))
            for r in red:
                if self._compatible(r, q):
                    self.next[p][a] = r
                    self._fold(r, q)
                    break
            else:
                red.append(q)

    def likelihood(self, s: str) -> float:
        """Log probability of a string, smoothed by one part in the visits of each state."""
        q, out, lost = 0, 0.0, math.log(1e-3)
        for c in s:
            a = _CLASS.get(c, c)
            n = self.through[q].get(a, 0) if q is not None else 0
            out += (math.log(n / self.visits[q]) if n else lost) - math.log(_SIZE.get(a, 1))
            q = self.next[q].get(a, 0) if n else 0
        return out + (math.log(self.ends[q] / self.visits[q]) if self.visits[q] and self.ends[q] else lost)


def background(strings: list[str]) -> Automaton:
    """Ordinary long tokens, in any case of letters."""
    return Automaton([x for s in strings or ["a"] for x in (s, s.upper(), s.capitalize())])


class Model:
    """One automaton for each kind against the background; every token from the shortest learned credential on is a candidate."""

    def __init__(self, kinds: list[Automaton], background: Automaton, margin: float, shortest: int):
        self.kinds, self.background, self.margin, self.shortest = kinds, background, margin, shortest
        self.known: dict[str, bool] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def likely(self, s: str) -> bool:
        """Whether a token follows a credential's format clearly better than ordinary ones do."""
        if s not in self.known:
            if len(self.known) >= 1 << 16:  # what has been worked out, not what counts
                self.known.clear()
            back = self.background.likelihood(s)
            self.known[s] = any(k.likelihood(s) - back > self.margin * len(s) for k in self.kinds)
        return self.known[s]

    def spans(self, text: str) -> list[tuple[int, str, int, str]]:
        base = base_spans(text)
        more, k = [], 0
        for m in re.finditer(_TOKEN % self.shortest, text) if self.kinds else ():
            a, b = m.span()
            if self.likely(m[0]) and not any(s[0] < b and a < s[2] for s in base):
                more.append((a, "format", b, m[0]))
        return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1]))) if more else base


def fit(docs: DataFrame, most: int = 1500, longest: int = 4096, margin: float = 0.5) -> Model:
    """Learns from a bounded sample: of each kind, and of tokens that are no
    credentials, the ``most`` distinct strings of up to ``longest`` characters
    with the lowest hashes, over all documents. A task passes on no more than that
    of each, and one pass finds them: the lowest of all are among the lowest of each."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowest: dict[str, dict[str, int]] = {k: {} for k in ("", *KINDS[:3])}
        limit = dict.fromkeys(lowest, 1 << 64)

        def offer(kind: str, s: str) -> None:
            own = lowest[kind]
            if s in own or len(s) > longest:
                return
            h = xxhash.xxh64_intdigest(s)
            if h < limit[kind]:
                own[s] = h
                if len(own) >= 2 * most:
                    keep = sorted(own.items(), key=lambda x: (x[1], x[0]))[:most]
                    lowest[kind], limit[kind] = dict(keep), keep[-1][1]

        for b in batches:
            for text in b.column(0).to_pylist():
                base = base_spans(text or "")
                for _, kind, _, s in base:
                    offer(kind, s)
                for m in _PLAIN.finditer(text or ""):
                    if not any(s[0] < m.end() and m.start() < s[2] for s in base):
                        offer("", m[0])
        rows = [(k, s, h - (1 << 63)) for k, own in lowest.items() for s, h in sorted(own.items(), key=lambda x: (x[1], x[0]))[:most]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["kind", "s", "h"])

    strings = docs.select("text").mapInArrow(found, "kind string, s string, h bigint").distinct()
    first = Window.partitionBy("kind").orderBy("h", "s")  # ``most`` rows a kind and task, cut before they are shuffled
    by: dict[str, list[str]] = defaultdict(list)
    for r in strings.withColumn("r", F.row_number().over(first)).where(F.col("r") <= most).orderBy("kind", "h", "s").collect():
        by[r.kind].append(r.s)
    learned = [by[k] for k in KINDS[:3] if by[k]]
    return Model([Automaton(x) for x in learned], background(by[""]), margin, min((len(s) for x in learned for s in x), default=6))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, spans: array of (kind, start, end), code
    points, end exclusive, by start and then kind as listed in ``KINDS``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [[{"kind": k, "start": s, "end": e} for s, k, e, _ in model.spans(t.as_py() or "")] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>")
