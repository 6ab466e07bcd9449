"""Ranked lexical search: exact inner products over sparse ball trees.

A document is a vector with one coordinate for each term of the items: the term's
weight times its saturated frequency, both integers. A score is the sum of the
coordinates of an item's terms, so an item is a 0/1 vector q, and for a ball with
centroid c and radius r around documents no score exceeds ``<q, c> + |q| r``. Each task builds ball
trees over its documents, ``TREE`` at a time, and answers every item best-first:
the subtree with the highest bound is opened next, and none is opened whose bound,
rounded up, is below the item's tenth score so far. Leaves are scored in integers.

Two passes over the narrow vectors: the first, over one part in ``PARTS`` of them, gives for each
item a score that its tenth document reaches at least; the second searches all of them from
there on, so that few rows leave a task. The bound only prunes; it changes no result.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in the
UTF-8 bytes of the whole text, A-Z lowered. Texts are cut into terms once; what
follows works on (length, terms, frequencies) of those terms that an item has.
Items reach the tasks in blocks of at most ``block_bytes``.

Defined cases: null and empty texts have no terms, and neither count nor rank; a null doc_id is
carried and comes after the others of its score; repeated rows are documents of their own and rank one after the
other; repeated item rows are answered once each for their item_id and text; other
columns are ignored; an item without terms, or whose terms no document has, has no
rows; empty tables give none. A text is worked on as a whole, in memory that grows
with the longest one.
"""

from __future__ import annotations

import heapq
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, byte_chunks, cut, doc_bytes, gather, span_hash
from tessera.llm.decontaminate import item_blocks

__all__ = ["Terms", "BallTree", "search"]

#: documents of a tree, and of a leaf; bytes of text cut into terms at a time; parts of the first pass
TREE, LEAF, CHUNK, PARTS = 8192, 128, 1 << 22, 16
_TERM = np.ones(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM[_a:_b + 1] = False


def term_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every term; terms end with their document."""
    if not len(flat):
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = _TERM[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(ink & (np.concatenate(([True], ~ink[:-1])) | edge[:-1]))
    end = np.flatnonzero(ink & (np.concatenate((~ink[1:], [True])) | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


class Terms:
    """The terms of a block of items, and each item's terms by number."""

    def __init__(self, texts: list[bytes]):
        joined = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        start, end, item = term_spans(joined, offsets)
        raw = joined.tobytes()
        words = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        self.words = sorted(set(words))
        number = {w: i for i, w in enumerate(self.words)}
        self.items: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        of: dict[int, set[int]] = {}
        for w, k in zip(words, item.tolist()):
            of.setdefault(k, set()).add(number[w])
        for k, s in of.items():
            self.items[k] = np.array(sorted(s), np.int64)
        size = np.array([len(w) for w in self.words], np.int64)
        self.flat = np.frombuffer(b"".join(self.words), np.uint8)
        self.at = np.concatenate(([0], np.cumsum(size)))[:-1].astype(np.int64)
        self.size = size
        h = span_hash(self.flat, self.at, self.at + size) if len(size) else np.zeros(0, np.uint64)
        self.order = np.argsort(h, kind="stable")
        self.hash = h[self.order]

    def count(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(terms in each document, then of the items' terms: document, term, frequency; by document and term)."""
        flat = LOWER[flat]
        start, end, doc = term_spans(flat, offsets)
        n = np.bincount(doc, minlength=len(offsets) - 1)
        z = np.zeros(0, np.int64)
        if not len(start) or not len(self.hash):
            return n, z, z, z
        h = span_hash(flat, start, end)
        k = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        term = self.order[k]
        near = np.flatnonzero((self.hash[k] == h) & (self.size[term] == end - start))
        start, term, doc = start[near], term[near], doc[near]
        size = self.size[term]
        mine, who = gather(flat, start, size)
        other, _ = gather(self.flat, self.at[term], size)
        wrong = np.bincount(who[mine != other], minlength=len(near)) > 0  # a hash alone proves nothing
        code, tf = np.unique(doc[~wrong] * len(self.words) + term[~wrong], return_counts=True)
        return n, code // max(len(self.words), 1), code % max(len(self.words), 1), tf


class BallTree:
    """Rows of sparse non-negative integer vectors (row starts, terms, values) in nested balls."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int, leaf: int = LEAF):
        self.starts, self.terms, self.values, self.width = starts, terms, values, width
        self.real = values.astype(np.float64)
        self.norm = self._by_row(self.real * self.real, starts)
        self.left: list[int] = []
        self.right: list[int] = []
        self.rows: list[np.ndarray | None] = []
        self.radius: list[float] = []
        spread: list[tuple[np.ndarray, np.ndarray]] = []
        todo = [(np.arange(len(starts) - 1), -1)] if len(starts) > 1 else []
        pivot = np.zeros(width)
        while todo:
            rows, parent = todo.pop()
            me = len(self.rows)
            if parent >= 0:
                (self.left if self.left[parent] < 0 else self.right)[parent] = me
            s, t, v = self._of(rows)
            used, local = np.unique(t, return_inverse=True)
            centre = np.bincount(local, v, minlength=len(used)) / len(rows)
            apart = np.maximum(self.norm[rows] - 2 * self._by_row(v * centre[local], s) + centre @ centre, 0)
            # Rounding of a square root of differences: far above what doubles lose on these sums.
            radius = float(np.sqrt(apart.max() + 1e-9 * (self.norm[rows].max(initial=0) + centre @ centre)))
            self.left.append(-1), self.right.append(-1), self.rows.append(None), self.radius.append(radius)
            spread.append((used, centre))
            side = None
            if len(rows) > leaf and apart.max() > 1e-6 * (1 + self.norm[rows].max()):
                far = self._distance(int(rows[int(apart.argmax())]), rows, s, t, v, pivot)
                away = self._distance(int(rows[int(far.argmax())]), rows, s, t, v, pivot)
                side = far <= away
                if side.all() or not side.any():
                    side = None
            if side is None:
                self.rows[me] = rows
            else:
                todo += [(rows[side], me), (rows[~side], me)]
        # Centroids by term: the nodes that have it, and how much.
        nodes = np.repeat(np.arange(len(spread)), [len(u) for u, _ in spread]) if spread else np.zeros(0, np.int64)
        term = np.concatenate([u for u, _ in spread]) if spread else np.zeros(0, np.int64)
        share = np.concatenate([c for _, c in spread]) if spread else np.zeros(0)
        order = np.argsort(term, kind="stable")
        self.c_nodes, self.c_share, self.c_at = nodes[order], share[order], np.searchsorted(term[order], np.arange(width + 1))

    @staticmethod
    def _by_row(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(x)))
        return total[starts[1:]] - total[starts[:-1]]

    def _of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.starts[rows + 1] - self.starts[rows]
        starts = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], size)
        return starts, self.terms[at], self.real[at]

    def _distance(self, row: int, rows, s, t, v, pivot) -> np.ndarray:
        a, b = self.starts[row], self.starts[row + 1]
        pivot[self.terms[a:b]] = self.real[a:b]
        out = self.norm[rows] - 2 * self._by_row(v * pivot[t], s) + self.norm[row]
        pivot[self.terms[a:b]] = 0
        return out

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """For each node, a number that no inner product of its rows with the 0/1 vector of ``query`` exceeds."""
        out = np.sqrt(len(query)) * np.array(self.radius)
        for q in query.tolist():
            a, b = self.c_at[q], self.c_at[q + 1]
            out[self.c_nodes[a:b]] += self.c_share[a:b]
        return np.ceil(out * (1 + 1e-9)) + 1

    def best(self, query: np.ndarray, order: np.ndarray, held: list, k: int, least: int) -> int:
        """Puts rows into ``held``, a heap of (score, -order, row number in ``order``) of
        ``k`` entries at most, that score at least ``least`` and more than 0. -> leaves opened."""
        if not self.rows:
            return 0
        bound = self.bounds(query)
        opened, heap = 0, [(-bound[0], 0)]
        wanted = np.zeros(self.width, bool)
        wanted[query] = True
        while heap:
            b, node = heapq.heappop(heap)
            if -b < max(held[0][0] if len(held) == k else 1, least):
                break
            rows = self.rows[node]
            if rows is None:
                for child in (self.left[node], self.right[node]):
                    heapq.heappush(heap, (-bound[child], child))
                continue
            opened += 1
            size = self.starts[rows + 1] - self.starts[rows]
            starts = np.concatenate(([0], np.cumsum(size)))
            at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], size)
            total = np.concatenate(([0], np.cumsum(np.where(wanted[self.terms[at]], self.values[at], 0))))
            score = total[starts[1:]] - total[starts[:-1]]
            floor = max(held[0][0] if len(held) == k else 1, least)
            good = np.flatnonzero(score >= floor)
            if len(good) > k:
                good = good[np.lexsort((order[rows[good]], -score[good]))[:k]]
            for g in good.tolist():
                entry = (int(score[g]), -int(order[rows[g]]))
                if len(held) < k:
                    heapq.heappush(held, entry)
                elif entry > held[0]:
                    heapq.heapreplace(held, entry)
        return opened


_LAST = (1 << 63) - 1  # the place of a null doc_id


def _vectors(docs: DataFrame, terms) -> DataFrame:
    """doc_id, n, and the numbers and frequencies of the items' terms, for documents with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for b in batches:
            flat, offsets = doc_bytes(b.column(1))
            for i, j in byte_chunks(offsets, CHUNK):
                n, doc, term, tf = known.count(flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                at = pa.array(np.searchsorted(doc, np.arange(j - i + 1)), pa.int32())
                out = pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(term, pa.int32())),
                                                  pa.ListArray.from_arrays(at, pa.array(tf, pa.int64()))], names=["doc_id", "n", "term", "tf"])
                yield out.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n bigint, term array<int>, tf array<bigint>")


def _searched(vectors: DataFrame, plan, k: int) -> DataFrame:
    """Each task's best of its documents: item (number), doc_id, score."""

    def trees(batches):
        ids, n, sizes, term, tf, rows = [], [], [], [], [], 0
        for b in batches:
            for i in range(0, b.num_rows, TREE):
                part = b.slice(i, TREE)
                ids.append(part.column(0))
                n.append(part.column(1).to_numpy(zero_copy_only=False))
                sizes.append(part.column(2).value_lengths().to_numpy(zero_copy_only=False))
                term.append(part.column(2).flatten().to_numpy(zero_copy_only=False))
                tf.append(part.column(3).flatten().to_numpy(zero_copy_only=False))
                rows += part.num_rows
                if rows >= TREE:
                    yield ids, n, sizes, term, tf
                    ids, n, sizes, term, tf, rows = [], [], [], [], [], 0
        if rows:
            yield ids, n, sizes, term, tf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, docs, length, least = plan.value
        held: list[list] = [[] for _ in items]
        for ids, n, sizes, term, tf in trees(batches):
            size, terms, times = np.concatenate(sizes).astype(np.int64), np.concatenate(term).astype(np.int64), np.concatenate(tf)
            m = 10 + (90 * np.concatenate(n) * docs) // length
            value = weight[terms] * ((1000000000 * times) // (1000 * times + 8 * np.repeat(m, size)))
            order = pa.chunked_array(ids).fill_null(_LAST).to_numpy()
            tree = BallTree(np.concatenate(([0], np.cumsum(size))), terms, value, len(weight))
            for i, query in enumerate(items):
                if len(query):
                    tree.best(query, order, held[i], k, int(least[i]))
        rows = [(i, None if -o == _LAST else -o, s) for i, h in enumerate(held) for s, o in h]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 3)], names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item with their rank: first in salted parts, then of what these leave."""
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).where(F.col("rank") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= k).drop("part")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """``docs(doc_id, text)`` for ``items(item_id, text)`` -> item_id, rank, doc_id, score:
    the ``k`` documents of each item with the highest scores above 0."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for b, (ids, texts) in enumerate(item_blocks(items, block_bytes)):
        terms = Terms(texts)
        vectors = cut(_vectors(docs, spark.sparkContext.broadcast(terms)))
        total = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
        if not total.docs or not terms.words:
            continue
        df = np.zeros(len(terms.words), np.int64)
        for r in vectors.select(F.explode("term").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():  # a row a term of the block
            df[r.t] = r.df
        weight = np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df + 1))).astype(np.int64)

        def best(of: DataFrame, least) -> DataFrame:
            return _top(_searched(of, spark.sparkContext.broadcast((terms.items, weight, total.docs, total.length, least)), k), k)

        least = np.ones(len(ids), np.int64)
        sample = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(PARTS)) == 0)
        for r in best(sample, least).where(F.col("rank") == k).select("item", "score").collect():  # a row an item of the block
            least[r.item] = r.score
        named = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "item bigint, item_id bigint")
        found = best(vectors, least).join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if b == 0 else out.unionByName(found)
    return out
