"""Line deduplication by pairwise alignment.

A window is the shortest run of lines from one line on, or up to one, that reaches ``min_words``
words: a long line alone, or several short ones. Its holder is the smallest document
that has it. A document is aligned with the holders of the windows it shares, rare
ones and frequent ones alike: each window names one partner, so copies in their
thousands or a passage in a third of all documents give one pair a document, never
all pairs of a group, and no line is too frequent to count.

Holder and document are aligned by patience diff (``align``), and each aligned
block of ``min_words`` words or more, followed on both sides as far as the lines are equal, is
deleted from the later document, the one with the larger doc_id. One alignment keeps
one increasing chain and needs lines that stand once. So what is left, each stretch
by itself, is aligned again with the whole holder until nothing more goes, which
finds passages in another order; and what has no line that stands once is anchored at its
windows (``common_lines``), which finds passages that either document repeats. At the
end no run of lines of ``min_words`` words that the holder has is left.

Defined cases: null and empty texts stay as they are; a document without doc_id
neither loses nor takes lines; rows equal in id and text are one document and are
cut alike; of rows that share an id, the one with the smaller text hash is the
earlier; fewer than ``min_words`` words in a row find no partner, but go with a
block that is deleted if an earlier document has them there too;
other columns stay, whatever their names, but for one named like the count, which the
count replaces; a text is split and aligned as a whole, in memory that grows with its lines; no rows give no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_chunks, cut, free_name, mix64, release
from tessera.llm.graph import attach

__all__ = ["align", "aligned", "windows", "common_lines", "deletions", "dedup_lines"]

#: lines of a batch that are matched at a time
CHUNK = 1 << 17


def align(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Patience diff: (i, j, length) of equal runs a[i:i+length] == b[j:j+length], in order in both."""
    out: list[tuple[int, int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        n = 0
        while i + n < k and j + n < m and a[i + n] == b[j + n]:
            n += 1
        if n:
            out.append((i, j, n))
            i, j = i + n, j + n
        n = 0
        while k - n > i and m - n > j and a[k - n - 1] == b[m - n - 1]:
            n += 1
        if n:
            out.append((k - n, m - n, n))
            k, m = k - n, m - n
        if i >= k or j >= m:
            continue
        once: dict[int, list[int]] = {}
        for x in range(i, k):
            e = once.setdefault(a[x], [0, 0, -1, -1])
            e[0], e[2] = e[0] + 1, x
        for y in range(j, m):
            if b[y] in once:
                e = once[b[y]]
                e[1], e[3] = e[1] + 1, y
        anchors = [(x, y) for c, d, x, y in once.values() if c == d == 1]
        if not anchors:
            continue
        anchors.sort()
        tails: list[int] = []
        piles: list[int] = []
        back = [-1] * len(anchors)
        for p, (_, y) in enumerate(anchors):
            q = bisect_left(tails, y)
            back[p] = piles[q - 1] if q else -1
            if q == len(tails):
                tails.append(y)
                piles.append(p)
            else:
                tails[q], piles[q] = y, p
        chain, p = [], piles[-1]
        while p >= 0:
            chain.append(anchors[p])
            p = back[p]
        for x, y in reversed(chain):
            todo.append((i, x, j, y))
            i, j = x, y
        todo.append((i, k, j, m))  # begins with the last anchor itself, as every stretch but the first does
    out.sort()
    runs: list[tuple[int, int, int]] = []
    for x, y, n in out:
        if runs and runs[-1][0] + runs[-1][2] == x and runs[-1][1] + runs[-1][2] == y:
            runs[-1] = (runs[-1][0], runs[-1][1], runs[-1][2] + n)
        else:
            runs.append((x, y, n))
    return runs


def aligned(held: list[int], own: list[int], words: list[int], common: np.ndarray, min_words: int) -> np.ndarray:
    """Lines of ``own`` in blocks of ``min_words`` words or more aligned with ``held``.
    ``common`` marks the lines that some such block has: a stretch without one is not
    aligned again, and those that no alignment reaches are anchored there."""
    gone, n, m = np.zeros(len(own), bool), len(own), len(held)
    todo = [(0, n)]
    while todo:
        left: list[int] = []
        for p, q in todo:  # a line of its own parts the stretches
            left += own[p:q]
            left.append(-1)
        place = np.concatenate([np.append(np.arange(p, q), -1) for p, q in todo]).tolist()
        before = int(gone.sum())
        for x, y, size in align(held, left):
            j = place[y]
            if j < 0 or gone[j]:
                continue
            a, b, i, k = j, j + size, x, x + size
            while a and i and own[a - 1] == held[i - 1]:
                a, i = a - 1, i - 1
            while b < n and k < m and own[b] == held[k]:
                b, k = b + 1, k + 1
            if sum(words[a:b]) >= min_words:
                gone[a:b] = True
        rest = common & ~gone
        if int(gone.sum()) == before:
            return gone | rest
        edge = np.flatnonzero(np.diff(np.concatenate(([False], rest, [False])).astype(np.int8)))
        todo = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
    return gone


def windows(hs: np.ndarray, ws: np.ndarray, offsets: np.ndarray, min_words: int, back: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the shortest runs of lines that reach ``min_words`` words and
    begin at a line, or with ``back`` end with it; runs stay inside their document
    (``offsets``). Equal runs of lines have equal hashes wherever they stand."""
    n = len(hs)
    first = np.repeat(offsets[:-1], np.diff(offsets))
    last = np.repeat(offsets[1:], np.diff(offsets))
    total = np.concatenate(([0], np.cumsum(ws, dtype=np.int64)))
    at = np.arange(n)
    if back:
        start, end = np.minimum(np.searchsorted(total, total[1:] - min_words, side="right") - 1, at), at + 1
        inside = start >= first
    else:
        start, end = at, np.maximum(np.searchsorted(total, total[:-1] + min_words, side="left"), at + 1)
        inside = end <= last
    start, end = start[inside], end[inside]
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64))), dtype=np.uint64)
        under = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64))), dtype=np.uint64)
        h = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(hs.astype(np.uint64)) * power[:n], dtype=np.uint64)))
        return start, end, mix64((h[end] - h[start]) * under[start])


def common_lines(hs: np.ndarray, ws: np.ndarray, offsets: np.ndarray, held: np.ndarray, held_offsets: np.ndarray, min_words: int) -> np.ndarray:
    """For each line of documents beside their partners: does it lie in a run of lines of
    ``min_words`` words or more that the partner has as well, wherever it has it?"""
    known, where = np.unique(hs, return_index=True)
    k = np.minimum(np.searchsorted(known, held), len(known) - 1)
    held_ws = np.where(known[k] == held, ws[where[k]], 1) if len(known) else np.ones(len(held), np.int64)
    edge = np.zeros(len(hs) + 1, np.int64)
    for back in (False, True):
        keys = []
        for x, w, o in ((hs, ws, offsets), (held, held_ws, held_offsets)):
            start, end, h = windows(x, w, o, min_words, back)
            pair = (np.searchsorted(o, start, side="right") - 1).astype(np.uint64)
            with np.errstate(over="ignore"):
                keys.append((start, end, h + mix64(pair + np.uint64(1))))
        start, end, h = keys[0]
        same = np.isin(h, keys[1][2])
        np.add.at(edge, start[same], 1)
        np.add.at(edge, end[same], -1)
    return np.cumsum(edge)[:-1] > 0


def _words(line):
    return F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def deletions(docs: DataFrame, min_words: int = 6) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, text_hash, gone (positions of the lines to delete)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = [np.concatenate(([0], np.cumsum(pc.list_value_length(b.column(c)).to_numpy(zero_copy_only=False), dtype=np.int64))) for c in (1, 3)]
            for p, q in byte_chunks(size[0] + size[1], CHUNK):
                hs, ws, held = (c.slice(p, q - p).flatten().to_numpy(zero_copy_only=False) for c in b.columns[1:])
                at, to = (x[p:q + 1] - x[p] for x in size)
                common = common_lines(hs, ws, at, held, to, min_words)
                hs, ws, held = (np.where(hs == -1, 0, hs)).tolist(), ws.tolist(), np.where(held == -1, 0, held).tolist()
                gone = [np.flatnonzero(aligned(held[k:m], hs[i:j], ws[i:j], common[i:j], min_words))
                        for i, j, k, m in zip(at.tolist(), at[1:].tolist(), to.tolist(), to[1:].tolist())]
                keep = [r for r, x in enumerate(gone) if len(x)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([p + r for r in keep], pa.int64())),
                                                  pa.array([gone[r] for r in keep], pa.list_(pa.int32()))], names=["doc", "gone"])
        release()

    lines = F.split("text", "\n")
    own = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text <> ''")
           .select("doc_id", F.xxhash64("text").alias("text_hash"), F.transform(lines, lambda x: F.xxhash64(x)).alias("hs"), F.transform(lines, _words).alias("ws")))
    # One narrow row per document; ``doc`` names it in the tables that follow.
    own = cut(own.withColumn("doc", F.xxhash64("doc_id", "text_hash")))

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.concatenate(([0], np.cumsum(pc.list_value_length(b.column(3)).to_numpy(zero_copy_only=False), dtype=np.int64)))
            for p, q in byte_chunks(size, CHUNK):
                hs, ws = (c.slice(p, q - p).flatten().to_numpy(zero_copy_only=False) for c in b.columns[3:])
                at = size[p:q + 1] - size[p]
                # Runs that begin with a line and runs that end with one: mostly the same, so few more rows.
                start, end, h = (np.concatenate(x) for x in zip(windows(hs, ws, at, min_words), windows(hs, ws, at, min_words, back=True)))
                inked = (ws[start] > 0) | (ws[end - 1] > 0)
                start, h = start[inked], h[inked].view(np.int64)
                doc = np.searchsorted(at, start, side="right") - 1
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))[:len(doc)]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(doc[new] + p)) for c in b.columns[:3]), pa.array(h[new])], names=["doc", "doc_id", "text_hash", "h"])

    held = own.select("doc", "doc_id", "text_hash", "hs", "ws").mapInArrow(begun, "doc bigint, doc_id bigint, text_hash bigint, h bigint")
    me = F.struct("doc_id", "text_hash", "doc")
    # Written, so that the join has shuffles of its own, which are split where one window has very many rows.
    holder = cut(held.groupBy("h").agg(F.min(me).alias("first"), F.max(me).alias("last")).where("first <> last").select("h", "first"))
    pairs = cut(held.join(holder, "h").where(F.struct("doc_id", "text_hash") > F.struct("first.doc_id", "first.text_hash"))
                .select("doc", F.col("first.doc").alias("other")).distinct())
    side = own.select("doc", "hs", "ws").dropDuplicates(["doc"])
    rows = pairs.join(side, "doc")
    rows = attach(rows, side.select(F.col("doc").alias("other"), F.col("hs").alias("held")), "other", "doc")
    found = rows.select("doc", "hs", "ws", "held").mapInArrow(run, "doc bigint, gone array<int>")
    found = found.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))  # as many partners as lines at most
    return own.select("doc", "doc_id", "text_hash").dropDuplicates(["doc"]).join(found, "doc").select("doc_id", "text_hash", "gone")


def dedup_lines(docs: DataFrame, min_words: int = 6, count: str = "n_removed") -> DataFrame:
    """All columns of ``docs``, ``text`` without its deleted lines, and the number of these in ``count``."""
    docs = docs.drop(count)
    own_id, own_hash, own_gone = (free_name(docs, x) for x in ("id", "hash", "gone"))
    gone = deletions(docs, min_words).select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("gone").alias(own_gone))
    out = docs.join(gone, (F.col("doc_id").cast("bigint") == F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash)), "left")
    lines = F.split("text", "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(own_gone)), lambda i: lines[i])
    text = F.when(F.col(own_gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return out.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                      F.coalesce(F.size(own_gone), F.lit(0)).cast("bigint").alias(count))
