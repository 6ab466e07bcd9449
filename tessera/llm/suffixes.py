"""Suffix-array deduplication of byte strings across documents.

A byte goes when a string of ``L`` = 50 bytes that covers it also starts in a
document with a smaller doc_id. Which strings are equal is read off suffixes
sorted to depth L by bucket-pointer refinement: suffixes start in buckets of
their first 8 bytes, buckets of more than one are refined by sorting on the bucket
pointers 8 bytes further on, and the new pointers serve at once as keys of the
next refinement, so the depth doubles: 8, 16, 32, 50.

To sort only what can be equal, and equal strings in one task:

1. Documents are dealt once into groups by a hash of doc_id. Of any L-byte string
   the 24-grams of least hash are anchors; the string carries them wherever it
   stands. A group sends the hashes of its anchors, each once, to the hash's
   bucket and learns with one bit which stand in two documents or more.
2. For those a group sends the text around the anchor (26 bytes either way, every
   string of L bytes that holds the anchor), each different one once with its
   smallest doc_id. The bucket sorts the suffixes of unequal surroundings of one
   anchor and answers, for the first document of each, which strings an earlier
   document has; all later documents have the whole surroundings twice.
3. The group marks and cuts.

What a group sends of a passage is one entry, however many documents repeat it,
so a group of copies holding a third of all rows costs each bucket at most one
entry a group. Groups and buckets grow in number with the data, not in size.

Defined cases: null and empty texts lose nothing, nor do documents without
doc_id, whose strings count for no other; rows with one doc_id are not earlier
than each other; repeated rows and further columns change nothing; no rows give
no rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_chunks, doc_bytes, mix64

__all__ = ["refine", "equal_strings", "remove_repeats"]

L, K = 50, 24
W = L - K + 1  # anchors' windows, and strings around an anchor
SPAN = 2 * L - K  # an anchor's surroundings
CHUNK, GROUP = 1 << 20, 6 << 20
OUT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def _extreme(x: np.ndarray, w: int, of) -> np.ndarray:
    """of (minimum or maximum) of each w consecutive values."""
    size = 1
    while size * 2 <= w:
        x = of(x[:-size], x[size:])
        size *= 2
    rest = w - size
    return of(x[:-rest], x[rest:]) if rest else x


def anchors(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all documents and their hashes."""
    at, hashes = [], []
    for i, j in byte_chunks(offsets, CHUNK):
        x = flat[offsets[i]:offsets[j]]
        if len(x) < L:
            continue
        with np.errstate(over="ignore"):
            h, size, base = x.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
            parts = {}
            while size <= 16:
                parts[size] = h
                h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
                size *= 2
            h = mix64(parts[16][:len(x) - K + 1] * np.uint64(pow(base, 8, 1 << 64)) + parts[8][16:][:len(x) - K + 1])
        least = _extreme(h, W, np.minimum)  # of the string at each position
        local = offsets[i:j + 1] - offsets[i]
        for a, z in zip(np.maximum(local[1:] - L + 1, local[:-1]).tolist(), local[1:].tolist()):
            least[a:z] = 0  # a string here would run into the next document
        pad = np.zeros(W - 1, np.uint64)
        top = _extreme(np.concatenate((pad, least, pad)), W, np.maximum)  # the strings that hold a gram
        p = np.flatnonzero((top >= h) & (h > 0))
        at.append(p + offsets[i])
        hashes.append(h[p])
    return (np.concatenate(at), np.concatenate(hashes)) if at else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


class Group:
    """The documents of one group: anchors, and what is sent for them."""

    def __init__(self, doc_ids: np.ndarray, flat: np.ndarray, offsets: np.ndarray, buckets: int):
        self.flat, self.offsets, self.ids, self.buckets = flat, offsets, doc_ids, buckets
        self.at, h = anchors(flat, offsets)
        self.doc = np.searchsorted(offsets, self.at, side="right") - 1
        h = mix64(h ^ np.uint64(0x9E3779B97F4A7C15))  # least hashes are small ones: mixed again, they spread evenly
        # The upper bits name the bucket, so that one order serves buckets and entries; the lower 48 are sent.
        self.bucket = (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(h)
        self.order, s, d = order, h[order], doc_ids[self.doc[order]]
        new = np.ones(len(order), bool)
        new[1:] = s[1:] != s[:-1]
        self.entry = np.cumsum(new) - 1  # of each anchor in this order
        self.head = np.flatnonzero(new)
        self.entry_bucket, self.entry_hash = self.bucket[order[self.head]], s[self.head] & np.uint64((1 << 48) - 1)
        self.several = np.minimum.reduceat(d, self.head) != np.maximum.reduceat(d, self.head) if len(order) else np.zeros(0, bool)

    def by_bucket(self, bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
        names, first = np.unique(bucket, return_index=True)
        yield from zip(names.tolist(), first.tolist(), np.append(first[1:], len(bucket)).tolist())

    def shared(self, answers: dict[int, bytes]) -> np.ndarray:
        """Anchors (as places in ``order``) that two documents have."""
        flag = np.zeros(len(self.head), bool)
        for b, i, j in self.by_bucket(self.entry_bucket):
            flag[i:j] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=j - i).astype(bool)
        return self.order[flag[self.entry]]

    def surroundings(self, which: np.ndarray):
        """Of the anchors ``which``: the different surroundings, sorted by bucket and hash, as
        (bucket, bytes, left, right, smallest doc_id), and the surroundings of each anchor."""
        at, doc = self.at[which], self.doc[which]
        left = np.minimum(at - self.offsets[doc], L - K)
        right = np.minimum(self.offsets[doc + 1] - at - K, L - K)
        pad = np.zeros(L, np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(np.concatenate((pad, self.flat, pad)), SPAN)
        text = view[at + L - (L - K)] if len(at) else np.zeros((0, SPAN), np.uint8)
        place, edge = np.arange(SPAN), np.flatnonzero((left < L - K) | (right < L - K))
        text[edge] *= (place >= (L - K) - left[edge, None]) & (place < L + right[edge, None])
        code = text_hash(text, left, right)
        order = np.argsort(code)
        c = code[order]
        new = np.ones(len(order), bool)
        new[1:] = c[1:] != c[:-1]
        head = np.flatnonzero(new)
        least = np.minimum.reduceat(self.ids[doc][order], head) if len(head) else np.zeros(0, np.int64)
        by = np.argsort(self.bucket[which][order[head]], kind="stable")
        rank = np.empty(len(head), np.int64)
        rank[by] = np.arange(len(head))
        own = np.empty(len(order), np.int64)
        own[order] = rank[np.cumsum(new) - 1]
        head = order[head[by]]
        return self.bucket[which][head], text[head], left[head], right[head], least[by], own


def text_hash(text: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of surroundings."""
    wide = np.zeros((len(text), (SPAN + 9) // 8 * 8), np.uint8)
    wide[:, :SPAN], wide[:, -2], wide[:, -1] = text, left, right
    out = np.zeros(len(text), np.uint64)
    for k, col in enumerate(wide.view(np.uint64).T):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + col + np.uint64(k + 1))
    return out


def refine(pointer: np.ndarray, further: np.ndarray) -> np.ndarray:
    """Buckets of more than one suffix, sorted by the pointers ``further`` on. A pointer
    is the place of a bucket's head among all suffixes; buckets of one stay as they are."""
    flat, nxt = pointer.reshape(-1), further.reshape(-1)
    todo = np.flatnonzero(np.bincount(flat)[flat] > 1)
    order = todo[np.argsort(flat[todo] * (int(nxt.max(initial=0)) + 1) + nxt[todo])]
    b, k = flat[order], nxt[order]
    start = np.ones(len(order), bool)
    start[1:] = b[1:] != b[:-1]
    new = start.copy()
    new[1:] |= k[1:] != k[:-1]
    i = np.arange(len(order))
    out = flat.copy()
    out[order] = b + np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(start, i, 0))
    return out.reshape(pointer.shape)


def _heads(values: np.ndarray) -> np.ndarray:
    """Bucket pointers of suffixes by value: how many suffixes sort before the bucket."""
    _, which, size = np.unique(values.reshape(-1), return_inverse=True, return_counts=True)
    return (np.cumsum(size) - size)[which].reshape(values.shape)


def equal_strings(text: np.ndarray) -> np.ndarray:
    """Bucket pointers, at depth L, of the strings at the first W places of each row of ``text`` (SPAN bytes)."""
    grams = np.zeros((len(text), SPAN - 7), np.uint64)
    for k in range(8):
        grams = (grams << np.uint64(8)) | text[:, k:SPAN - 7 + k]
    p = _heads(grams)
    depth = 8
    while depth < L:
        step = min(depth, L - depth)
        width = p.shape[1] - step  # suffixes nearer to the end do not reach the depth and are left behind
        p = refine(np.ascontiguousarray(p[:, :width]), np.ascontiguousarray(p[:, step:]))
        depth += step
    return p[:, :W]


def _earlier(text: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each entry, W bits: strings that an entry with a smaller doc_id has too."""
    code = text_hash(text, left, right)
    _, first, own = np.unique(code, return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, own, doc)
    place = np.arange(W)
    valid = (place >= (L - K) - left[first][:, None]) & (place <= right[first][:, None])
    found = np.zeros((len(first), W), bool)
    anchor = np.zeros(len(first), np.uint64)
    for k in range(0, K, 8):
        anchor = mix64(anchor + np.ascontiguousarray(text[first, L - K + k:L - K + k + 8]).view(np.uint64)[:, 0])
    _, which, size = np.unique(anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(size[which] > 1)  # one anchor, unequal surroundings
    several = several[np.argsort(which[several], kind="stable")]
    edge = np.flatnonzero(np.concatenate(([True], which[several][1:] != which[several][:-1]))) if len(several) else np.zeros(0, np.int64)
    i = 0
    while i < len(edge):  # as many anchors at a time as fit about 40,000 surroundings
        j = int(np.searchsorted(edge, edge[i] + 40_000, side="right")) - 1
        j = max(j, i + 1) if j < len(edge) - 1 else len(edge)
        rows = several[edge[i]:edge[j] if j < len(edge) else len(several)]
        p = equal_strings(text[first[rows]])
        ok = valid[rows]
        low = np.full(int(p.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, p[ok], np.broadcast_to(least[rows][:, None], p.shape)[ok])
        found[rows] = ok & (low[np.where(ok, p, 0)] < least[rows][:, None])
        i = j
    bits = (found.astype(np.uint32) << np.arange(W, dtype=np.uint32)).sum(1, dtype=np.uint32)
    return np.where(doc > least[own], np.uint32((1 << W) - 1), bits[own])


def _group_of(table: pa.Table, buckets: int) -> Group:
    table = table.combine_chunks()
    text = table.column("text")
    text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
    return Group(table.column("doc_id").to_numpy().astype(np.int64), *doc_bytes(text), buckets)


def _answers(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: x for k, b, x in zip(*(table.column(c).to_pylist() for c in ("kind", "b", "answer"))) if k == kind}


def _table(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * len(schema)
    return pa.table([pa.array(c, t) for c, t in zip(cols, schema.values())], names=list(schema))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_bytes, spans (removed runs [start, end) in bytes), kept (the other bytes)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first().n or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total // GROUP) + 1)
    dealt = docs.where("doc_id IS NOT NULL").withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int"))
    # The same exchange of whole texts serves all three passes over the groups.
    asked = {"b": pa.int32(), "g": pa.int32(), "hi": pa.binary(), "lo": pa.binary(), "several": pa.binary()}
    told = {"kind": pa.int32(), "b": pa.int32(), "g": pa.int32(), "answer": pa.binary()}
    sent = {"b": pa.int32(), "g": pa.int32(), "text": pa.binary(), "sides": pa.binary(), "doc": pa.binary()}
    ddl = lambda s: ", ".join(f"{k} {'int' if t == pa.int32() else 'binary'}" for k, t in s.items())

    def ask(key, table):
        x = _group_of(table, n)
        return _table(asked, [(b, key[0].as_py(), (h >> np.uint64(16)).astype(np.uint32).tobytes(), (h & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), np.packbits(x.several[i:j]).tobytes())
                              for b, i, j in x.by_bucket(x.entry_bucket) for h in [x.entry_hash[i:j]]])

    def tell(key, table):
        rows = list(zip(*(table.column(c).to_pylist() for c in ("g", "hi", "lo", "several"))))
        h = [(np.frombuffer(a, np.uint32).astype(np.uint64) << np.uint64(16)) | np.frombuffer(c, np.uint16) for _, a, c, _ in rows]
        several = np.concatenate([np.unpackbits(np.frombuffer(r[3], np.uint8), count=len(x)) for r, x in zip(rows, h)]).astype(bool)
        _, which, size = np.unique(np.concatenate(h), return_inverse=True, return_counts=True)
        flag, edge = several | (size[which] > 1), np.cumsum([0] + [len(x) for x in h])
        return _table(told, [(0, key[0].as_py(), r[0], np.packbits(flag[i:j]).tobytes()) for r, i, j in zip(rows, edge, edge[1:])])

    def send(key, table, answers):
        if not table.num_rows:
            return _table(sent, [])
        x = _group_of(table, n)
        bucket, text, left, right, doc, _ = x.surroundings(x.shared(_answers(answers, 0)))
        return _table(sent, [(b, key[0].as_py(), text[i:j].tobytes(), np.stack([left[i:j], right[i:j]]).astype(np.uint8).tobytes(), doc[i:j].tobytes())
                             for b, i, j in x.by_bucket(bucket)])

    def sort(key, table):
        rows = list(zip(*(table.column(c).to_pylist() for c in ("g", "text", "sides", "doc"))))
        doc = np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])
        text = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, SPAN)
        sides = np.concatenate([np.frombuffer(r[2], np.uint8).reshape(2, -1) for r in rows], 1).astype(np.int64)
        bits, edge = _earlier(text, sides[0], sides[1], doc), np.cumsum([0] + [len(r[3]) // 8 for r in rows])
        return _table(told, [(1, key[0].as_py(), r[0], bits[i:j].tobytes()) for r, i, j in zip(rows, edge, edge[1:])])

    def remove(key, table, answers):
        out = []
        if table.num_rows:
            x = _group_of(table, n)
            which = x.shared(_answers(answers, 0))
            bucket, _, left, right, first, own = x.surroundings(which)
            bits, found = np.zeros(len(bucket), np.uint32), _answers(answers, 1)
            for b, i, j in x.by_bucket(bucket):
                bits[i:j] = np.frombuffer(found[b], np.uint32)
            later = x.ids[x.doc[which]] > first[own]
            full = np.uint32((1 << W) - 1)
            mask, at, left, right = np.where(later, full, bits[own]), x.at[which], left[own], right[own]
            step = np.zeros(len(x.flat) + 1, np.int32)
            i = np.flatnonzero((mask == full) & (left + K + right >= L))  # all strings around the anchor
            np.add.at(step, at[i] - left[i], 1)
            np.add.at(step, at[i] + K + right[i], -1)
            part = np.flatnonzero((mask != full) & (mask > 0))
            for k in range(W):
                i = part[((mask[part] >> np.uint32(k)) & np.uint32(1)).astype(bool)]
                start = at[i] - (L - K) + k
                np.add.at(step, start, 1)
                np.add.at(step, start + L, -1)
            gone = np.cumsum(step[:-1]) > 0
            for d in range(len(x.ids)):
                a, z = x.offsets[d], x.offsets[d + 1]
                g = gone[a:z]
                turn = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
                out.append((int(x.ids[d]), int(z - a), [{"start": s, "end": e} for s, e in turn.reshape(-1, 2).tolist()], x.flat[a:z][~g].tobytes()))
        return _table({"doc_id": pa.int64(), "n_bytes": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "kept": pa.binary()}, out)

    shared = dealt.groupBy("g").applyInArrow(ask, ddl(asked)).groupBy("b").applyInArrow(tell, ddl(told))
    around = dealt.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(send, ddl(sent))
    answers = shared.unionByName(around.groupBy("b").applyInArrow(sort, ddl(told)))
    out = dealt.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(remove, OUT)
    lone = docs.where("doc_id IS NULL").select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
                                               F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.col("text").cast("binary").alias("kept"))
    return out.unionByName(lone)
