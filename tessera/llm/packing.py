"""Sequence packing by the online sum-of-squares rule.

Each task packs the documents it reads, in order: whole windows are cut off a
document's ids, and the rest goes into the fill level ``h`` that minimises the
sum of the squared counts of partially filled windows. The counts stand in a
level array of ``window`` entries, so one placement is a vector expression over
the levels. Windows leave the task as soon as they are full; those still open at
its end are dealt anew end to end, and the last ids are cut into windows whose
lengths are powers of two, which need no padding. No shuffle; memory is bounded
by the open windows (fewer than the levels in practice) and one Arrow batch.

Defined cases: a null text is empty and still yields its closing id; repeated
rows and repeated ids are packed as they come; a null doc_id is kept; other
columns are ignored; no rows give no pieces.
"""

from __future__ import annotations

import base64
import functools
import re
from typing import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

__all__ = ["encoder", "Packer", "pack"]

SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
#: Scripts whose letters every Unicode version of the last decade knows; other texts
#: go through ``tokenizers`` itself, as the two libraries carry different tables.
_STABLE = re.compile("[^\x00-ɏͰ-ԯ -⁯　-ヿ一-龥가-힣]")


@functools.lru_cache(4)
def encoder(json_path: str, ranks_path: str | None = None) -> Callable[[str], np.ndarray]:
    """Text -> ids of the ``tokenizers`` file as uint32. With the same vocabulary as
    ranks, the faster library computes the same ids."""
    own = Tokenizer.from_file(json_path)
    slow = lambda s: np.array(own.encode(s, add_special_tokens=False).ids, np.uint32)
    if not ranks_path:
        return slow
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {t.content: i for i, t in own.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(s: str) -> np.ndarray:
        if _STABLE.search(s):
            return slow(s)
        return np.array(fast.encode_to_numpy(s, allowed_special="all"), np.uint32)

    return encode


class Packer:
    """Open windows by fill level. ``put`` yields finished windows as lists of
    (document, start, ids); ``finish`` yields the rest."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)  # open windows at each level; 0 and window stay 0
        self.open: list[list] = [[] for _ in range(window + 1)]

    def put(self, doc, ids: np.ndarray) -> Iterator[list]:
        w = self.window
        whole = len(ids) // w * w
        for s in range(0, whole, w):
            yield [(doc, s, ids[s:s + w])]
        size = len(ids) - whole
        if not size:
            return
        # Growth of the sum of squares when a window at level h goes to h + size.
        left = self.count[:w - size + 1]
        gain = 2 * (self.count[size:] - left) + 2
        gain[0] = 2 * self.count[size] + 1  # a new window
        gain[-1] = 1 - 2 * left[-1] if size < w else 0  # a filled window leaves the count
        gain[1:][left[1:] == 0] = np.iinfo(np.int64).max
        h = len(gain) - 1 - int(np.argmin(gain[::-1]))  # of equals, the fullest
        content = self.open[h].pop() if h else []
        self.count[h] -= 1 if h else 0
        content.append((doc, whole, ids[whole:]))
        if h + size == w:
            yield content
        else:
            self.open[h + size].append(content)
            self.count[h + size] += 1

    def finish(self) -> Iterator[list]:
        content, fill = [], 0
        for doc, start, ids in (p for level in reversed(self.open) for c in level for p in c):
            while len(ids):
                n = min(len(ids), self.window - fill)
                content.append((doc, start, ids[:n]))
                start, ids, fill = start + n, ids[n:], fill + n
                if fill == self.window:
                    yield content
                    content, fill = [], 0
        while fill:
            room, part = 1 << (fill.bit_length() - 1), []
            fill -= room
            while room:
                doc, start, ids = content.pop(0)
                part.append((doc, start, ids[:room]))
                if len(ids) > room:
                    content.insert(0, (doc, start + room, ids[room:]))
                room -= len(part[-1][2])
            yield part


def pack(docs: DataFrame, window: int = 1024, end_id: int = 0, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: doc_id, start (ids of its
    document before it), length, doc_tokens (with the closing ``end_id``),
    sequence_id, offset in the sequence, ids (little-endian uint32)."""
    if json_path is None:
        json_path, ranks_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, done, at = encoder(json_path, ranks_path), Packer(window), 0, TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def rows(windows) -> None:
            nonlocal done
            for content in windows:
                offset = 0
                for (doc_id, total), start, ids in content:
                    out.append((doc_id, start, len(ids), total, at + done, offset, ids.astype("<u4").tobytes()))
                    offset += len(ids)
                done += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(cols[6], pa.binary())],
                                              names=[x.split()[0] for x in SCHEMA.split(", ")])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id))
                rows(packer.put((doc_id, len(ids)), ids))
                if len(out) >= 4000:
                    yield flush()
        rows(packer.finish())
        yield flush()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
