"""Token counts by byte-pair merging with a heap over a linked list.

The adjacent pair of lowest rank is popped again and again; the count is the
initial symbols minus the merges, and no identifier is ever made. A character
outside the vocabulary counts as its UTF-8 bytes. No piece of the vocabulary
reaches from a letter into the next word, a line break or the closing punctuation
(read off the vocabulary's own character pairs when it is loaded), so the text is
cut there first and equal cuts are counted once.

Defined cases: null or empty text has no tokens; repeated rows and null ids stay
as they are; other columns are ignored; no rows give no rows; a text without any
cut is one linked list, n log n in its length.
"""

from __future__ import annotations

import functools
import heapq
import re
from typing import Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["Counter", "token_counts"]

SPACE = "▁"


class Counter(dict):
    """Cut of a text -> its tokens; a missing one is merged and remembered. At most twice ``most`` are kept."""

    def __init__(self, path: str, most: int = 600_000):
        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in normal}
        self.most, self.old = most, {}
        pairs = {p[k:k + 2] for p in self.rank for k in range(len(p) - 1)}
        if any(b == SPACE and a != SPACE for a, b in pairs):
            raise ValueError("a piece reaches over a word's start")
        # ``alone`` join with nothing. ``closing`` join with no letter or digit to their left:
        # a cut may stand before them unless one of ``holds`` precedes.
        alone = [c for c in "\n\t\r" if not any(c in x for x in pairs)]
        closing = [c for c in ".,;:!?\"')" if not any(b == c and a.isalpha() for a, b in pairs)]
        holds = {a for a, b in pairs if b in closing and a not in closing and a != SPACE}
        one = f"[^{SPACE}{self._set(alone + closing)}]"
        if closing and holds:
            one = f"(?:{one}|(?<=[{self._set(holds)}])[{self._set(closing)}]+)"
        first = f"{SPACE}+[{self._set(closing)}]*|[{self._set(closing)}]+" if closing else f"{SPACE}+"
        self.cuts = re.compile("|".join([f"[{self._set(alone)}]"] * bool(alone) + [f"(?:{first}){one}*", f"{one}+"])).findall

    @staticmethod
    def _set(chars) -> str:
        return "".join(map(re.escape, sorted(chars)))

    def __missing__(self, cut: str) -> int:
        if len(cut) > 64:
            return self.merged(cut)
        if len(self) >= self.most:  # what was used since the last turn-over comes back from ``old``
            self.old = dict(self)
            self.clear()
        n = self.old.get(cut)
        n = self[cut] = self.merged(cut) if n is None else n
        return n

    def merged(self, s: str) -> int:
        """Initial symbols minus merges."""
        rank, n = self.rank, len(s)
        symbols = sum(1 if c in rank else len(c.encode()) for c in s)
        piece, after, before = list(s), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, s[i:i + 2]) for i in range(n - 1) if (r := rank.get(s[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not piece[i] or j >= n or len(piece[i]) + len(piece[j]) != len(both) or piece[i] + piece[j] != both:
                continue  # one of the two has merged otherwise meanwhile
            piece[i], piece[j] = both, ""
            symbols -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(both + piece[k])) is not None:
                    heapq.heappush(heap, (r, i, both + piece[k]))
            h = before[i]
            if h >= 0 and (r := rank.get(piece[h] + both)) is not None:
                heapq.heappush(heap, (r, h, piece[h] + both))
        return symbols

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.cuts(SPACE + text.replace(" ", SPACE))))


@functools.lru_cache(2)
def loaded(path: str) -> Counter:
    """The worker's own counter, kept from task to task with what it has counted."""
    return Counter(path)


def token_counts(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_bytes (UTF-8), n_tokens."""
    model_path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(model_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([counter.count(t.as_py()) for t in b.column(2)], pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text")) \
        .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
