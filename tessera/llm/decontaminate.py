"""Benchmark decontamination by a random-walk embedding, bit sampling and exact edit distance.

From each byte a walk of ``STEPS`` steps reads the byte it stands on and then stays
or goes on, as a random bit fixed for the step and the byte says (the CGK embedding).
Two walks that meet an edit fall in with each other again with a fair chance, so
strings a few edits apart become words of equal length with few differing places. A
sample of ``PLACES`` of the places is a bucket key; ``SAMPLES`` samples make the repeats. Walks
begin at every byte of items and texts, so that an item of L bytes has about L / 5 chances
even if the edits, a fifth of its length, are spread evenly. Walks that share a
bucket are counted by item and diagonal (place in the text less place in the
item) in overlapping bands; a band with walks in ``least_cells`` stretches of the item
is a window. The least edits of an item's chunks together are no more than the item's, so a window is
verified by the edit distances of its chunks first, and of the whole item where these do
not add up to more than its limit, many windows at a time. Recall at the limit is measured in the tests, by length and kind of edit.

Items shorter than ``SHORT`` bytes have too few walks. For them the keys are
their strings of q bytes; k edits of L bytes leave L + 1 - q (k + 1) of these, and a band with so
many is a window, so every match is found.

Texts are compared as UTF-8 bytes with A-Z lowered and white space as spaces; an
item of L bytes counts with at most ``edits * L`` edits.

Defined cases: null and empty texts and items match nothing; a null doc_id or item_id is carried; of several places
with the fewest edits the first found is reported; repeated
rows each have their own hits; other columns are ignored; empty tables give no
rows. A text is searched as a whole, in memory that grows with the longest one. Items reach the tasks in blocks of at most ``block_bytes``, one pass over
the texts for each block, so what is sent is bounded however many items there are.
"""

from __future__ import annotations

from collections import defaultdict
from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, byte_chunks, doc_bytes, mix64, release

__all__ = ["Index", "edit_match", "edit_matches", "item_blocks", "hits", "clean"]

#: bytes from which on items are found by walks; steps of a walk, places in a sample, samples; bytes of an item counted once; diagonals of a band
SHORT, STEPS, PLACES, SAMPLES, CELL, BAND = 80, 20, 12, 6, 16, 32
#: bytes searched at a time, walks begun at a time (they stay in a core's cache), bytes of a chunk of an item at most, chunks and whole items verified at a time
CHUNK, PIECE, PART, BATCH, WHOLE = 1 << 20, 1 << 14, 64, 1 << 13, 512
_FOLD = LOWER.copy()
_FOLD[[9, 10, 11, 12, 13]] = 32
#: places of a key's table: at most 2 ** _BITS, 2 ** SPARE times the keys, so that it stays in a core's cache
_BITS, SPARE = 22, 4
_random = mix64(np.arange(1, STEPS * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_GO_ON = (_random >> np.uint64(63)).astype(np.int64).reshape(STEPS, 256)
_SAMPLED = [sorted(np.argsort(mix64(np.arange(STEPS, dtype=np.uint64) + np.uint64(1000 * (s + 1))))[:PLACES].tolist()) for s in range(SAMPLES)]
#: a key is a polynomial: (sample, power) of each step, what a key begins with; and for each byte a bit for each step
_POWERS = np.array([pow(0x9E3779B1, i, 1 << 32) for i in range(PLACES + 1)], np.uint32)
_POWER_AT = [[(s, PLACES - 1 - sampled.index(j)) for s, sampled in enumerate(_SAMPLED) if j in sampled] for j in range(STEPS)]
_FIRST = np.arange(1, SAMPLES + 1, dtype=np.uint32) * _POWERS[PLACES]
_GO_BITS = (_GO_ON[:-1] << np.arange(33 - STEPS, 32)[:, None]).sum(0).astype(np.uint32).view(np.int32)
_HALF, _MIX = np.uint32(15), np.uint32(0x85EBCA6B)


def normal(flat: np.ndarray) -> np.ndarray:
    return _FOLD[flat]


def edit_match(item: bytes, text: bytes) -> tuple[int, int]:
    """(least edits between the item and any substring of the text, end of the first such substring), bit-parallel."""
    m = len(item)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(item):
        peq[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, dist, best = full, 0, m, (m, 0)
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        d0 = ((((eq & pv) + pv) ^ pv) | eq | mv) & full
        ph, mh = mv | (full & ~(d0 | pv)), pv & d0
        if ph & top:
            dist += 1
        elif mh & top:
            dist -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (full & ~(d0 | ph)), ph & d0
        if dist < best[0]:
            best = dist, j + 1
    return best


def edit_matches(peq: np.ndarray, which: np.ndarray, sizes: np.ndarray, flat: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``edit_match`` of many strings with flat[lo:hi] at once. ``peq[word, string * 256 + byte]``
    are the places of a byte in a string, 64 to a word; ``which`` and ``sizes``: the strings and their lengths."""
    words, n = peq.shape[0], len(which)
    pv, mv = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    at, bit, pairs, one = (sizes - 1) // 64, ((sizes - 1) % 64).astype(np.uint64), np.arange(n), np.uint64(1)
    row, last = which * 256, len(flat) - 1
    dist = sizes.astype(np.int64)
    best, end = dist.copy(), np.zeros(n, np.int64)
    for j in range(int((hi - lo).max(initial=0))):
        eq = peq.take(row + flat.take(np.minimum(lo + j, last)), axis=1)
        both = eq & pv
        total = both + pv
        if words > 1:
            over = total < both
            for w in range(1, words):
                more = over[w - 1].view(np.uint8).astype(np.uint64)
                total[w] += more
                over[w] |= total[w] < more
        d0 = (total ^ pv) | eq | mv
        ph, mh = mv | ~(d0 | pv), pv & d0
        dist += ((ph[at, pairs] >> bit) & one).view(np.int64) - ((mh[at, pairs] >> bit) & one).view(np.int64)
        up, down = ph[:-1] >> np.uint64(63), mh[:-1] >> np.uint64(63)
        ph, mh = ph << one, mh << one
        ph[1:] |= up
        mh[1:] |= down
        pv, mv = mh | ~(d0 | ph), ph & d0
        better = np.flatnonzero((dist < best) & (lo + j < hi))
        best[better], end[better] = dist[better], j + 1
    return best, end


def edits_at_most(peq: np.ndarray, which: np.ndarray, sizes: np.ndarray, flat: np.ndarray, lo: np.ndarray, steps: int, every: int = 1) -> np.ndarray:
    """The least edits of ``edit_matches`` for strings of up to 64 bytes, each against ``steps`` bytes from ``lo`` on.
    Looked at after ``every`` bytes only, as they change by one with a byte: then at least so many."""
    n, row = len(which), which * 256
    pv, mv, own = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64), ~np.uint64(0) >> (64 - sizes).astype(np.uint64)
    eq, d0, ph, at, up, down = (np.empty(n, kind) for kind in (np.uint64, np.uint64, np.uint64, np.int64, np.uint8, np.uint8))
    best = sizes.astype(np.uint8)
    text = np.concatenate((flat, np.zeros(steps + 8, np.uint8)))
    eight = np.ndarray(len(text) - 7, "<i8", text, 0, (1,))  # the eight bytes from each byte on
    for j in range(steps):
        if j % 8 == 0:
            read = eight[lo + j]
        np.bitwise_and(read, 255, out=at)
        at += row
        read >>= 8
        peq.take(at, out=eq, mode="clip")
        np.bitwise_and(eq, pv, out=d0)
        d0 += pv
        d0 ^= pv
        d0 |= eq
        d0 |= mv
        np.bitwise_or(d0, pv, out=ph)
        np.invert(ph, out=ph)
        ph |= mv
        pv &= d0
        ph += ph
        pv += pv
        np.bitwise_and(ph, d0, out=mv)
        d0 |= ph
        np.invert(d0, out=d0)
        pv |= d0
        if j % every == every - 1 or j == steps - 1:
            # Each place of the string adds an edit, takes one off or neither.
            np.bitwise_count(np.bitwise_and(pv, own, out=eq), out=up)
            np.bitwise_count(np.bitwise_and(mv, own, out=eq), out=down)
            up -= down
            np.minimum(best, up, out=best)
    return np.maximum(best.astype(np.int64) - every // 2, 0)


def places_of(strings: list[bytes]) -> np.ndarray:
    """The ``peq`` of ``edit_matches``."""
    out = np.zeros((max(-(-max(map(len, strings), default=1) // 64), 1), max(len(strings), 1), 256), np.uint64)
    for k, s in enumerate(strings):
        i = np.arange(len(s))
        np.bitwise_or.at(out[:, k], (i // 64, np.frombuffer(s, np.uint8)), np.uint64(1) << (i % 64).astype(np.uint64))
    return out.reshape(len(out), -1)


def walks(flat: np.ndarray) -> list[np.ndarray]:
    """For each sample, the key of the walk from each byte on; walks that leave the bytes are left out.
    From the last step to the first, a place's key is its byte and the key of the place where the next step stands, its own or the one behind."""
    n = max(len(flat) - STEPS + 1, 0)
    out = [np.empty(n, np.uint32) for _ in range(SAMPLES)]
    shape = min(PIECE, n) + STEPS
    room = [np.empty((rows, shape), np.uint32) for rows in (SAMPLES, SAMPLES, PLACES)]
    for a in range(0, n, PIECE):
        size = min(PIECE, n - a)
        part = flat[a:a + size + STEPS - 1]
        keys, other, read = (x[:, :len(part)] for x in room)
        wide, bits = part.astype(np.uint32), _GO_BITS.take(part, mode="clip")
        for power in range(PLACES):
            np.multiply(wide, _POWERS[power], out=read[power])
        keys[:] = 0
        for j in range(STEPS - 1, -1, -1):
            m = size + j
            here = keys[:, :m]
            if j < STEPS - 1:
                # The sign bit says whether the walk goes on; the next step's bit takes its place.
                step = np.bitwise_xor(here, keys[:, 1:m + 1], out=other[:, :m])
                step &= (bits[:m] >> 31).view(np.uint32)
                here ^= step
                bits += bits
            for s, power in _POWER_AT[j]:
                key = here[s]
                key += read[power, :m]
        for s, o in enumerate(out):
            key = keys[s, :size]
            key += _FIRST[s]
            key ^= key >> _HALF
            np.multiply(key, _MIX, out=o[a:a + size])
    return out


def grams(q: int, flat: np.ndarray) -> list[np.ndarray]:
    """The strings of q bytes from each byte on."""
    n = len(flat) - q + 1
    out = np.zeros(max(n, 0), np.uint32)  # four bytes at most
    for k in range(q if n > 0 else 0):
        out = (out << np.uint32(8)) | flat[k:n + k]
    return [out * np.uint32(0x9E3779B1)]  # one key a string, its upper bits mixed


class _Keys:
    """Keys of one kind of a block's items, and where they are from."""

    def __init__(self, of, items: list[bytes], which: list[int], reach: int):
        self.of, found = of, []
        for k in which:
            for s, x in enumerate(of(np.concatenate((np.frombuffer(items[k], np.uint8), np.zeros(reach, np.uint8))))):
                n = min(len(x), len(items[k]))
                found.append((s, x[:n], np.full(n, k), np.arange(n)))
        self.tables = []
        for s in sorted({f[0] for f in found}):
            key, who, off = (np.concatenate([f[c] for f in found if f[0] == s]) for c in (1, 2, 3))
            order = np.argsort(key, kind="stable")
            bits = min(_BITS, len(key).bit_length() + SPARE)
            table = np.zeros(1 << bits, bool)
            table[self._slot(key, bits)] = True
            key, begin = np.unique(key[order], return_index=True)
            # Where the keys of each two leading bits fewer than the table's begin; behind the last key one that none is above.
            first = np.searchsorted(key, np.arange(1 << bits - 2, dtype=np.uint32) << np.uint32(34 - bits)).astype(np.int32)
            self.tables.append((np.append(key, ~np.uint32(0)), np.append(begin, len(order)), who[order], off[order], table, first))

    @staticmethod
    def _slot(key: np.ndarray, bits: int) -> np.ndarray:
        return (key >> np.uint32(32 - bits)).astype(np.int64)

    def shared(self, flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(places in ``flat``, how many equal keys each has, which these are, item and place in the item of every key), some millions at a time."""
        for (key, begin, who, off, table, first), x in zip(self.tables, self.of(flat)):
            bits = len(table).bit_length() - 1
            near = [np.flatnonzero(table.take(self._slot(x[a:a + PIECE], bits), mode="clip")) + a for a in range(0, len(x), PIECE)]
            near = np.concatenate(near or [np.zeros(0, np.int64)])
            mine = x.take(near, mode="clip")
            at = first.take(self._slot(mine, bits - 2), mode="clip").astype(np.int64)
            below = np.flatnonzero(key.take(at, mode="clip") < mine)
            while len(below):
                at[below] += 1
                below = below[key.take(at.take(below, mode="clip"), mode="clip") < mine.take(below, mode="clip")]
            here = np.flatnonzero(key.take(at, mode="clip") == mine)
            near, at = near.take(here, mode="clip"), at.take(here, mode="clip")
            lo = begin.take(at, mode="clip")
            n = begin.take(at + 1, mode="clip") - lo
            for i, j in byte_chunks(np.concatenate(([0], np.cumsum(n))), 1 << 21):
                m = n[i:j]
                yield near[i:j], m, np.repeat(lo[i:j] - (np.cumsum(m) - m), m) + np.arange(m.sum()), who, off


class Index:
    """The items of one block, embedded."""

    def __init__(self, ids: list, texts: list[bytes], edits: float = 0.2):
        self.ids, self.items = ids, [normal(np.frombuffer(t, np.uint8)).tobytes() for t in texts]
        self.size = np.array([len(t) for t in self.items], np.int64)
        self.most = (edits * self.size + 1e-9).astype(np.int64)
        kinds: dict[int, list[int]] = defaultdict(list)
        self.least = np.ones(len(self.items), np.int64)
        for k, t in enumerate(self.items):
            if len(t) >= SHORT:
                kinds[0].append(k)
                self.least[k] = least_cells(len(t))
            elif t:
                q = min(len(t) // (int(self.most[k]) + 1), 4)
                kinds[q].append(k)
                self.least[k] = len(t) + 1 - q * (int(self.most[k]) + 1)
        self.keys = [(_Keys(partial(grams, q) if q else walks, self.items, which, 0 if q else STEPS - 1), CELL if not q else 1) for q, which in kinds.items()]
        chunks = [(k, len(t) * c // n, len(t) * (c + 1) // n) for k, t in enumerate(self.items) if t for n in [-(-len(t) // PART)] for c in range(n)]
        self.chunk_at = np.searchsorted([c[0] for c in chunks], np.arange(len(self.items) + 1))
        self.chunk_off, self.chunk_size = (np.array([f(c) for c in chunks], np.int64) for f in (lambda c: c[1], lambda c: c[2] - c[1]))
        self.peq = places_of([self.items[k][a:b] for k, a, b in chunks])[0]

    def windows(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows (document, item, first and last place in the document where the item seems to begin) of bands with enough keys."""
        below, bands, cells = self._spread(offsets)
        seen, of = [np.zeros(0, np.int64)], np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        of = np.append(of, np.full(STEPS, len(offsets) - 2))
        for keys, cell in self.keys:
            # A walk may read on behind its document; that can only add a window to be verified.
            for near, m, pick, who, off in keys.shared(np.concatenate((flat, np.zeros(STEPS - 1, np.uint8)))):
                d = of.take(near, mode="clip")
                shift = np.repeat(near - offsets.take(d, mode="clip") + below * BAND, m)
                shift -= off.take(pick, mode="clip")
                code = np.repeat(d * (len(self.items) * bands * cells * BAND), m)
                code += ((who * bands * cells + off // cell) * BAND).take(pick, mode="clip")
                code += shift % BAND
                shift //= BAND
                shift *= cells * BAND
                code += shift
                seen.append(code)
        seen = np.concatenate(seen)
        if not len(seen):
            return np.zeros((0, 4), np.int64)
        seen.sort()
        cell = seen // BAND
        cell_at = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        code = cell.take(cell_at, mode="clip") // cells
        start = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        count, code = np.diff(np.append(start, len(code))), code.take(start, mode="clip")
        least = self.least.take(code // bands % len(self.items), mode="clip")
        # A band by itself, or with the next one.
        after = np.minimum(np.arange(len(code)) + 1, len(code) - 1)
        joined = (code[after] == code + 1) & (count + count[after] >= least) & ((count < least) | (count[after] < least))
        keep = np.flatnonzero((count >= least) | joined)
        begin, joined = np.append(cell_at.take(start, mode="clip"), len(seen)), joined[keep]
        low, high = self._ends(seen, begin, keep)
        high[joined] = self._ends(seen, begin, keep[joined] + 1)[1] + BAND
        pair, first = code[keep] // bands, (code[keep] % bands - below) * BAND
        return np.stack([pair // len(self.items), pair % len(self.items), first + low, first + high], 1)

    @staticmethod
    def _ends(seen: np.ndarray, begin: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest place, inside its band, of the walks of each of ``bands``."""
        if not len(bands):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = begin[bands + 1] - begin[bands]
        start = np.cumsum(n) - n
        place = seen.take(np.repeat(begin[bands] - start, n) + np.arange(n.sum()), mode="clip") % BAND
        return np.minimum.reduceat(place, start), np.maximum.reduceat(place, start)

    def _spread(self, offsets: np.ndarray) -> tuple[int, int, int]:
        """Bands of places before a document's first byte, bands in all, and cells of an item."""
        most = int(self.size.max(initial=0))
        below = most // BAND + 2
        return below, int(np.diff(offsets).max(initial=0)) // BAND + below + 2, max(most // CELL, SHORT) + 2

    def find(self, flat: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item, start, end, edits) of each document and item that match, the fewest edits first found."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for i, j in byte_chunks(offsets, CHUNK):
            part, local = normal(flat[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i]
            _, bands, cells = self._spread(local)
            docs = max((1 << 62) // max(len(self.items) * bands * cells * BAND, 1), 1)  # whose places are numbered in 64 bits
            for a in range(0, j - i, docs):
                some = local[a:a + docs + 1]
                text = part[some[0]:some[-1]]
                for d, k, n, s, e in self._verified(text, some - some[0], self.windows(text, some - some[0])):
                    best[(d + a + i, k)] = min(best.get((d + a + i, k), (n, s, e)), (n, s, e))
        return [(d, k, s, e, n) for (d, k), (n, s, e) in sorted(best.items())]

    def _verified(self, part: np.ndarray, local: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, edits, start, end) of the windows that match."""
        d, k, first, last = found.T
        # The least edits of an item's chunks together are no more than those of the item; 1, 1, 2, 4, 8... chunks at a time.
        left, chunks, done = self.most[k], self.chunk_at[k + 1] - self.chunk_at[k], 0
        alive = np.arange(len(found))
        while len(some := alive[chunks[alive] > done]):
            upto = max(done * 2, 1)
            n = np.minimum(chunks[some], upto) - done
            row = np.repeat(some, n)
            chunk = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.chunk_at[k[some]] + done, n)
            lo, hi = self._between(local, d[row], self.most[k[row]], first[row] + self.chunk_off[chunk], last[row] - first[row] + self.chunk_size[chunk])
            order = np.argsort(hi - lo, kind="stable")
            for a in range(0, len(order), BATCH):
                x = order[a:a + BATCH]
                np.subtract.at(left, row[x], edits_at_most(self.peq, chunk[x], self.chunk_size[chunk[x]], part, lo[x], int((hi - lo)[x[-1]]), every=4))
            alive, done = alive[left[alive] >= 0], upto
        d, k, first, last = found[alive].T
        lo, hi = self._between(local, d, self.most[k], first, last - first + self.size[k])
        order = np.lexsort((hi - lo, self.size[k]))
        for a in range(0, len(order), WHOLE):
            x = order[a:a + WHOLE]
            if len(x) < 32 or self.size[k[x[-1]]] > 1024:  # few, or many words a step: one by one
                got = np.array([edit_match(self.items[k[i]], part[lo[i]:hi[i]].tobytes()) for i in x], np.int64).reshape(-1, 2).T
            else:
                own, which = np.unique(k[x], return_inverse=True)
                got = edit_matches(places_of([self.items[i] for i in own]), which, self.size[k[x]], part, lo[x], hi[x])
            for i, dist, end in zip(x.tolist(), *(g.tolist() for g in got)):
                if dist <= self.most[k[i]]:
                    item, at = self.items[k[i]], int(lo[i])
                    _, size = edit_match(item[::-1], part[at:at + end][::-1].tobytes()[:len(item) + dist])
                    begin = int(local[d[i]])
                    yield int(d[i]), int(k[i]), dist, at + end - size - begin, at + end - begin

    @staticmethod
    def _between(local: np.ndarray, d: np.ndarray, most: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``size`` bytes from ``first`` on, and ``most`` on both sides, inside the document."""
        a, b = local[d], local[d + 1]
        lo = np.clip(a + first - most, a, b)
        return lo, np.clip(a + first + size + most, lo, b)


def least_cells(size: int) -> int:
    """How many ``CELL`` bytes long stretches of an item must have a walk in common with a text, in a pair of bands."""
    return 1 if size < 110 else 2 if size < 170 else 3 if size < 230 else 4


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[bytes]]]:
    """The items in blocks that are each small enough to send around."""
    items = items.where(F.octet_length("text") > 0).select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = int(total // block_bytes) + 1
    for k in range(n if total else 0):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        yield [r.item_id for r in rows], [r.text.encode() for r in rows]


def hits(docs: DataFrame, items: DataFrame, edits: float = 0.2, block_bytes: int = 4 << 20) -> DataFrame:
    """``docs(doc_id, text)`` against ``items(item_id, text)`` -> doc_id, item_id,
    start, end (bytes of the text), edits: one row for each matching pair."""
    schema = "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint"
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for k, (ids, texts) in enumerate(item_blocks(items, block_bytes)):
        index = docs.sparkSession.sparkContext.broadcast(Index(ids, texts, edits))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                doc_ids, x = b.column(0).to_pylist(), index.value
                rows = [(doc_ids[d], x.ids[k], s, e, n) for d, k, s, e, n in x.find(*doc_bytes(b.column(1)))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=["doc_id", "item_id", "start", "end", "edits"])

        found = docs.mapInArrow(run, schema)
        out = found if k == 0 else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, edits: float = 0.2, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs``, all their columns, that no item matches."""
    at = docs.columns.index("text")
    for ids, texts in item_blocks(items, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(Index(ids, texts, edits))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[d for d, *_ in index.value.find(*doc_bytes(b.column(at)))]] = False
                yield b.filter(pa.array(keep))
            release()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
