"""Shards of nearly equal size by a minimax contiguous partition, in DataFrame expressions only.

Documents of equal text are one atomic group. Groups are ordered by the SHA-256 of
their text; the shards are runs of that order such that the largest run is as small
as can be: the smallest feasible capacity is found by binary search, each capacity
is checked greedily, and the runs are cut where the greedy walk of that capacity
cuts. A group that alone is no smaller than an even share of what is left goes to the front
of the order and has a shard of its own, or one large group of copies would set the
capacity for all.

The walk needs, for a capacity, the last prefix sum of sizes not above a value. The
prefix sums stay in Spark: the driver holds at most ``BLOCKS`` blocks of them
(first, last, count). With a block for what it hides, a walk is known from below
and from above, which bounds the capacity and each cut; only those ranges are asked
for again in finer blocks, until every cut is exact. A round makes the ranges narrower
by about ``BLOCKS`` over the square of the shards (where it does not halve them, four times the
blocks are asked for), so rounds grow with the logarithm of the table.

A shard follows from a text's hash and at most two bounds a shard, so whole texts are dealt out
without a join (``Plan.shard``). Slots come from the ordered scan, in which a group
of copies is spread over many tasks.

Defined cases: a null text is in the group of the empty one; a null doc_id is carried
and comes first in its group; repeated rows each have a slot; other columns are
ignored; an empty table gives no rows, and with fewer groups than shards the last
shards stay empty. The result depends on the rows alone, not on their order.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut
from tessera.operators.ordered import with_rank

__all__ = ["Plan", "minimax_cuts", "assign", "write_shards"]

#: blocks of prefix sums that the driver asks for in one round
BLOCKS = 1 << 14


def text_key(text: Column) -> Column:
    """What names a group: the SHA-256 of its text, 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


@dataclass(frozen=True)
class Plan:
    """Where the order is cut: groups with a shard of their own (key, bytes, rows), and the last key of each other shard but the last."""

    alone: list[tuple[bytes, int, int]]
    ends: list[bytes]
    capacity: int

    def shard(self, key: Column) -> Column:
        out = F.lit(len(self.alone))
        for k in self.ends:
            out = out + (key > F.lit(k)).cast("int")
        for i, (k, _, _) in enumerate(self.alone):
            out = F.when(key == F.lit(k), F.lit(i)).otherwise(out)
        return out.cast("int")

    def before(self, key: Column, part: int) -> Column:
        """Bytes (1) or rows (2) of the groups with a shard of their own that the hash order has before ``key``."""
        out = F.lit(0).cast("bigint")
        for g in self.alone:
            out = out + F.when(key > F.lit(g[0]), F.lit(g[part])).otherwise(0)
        return out


def _walk(flat: list[int], hides: list[bool], capacity: int, shards: int, total: int, above: bool) -> list[int]:
    """The ends of the greedy shards, from the known prefix sums: never later than the true ones, or never earlier with ``above``."""
    ends, base = [], 0
    for _ in range(shards):
        top = base + capacity
        if top >= total:
            ends.append(total)
            break
        i = bisect_right(flat, top) - 1
        base = top if above and i >= 0 and hides[i] else max(flat[i] if i >= 0 else 0, base)
        ends.append(base)
    return ends


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """``ends(at)``: the strictly growing prefix sums of positive sizes, ``total`` the
    last of them, ``largest`` the largest size. -> (smallest capacity with which
    ``shards`` runs hold all, prefix sums at which the greedy runs of that capacity end)."""
    blocks: list[tuple[int, int, int]] = []  # first and last prefix sum, count; in order
    ranges, most, before = [(1, total)], BLOCKS, 0
    while True:
        wide = sum(b - a for a, b in ranges)
        most, before = (most * 4 if 2 * wide > before > 0 else most), wide  # too coarse for so many shards
        share = max(most // len(ranges), 4)
        where, block = F.lit(False), F.lit(None).cast("bigint")
        for r, (a, b) in enumerate(ranges):
            inside, width = F.col("at").between(a, b), -(-(b - a + 1) // share)
            where = where | inside
            block = F.when(inside, F.floor((F.col("at") - a) / F.lit(width)) + r * share).otherwise(block)
        got = ends.where(where).groupBy(block.alias("b")).agg(F.min("at").alias("a"), F.max("at").alias("z"), F.count(F.lit(1)).alias("n")).collect()
        blocks = sorted([x for x in blocks if not any(a <= x[0] <= b for a, b in ranges)] + [(r.a, r.z, r.n) for r in got])
        flat = [v for a, z, _ in blocks for v in (a, z)]
        hides = [v for _, _, n in blocks for v in (n > 2, False)]

        def least(above: bool) -> int:
            lo, hi = max(largest, -(-total // shards)), total
            while lo < hi:
                mid = (lo + hi) // 2
                if _walk(flat, hides, mid, shards, total, above)[-1] == total:
                    hi = mid
                else:
                    lo = mid + 1
            return lo

        low, high = least(True), least(False)
        early, late = _walk(flat, hides, low, shards, total, False), _walk(flat, hides, high, shards, total, True)
        if low == high and early == late:
            return low, early
        ranges = []
        for i, a in enumerate(early):
            b = late[i] if i < len(late) else total
            over = [x for x in blocks if x[0] <= b and x[1] >= a and x[2] > 2]
            if over:
                a, b = over[0][0], over[-1][1]
                if ranges and a <= ranges[-1][1]:
                    x = ranges.pop()
                    a, b = min(a, x[0]), max(b, x[1])
                ranges.append((a, b))


def _plan(groups: DataFrame, shards: int) -> Plan | None:
    """``groups(key, bytes, rows, end)`` with ``end`` their running size in the order of ``key``."""
    rest = groups.agg(F.sum("bytes").alias("n")).first().n
    if rest is None:
        return None
    alone, left, largest = [], shards, 0
    for g in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        largest = g.bytes
        if left == 1 or g.bytes * left < rest:
            break
        alone.append((bytes(g.key), g.bytes, g.rows))
        rest, left, largest = rest - g.bytes, left - 1, 0
    plan = Plan(alone, [], max([b for _, b, _ in alone], default=0))
    if not rest:
        return plan
    light = groups.where(~F.col("key").isin([k for k, _, _ in alone])) if alone else groups
    light = light.select("key", (F.col("end") - plan.before(F.col("key"), 1)).alias("at"))
    capacity, ends = minimax_cuts(light, rest, largest, left)
    ends = ends[:-1]
    last = light.where(F.col("at").isin(ends)).select("at", "key").collect() if ends else []
    return Plan(alone, [bytes(r.key) for r in sorted(last, key=lambda r: r.at)], max(capacity, plan.capacity))


def assign(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, size (bytes of the text and one), text_crc32, shard, slot (from 0 in each shard)."""
    plan, ranked = _ranked(docs, shards)
    if plan is None:
        return ranked.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    placed = ranked.select("doc_id", "size", "text_crc32", plan.shard(F.col("key")).alias("shard"),
                           (F.col("_rank") - plan.before(F.col("key"), 2)).alias("place"))
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # one row a shard
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).cast("bigint").alias("slot"))


def _ranked(docs: DataFrame, shards: int) -> tuple[Plan | None, DataFrame]:
    text = F.coalesce("text", F.lit(""))
    rows = cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                           F.crc32(text.cast("binary")).alias("text_crc32"), text_key(text).alias("key")))
    ranked = with_rank(rows, [], [F.col("key"), F.col("doc_id")], sums=["size"], materialize=True)
    groups = cut(ranked.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("_cum_size").alias("end")))
    return _plan(groups, shards), ranked


def write_shards(docs: DataFrame, path: str, shards: int = 16, files: int = 8) -> Plan | None:
    """Writes all columns of ``docs`` under ``path``, one folder ``shard=i`` a shard and about ``files`` files in each."""
    plan, _ = _ranked(docs, shards)
    out = docs.withColumn("shard", plan.shard(text_key(F.col("text"))) if plan else F.lit(0))
    deal = F.pmod(F.xxhash64("doc_id", "text"), F.lit(files))
    out.repartition(shards * files, "shard", deal).write.mode("overwrite").partitionBy("shard").parquet(path)
    return plan
