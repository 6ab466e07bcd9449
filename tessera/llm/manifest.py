"""Merkle manifest of a dataset: a tree of digests over all rows, and a proof for each.

H is the lowercase hex SHA-256 of its inputs one after the other, digests as hex
text. Leaves are ordered within their key; while a key has several nodes, every
``fan`` consecutive ones (the last run may be shorter, even one) become their H. What
remains is the key's subroot, and the subroots, in the order of the keys, give the
root by the same rule.

A leaf's rank in its key is written in digits of base ``fan``. The lowest ``DIGITS``
digits count inside a block; rows are dealt by (key, block) once, and then the
digit columns are grouped away one by one, each parent nesting the structs of its
children, until a block is one row. Blocks are leaves of the next tier, so no row
holds more than ``fan ** DIGITS`` nodes whatever the size of the table. On the way back a
block and the path above it are brought together by grouping, and a transform for each digit
followed by one explode emits the proofs: no table of nodes is joined.

A proof has one entry for each level, from the leaf up: the digests of the run left
of one's own and right of it, one behind the other. A level at which a key has a single node is no level and
has no entry; a run of one has an entry of two empty strings.

Defined cases: in a leaf a null is ``-``, any other value the number of its UTF-8 bytes,
``:`` and the value; a null key comes first; within a key a null doc_id comes first and
rows with one doc_id are ordered by leaf, equal rows being separate leaves; a
lone leaf is its subroot, a lone subroot the root; an empty table gives no rows.
Whole texts are read once and hashed where they lie; only digests are shuffled.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut
from tessera.operators.ordered import with_rank

__all__ = ["leaf_digest", "manifest", "fold", "proof_digest"]

#: digits of a rank that a block holds
DIGITS = 3


def leaf_digest(*columns: Column) -> Column:
    """H of the columns, each ``-`` if null, else byte count, ``:``, value."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(c.cast("string")) for c in columns]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda h, e: F.sha2(F.concat(e["left"], h, e["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda e: F.concat(e["left"], e["right"])), ""), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda k: k["h"]), "")


def _siblings(kids: Column, i: Column) -> Column:
    return F.struct(_joined(F.slice(kids, 1, i)).alias("left"), _joined(F.slice(kids, i + 2, F.size(kids))).alias("right"))


def _steps(kids: Column, path: Column, applied: Column, rest) -> Column:
    """For each child of a node with this path, ``rest(child, its path)``."""
    return F.transform(kids, lambda k, i: rest(k, F.when(applied, F.concat(F.array(_siblings(kids, i)), path)).otherwise(path)))


def _rolled(nodes: DataFrame, fan: int, tier: int) -> DataFrame:
    """``nodes(key, n, rank, h, leaf)`` -> one row (key, n, rank, h, kids) a block. ``n``
    counts the key's leaves in the lowest tier: a level is applied while it has several nodes."""
    size = fan ** DIGITS
    node = nodes.select("key", "n", F.floor(F.col("rank") / size).alias("block"), F.pmod("rank", F.lit(size)).alias("in_block"), F.struct("h", "leaf").alias("node"))
    node = node.select("key", "n", "block", *[F.pmod(F.floor(F.col("in_block") / fan ** d), F.lit(fan)).alias(f"d{d}") for d in range(DIGITS)], "node")
    node = node.repartition("key", "block")  # all that follows is grouped where it lies
    for d in range(DIGITS):
        upper = [f"d{x}" for x in range(d + 1, DIGITS)]
        g = node.groupBy("key", "block", *upper).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct(F.col(f"d{d}").alias("d"), "node"))).alias("kids"))
        kids = F.transform("kids", lambda k: k["node"])
        g = g.withColumn("kids", kids)
        h = F.when(_applied(F.col("n"), fan, tier, d), F.sha2(_joined(F.col("kids")), 256)).otherwise(F.col("kids")[0]["h"])
        node = g.select("key", "n", "block", *upper, F.struct(h.alias("h"), F.col("kids")).alias("node"))
    return node.select("key", "n", F.col("block").alias("rank"), F.col("node.h").alias("h"), F.col("node.kids").alias("kids"))


def _applied(n: Column, fan: int, tier: int, digit: int) -> Column:
    below = fan ** (tier * DIGITS + digit)
    return n > F.lit(below)


def _tree(nodes: DataFrame, fan: int) -> list[DataFrame]:
    """The tiers of blocks over ``nodes(key, n, rank, h, leaf)``, until each key is one block."""
    largest = nodes.agg(F.max("n").alias("n")).first().n or 0
    tiers, size = [], fan ** DIGITS
    while True:
        tiers.append(cut(_rolled(nodes, fan, len(tiers))))
        if largest <= size ** len(tiers):
            return tiers
        nodes = tiers[-1].select("key", "n", "rank", "h", F.col("rank").alias("leaf"))


def _emitted(blocks: DataFrame, above: DataFrame, fan: int, tier: int, carried: Sequence[str]) -> DataFrame:
    """Blocks and ``above(key, rank, path, *carried)``, the path from each of them up, -> (key, h, leaf, path, *carried) of the nodes in them."""
    both = blocks.select("key", "rank", "n", "kids").unionByName(above, allowMissingColumns=True)
    both = both.groupBy("key", "rank").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", *carried)])
    n = F.col("n")

    def inner(d: int):
        if d < 0:
            return lambda k, path: F.array(F.struct(k["h"].alias("h"), k["leaf"].alias("leaf"), path.alias("path")))
        return lambda k, path: F.flatten(_steps(k["kids"], path, _applied(n, fan, tier, d), inner(d - 1)))

    top = DIGITS - 1
    out = F.flatten(_steps(F.col("kids"), F.col("path"), _applied(n, fan, tier, top), inner(top - 1)))
    both = both.select("key", *carried, F.explode(out).alias("x"))
    return both.select("key", *carried, F.col("x.h").alias("h"), F.col("x.leaf").alias("leaf"), F.col("x.path").alias("path"))


def _proofs(tiers: list[DataFrame], above: DataFrame, fan: int, carried: Sequence[str]) -> DataFrame:
    for t in range(len(tiers) - 1, -1, -1):
        out = _emitted(tiers[t], above, fan, t, carried)
        if t:
            above = out.select("key", F.col("leaf").alias("rank"), "path", *carried)
    return out


def manifest(leaves: DataFrame, key: str = "lang", order: str = "doc_id", fan: int = 8) -> DataFrame:
    """``leaves(key, order, leaf, ...)`` -> these columns, subroot, root and ``proof``
    (array of (left, right) from the leaf to the root), one row for each row."""
    own = cut(leaves.select(F.col(key).alias("key"), F.col(order).alias("at"), F.col("leaf").alias("h"), F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("leaf")))
    ranked = with_rank(own, ["key"], ["at", "h"]).select("key", F.col("_n").alias("n"), F.col("_rank").alias("rank"), "h", "leaf")
    tiers = _tree(ranked, fan)
    subroots = tiers[-1].select("key", "h")
    names = with_rank(subroots, [], ["key"]).select(F.lit(0).alias("key"), F.col("_n").alias("n"), F.col("_rank").alias("rank"), "h", F.col("key").alias("leaf"))
    names = cut(names)
    top = _tree(names, fan)
    start = top[-1].select("key", F.lit(0).cast("bigint").alias("rank"), F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("h").alias("root"))
    down = _proofs(top, start, fan, ["root"])
    down = down.select(F.col("leaf").alias("key"), F.lit(0).cast("bigint").alias("rank"), "path", "root", F.col("h").alias("subroot"))
    out = _proofs(tiers, down, fan, ["root", "subroot"])
    return out.select("leaf.*", "subroot", "root", F.col("path").alias("proof"))
