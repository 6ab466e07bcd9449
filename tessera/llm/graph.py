"""Narrow-table helpers for pairs of documents: connected classes and a join that
spreads a key with very many partners over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut

__all__ = ["components", "attach"]


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of long ids -> (v, comp): the smallest id that v reaches.

    Each round every vertex takes the smallest label next to it and then its
    label's label; a star is done in two rounds, a path in about the logarithm of
    its length. Everything stays in tables; each round ends its lineage with a
    checkpoint. Minima are taken before the shuffle, so a hub costs no hot task."""
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    label = cut(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("comp")))
    while True:
        heard = both.join(label, F.col("a") == F.col("v")).groupBy(F.col("b").alias("v")).agg(F.min("comp").alias("near"))
        step = label.join(heard, "v").select("v", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = label.select(F.col("v").alias("comp"), F.col("comp").alias("top"))
        new = cut(step.join(up, "comp").select("v", F.least("comp", "top").alias("comp"), "old"))
        if new.where("comp <> old").isEmpty():
            return new.select("v", "comp")
        label = new.select("v", "comp")


def attach(pairs: DataFrame, side: DataFrame, key: str, other: str, share: int = 256) -> DataFrame:
    """Joins ``side`` (one row per ``key``) to ``pairs`` on ``key``. A key with n
    pairs is dealt over n / ``share`` salts (at most the shuffle partitions), by a
    hash of ``other``, and only its own row of ``side`` is repeated that often.
    Counting is salted as well, so no step holds a hot key's pairs in one task."""
    most = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(most)).cast("int"))
    counted = pairs.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    need = counted.groupBy(key).agg(F.least(F.lit(most), F.floor(F.sum("_n") / share) + 1).cast("int").alias("_need"))
    known = counted.select(key, "_salt").join(need, key)
    dealt = pairs.join(known, [key, "_salt"]).withColumn("_part", F.pmod("_salt", F.col("_need"))).drop("_salt", "_need")
    copies = side.join(need, key).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_need") - 1))).drop("_need")
    return dealt.join(copies, [key, "_part"]).drop("_part")
