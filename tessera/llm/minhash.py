"""Near-duplicate classes by fast similarity sketching, banding and exact verification.

A document is the set of its distinct shingles of ``k`` words (A-Z lowered, words
``[^\\x20\\x09-\\x0D]+``; with fewer words the whole sequence is the one shingle).
The sketch throws every shingle into a hashed bin, round after round until no bin
is empty; in the rounds after the ``T``-th bin number i is hit for certain, so at
most 2T rounds fill all of them, with Chernoff-type concentration. Bands of four
bins are bucket keys: with 32 bands a pair at similarity 0.8 shares none with
probability 5e-8.

Documents with equal sets are one vertex. In every bucket the vertex that
shares most buckets is paired with the others; these pairs are verified on whole sets and connected.
Where a bucket still holds several classes, members outside its largest class
become centres in turn, until each of them has met the whole bucket: no bucket is
capped, none emits all its pairs, and no pair that shares a bucket but could
still join two classes goes untested. Pairs are left out only where an exact
upper bound, from what both have in common with the bucket's centre, rules a
link out.

Defined cases: null and empty texts have no shingles and are linked with
nothing; a null doc_id is linked with nothing either (component null, kept);
repeated rows are copies; rows that share a doc_id keep classes of their own;
other columns are ignored; no rows give no rows. Sets are compared by 64-bit
hashes of the shingles, vertices named by 64-bit hashes of the sets.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, byte_chunks, cut, doc_bytes, free_name, mix64, release, span_hash, word_spans
from tessera.llm.graph import attach, components

__all__ = ["shingle_sets", "sketches", "features", "members", "classes", "first_of_each"]

T, ROWS, CHUNK = 128, 4, 1 << 20
#: Members of a bucket outside its largest class that meet the whole bucket in one turn, at most; the others follow in the next.
CENTRES = 4096
#: Members of a bucket that meet its centres in one task, about.
DEALT = 512
#: Longs of each of a pair's two bitmaps.
WORDS = 4
_SEEDS = mix64(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and the document of each."""
    text = LOWER[flat]
    start, end, doc = word_spans(text, offsets)
    word = span_hash(text, start, end)
    n = len(word)
    h, at = [], []
    count = np.bincount(doc, minlength=len(offsets) - 1)
    for size in range(1, k + 1):
        # Whole shingles, or all words of a document that has fewer.
        ok = np.ones(max(n - size + 1, 0), bool)
        if n >= size:
            ok &= doc[:n - size + 1] == doc[size - 1:]
        ok &= True if size == k else count[doc[:len(ok)]] == size
        i = np.flatnonzero(ok)
        x = np.full(len(i), size, np.uint64)
        for j in range(size):
            x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + word[i + j])
        h.append(x)
        at.append(doc[i])
    h, at = np.concatenate(h), np.concatenate(at)
    order = np.lexsort((h, at))
    h, at = h[order], at[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
    return h[new], at[new]


def sketches(h: np.ndarray, at: np.ndarray, docs: int) -> np.ndarray:
    """Sketch of each document, one row of T values; documents without shingles keep the largest value."""
    empty = np.uint64(2**64 - 1)
    out = np.full((docs, T), empty, np.uint64)
    flat = out.reshape(-1)
    for i in range(2 * T):
        if not len(h):
            break
        x = mix64(h ^ _SEEDS[i])
        bins = (x >> np.uint64(57)).astype(np.int64) if i < T else i - T
        np.minimum.at(flat, at * T + bins, (np.uint64(i) << np.uint64(55)) | (x & np.uint64((1 << 55) - 1)))
        open_ = (out == empty).any(1)[at]
        h, at = h[open_], at[open_]
    return out


def features(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, v (hash of the set), bands (bucket keys); null ids are left out."""
    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, v bigint, bands array<bigint>"
    bands = T // ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offsets = doc_bytes(b.column(1))
            for i, j in byte_chunks(offsets, CHUNK):
                h, at = shingle_sets(flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                n = np.bincount(at, minlength=j - i)
                v = mix64(_sums(mix64(h), at, j - i) ^ n.astype(np.uint64))
                s = sketches(h, at, j - i).reshape(j - i, bands, ROWS)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (j - i, bands))
                for r in range(ROWS):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(n, pa.int64()), pa.array(v.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i) * bands + 1, bands, dtype=np.int32)), pa.array(key.reshape(-1).view(np.int64)))],
                    names=["doc_id", "text_hash", "n_shingles", "v", "bands"])
        release()

    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    return docs.select(ids, "text", F.xxhash64("text").alias("text_hash")).where("doc_id IS NOT NULL").mapInArrow(run, schema)


def _sums(x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sum of x (mod 2^64) by place; ``at`` is sorted."""
    total = np.concatenate(([np.uint64(0)], np.cumsum(x, dtype=np.uint64)))
    edge = np.searchsorted(at, np.arange(n + 1))
    return total[edge[1:]] - total[edge[:-1]]


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(v, shingles as sorted uint64) of the wanted (v, doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offsets = doc_bytes(b.column(1))
            v = b.column(0).to_numpy()
            for i, j in byte_chunks(offsets, CHUNK):
                h, at = shingle_sets(flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                edge = np.searchsorted(at, np.arange(j - i + 1))
                own = mix64(_sums(mix64(h), at, j - i) ^ np.diff(edge).astype(np.uint64)).view(np.int64)
                keep = np.flatnonzero(own == v[i:j])  # rows that share a doc_id may have other texts
                yield pa.RecordBatch.from_arrays([pa.array(own[keep]), pa.array([h[edge[x]:edge[x + 1]].tobytes() for x in keep], pa.binary())], names=["v", "shingles"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(wanted, "doc_id").select("v", "text")
    return rows.mapInArrow(run, "v bigint, shingles binary").dropDuplicates(["v"])


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, same, linked, bits) of the pairs: size of the intersection of whole sets, whether they are
    alike enough, and two bitmaps: of the shingles that b has and a has not, and of those that only a has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                own, lost = (p[np.isin(p, q, assume_unique=True, invert=True)] for p, q in ((y, x), (x, y)))
                same = len(y) - len(own)
                bits = np.zeros(2 * WORDS, np.uint64)
                for at, only in ((0, own), (WORDS, lost)):
                    np.bitwise_or.at(bits, ((only >> np.uint64(6)) % np.uint64(WORDS)).astype(np.int64) + at, np.uint64(1) << (only & np.uint64(63)))
                rows.append((same, 100 * same >= percent * (len(x) + len(y) - same), bits.view(np.int64).tolist()))
            same, linked, bits = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.int64()), pa.array(linked, pa.bool_()), pa.array(bits, pa.list_(pa.int64()))],
                                             names=["a", "b", "same", "linked", "bits"])

    wanted = cut(pairs.select(F.col("a").alias("v")).distinct().union(pairs.select(F.col("b").alias("v")).distinct()).distinct())
    if wanted.count() <= 200_000:  # numbers of 8 bytes: then only these sets are shuffled
        wanted = F.broadcast(wanted)
    sets = sets.join(wanted, "v", "left_semi")
    rows = pairs.join(sets.select(F.col("v").alias("b"), F.col("shingles").alias("y")), "b")
    rows = attach(rows, sets.select(F.col("v").alias("a"), F.col("shingles").alias("x")), "a", "b")
    return rows.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, same bigint, linked boolean, bits array<bigint>")


def _may_link(percent: int):
    """Condition on two members of a bucket (v, n, same, bits and a, m, its_same, its_bits), compared with its
    centre before: an upper bound of their intersection. A shingle of the centre that one of them lacks is in no
    intersection, nor is one outside the centre's set that the other lacks; a bit that only one bitmap has
    stands for at least one such shingle."""
    alone = lambda p, q, at: sum((F.bit_count(F.get(p, F.lit(at + k)).bitwiseAND(F.bitwise_not(F.get(q, F.lit(at + k))))) for k in range(WORDS)), F.lit(0))
    mine, its = F.col("bits"), F.col("its_bits")
    inside = F.least(F.col("same") - alone(its, mine, WORDS), F.col("its_same") - alone(mine, its, WORDS))
    most = inside + F.least(F.col("n") - F.col("same") - alone(mine, its, 0), F.col("m") - F.col("its_same") - alone(its, mine, 0))
    return F.coalesce(100 * most >= percent * (F.col("n") + F.col("m") - most), F.lit(True))


def members(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, text_hash, n_shingles, comp (names the class; null
    without shingles), component_id, one row for each row with a doc_id."""
    f = cut(features(docs, k))
    vertices = cut(f.where("n_shingles > 0").groupBy("v").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.min("bands").alias("bands")))
    rows = vertices.select("v", "n", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut(rows.join(shared, "bucket"))
    # The text that others were copied from shares most buckets: as centre it reaches most of them.
    weight = members.groupBy("v").agg(F.sum("size").alias("weight"))
    members = members.join(weight, "v")
    centre = members.groupBy("bucket").agg(F.max(F.struct("weight", "v"))["v"].alias("centre"))
    members = cut(members.join(centre, "bucket").select("bucket", "v", "n", "centre"))
    near = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")  # sizes alone rule the others out
    # All members meet the centre, also those of other sizes: what they have in common with it bounds the rest.
    pairs = cut(members.where("v <> centre").select(F.col("centre").alias("a"), F.col("v").alias("b")).distinct())
    wanted = members.select("v").distinct().join(vertices.select("v", "doc_id"), "v")
    sets = cut(_sets(docs, wanted, k))  # whole texts are shuffled this once
    first = cut(_compared(pairs, sets, percent))
    edges = first.where("linked").select("a", "b")
    used = members.select("bucket", F.col("centre").alias("v")).distinct()
    members = cut(members.join(first.select(F.col("a").alias("centre"), F.col("b").alias("v"), "same", "bits"), ["centre", "v"], "left").select("bucket", "v", "n", "same", "bits"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    label, tested, turn = components(edges), pairs, 0
    while True:
        named = members.join(label, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
        by = named.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
        largest = by.groupBy("bucket").agg(F.max(F.struct("c", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("c").alias("size")).where("comps > 1")
        # A large bucket's members are dealt over salts, with its centres repeated for each.
        salts = F.least(F.lit(parts), F.floor(F.col("size") / DEALT) + 1).cast("int")
        strays = named.select("bucket", "v", "comp").join(largest.select("bucket", "main"), "bucket").where("comp <> main").join(used, ["bucket", "v"], "left_anti")
        picked = strays.groupBy("bucket", F.pmod(F.xxhash64("v", F.lit(turn)), F.lit(CENTRES)).alias("s")).agg(F.min("v").alias("v")).select("bucket", "v")
        centres = cut(named.join(picked, ["bucket", "v"]).join(largest.select("bucket", salts.alias("salts")), "bucket").select("bucket", "salts", F.col("v").alias("a"), F.col("n").alias("m"), F.col("comp").alias("own"),
                                                                F.col("same").alias("its_same"), F.col("bits").alias("its_bits")))
        if centres.isEmpty():
            break
        # Comparing is work, not bytes: a stated count of partitions keeps it from being drawn together.
        dealt = named.join(largest.select("bucket", salts.alias("salts")), "bucket").select(F.col("bucket").alias("at"), F.pmod(F.xxhash64("v"), F.col("salts")).cast("int").alias("part"), *named.drop("bucket").columns)
        spread = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        met = (dealt.repartition(parts, "at", "part").join(spread.repartition(parts, "bucket", "salt"), (F.col("at") == F.col("bucket")) & (F.col("part") == F.col("salt")) & (F.col("comp") != F.col("own")) & near & _may_link(percent))
               .select(F.least("a", "v").alias("a"), F.greatest("a", "v").alias("b")).distinct())
        pairs = cut(met.join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
        used, tested, turn = used.union(centres.select("bucket", F.col("a").alias("v"))), tested.union(pairs), turn + 1
        more = cut(_compared(pairs, sets, percent).where("linked").select("a", "b"))
        if not more.isEmpty():
            edges = edges.union(more)
            label = components(edges)
    comp = vertices.select("v", "doc_id").join(label, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
    # Written, so that the join has shuffles of its own, which are split where one class has very many members.
    comp = cut(comp)
    least = cut(comp.groupBy("comp").agg(F.min("doc_id").alias("component_id")))
    comp = comp.join(least, "comp").select("v", "comp", "component_id")
    return f.select("doc_id", "text_hash", "n_shingles", "v").join(comp, "v", "left").select("doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("comp")).alias("comp"), "component_id")


def classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_shingles, component_id (smallest doc_id
    reachable over links of at least ``percent`` % Jaccard similarity), kept."""
    out = members(docs, k, percent)
    out = out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    lost = _without_id(docs, k)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(lost)


def first_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all their columns, without near duplicates: of each class
    the one with the smallest doc_id stays (null last), of that id the smallest hash of
    the text, of equal rows one. Texts without words are in no class and stay."""
    ident, hashed = (free_name(docs, x) for x in ("ident", "hashed"))
    last = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)  # behind all ids, and apart by text
    rows = docs.withColumn(ident, F.coalesce(F.col("doc_id").cast("bigint"), last)).withColumn(hashed, F.xxhash64("text"))
    found = members(rows.select(F.col(ident).alias("doc_id"), "text"), k, percent).where("comp IS NOT NULL")
    first = found.groupBy("comp").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
    first = cut(first.select(F.col("f.doc_id").alias(ident), F.col("f.text_hash").alias(hashed)))
    again = found.groupBy(F.col("doc_id").alias(ident), F.col("text_hash").alias(hashed)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = cut(again.join(first, [ident, hashed], "left_semi"))
    stay = rows.join(first.join(again, [ident, hashed], "left_anti"), [ident, hashed], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    copies = rows.join(again, [ident, hashed], "left_semi")
    key = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    copies = copies.groupBy(ident, hashed).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), key).alias("row")).select("row.*")
    wordless = docs.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return stay.unionByName(copies).unionByName(wordless)


def _without_id(docs: DataFrame, k: int) -> DataFrame:
    """Rows whose doc_id is null, each alone."""
    rows = docs.where("doc_id IS NULL").select(F.lit(0).alias("doc_id"), "text")
    return features(rows, k).select(F.lit(None).cast("bigint").alias("doc_id"), "n_shingles", F.lit(None).cast("bigint").alias("component_id"), F.lit(True).alias("kept"))
