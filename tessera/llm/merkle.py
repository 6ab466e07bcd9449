"""Document fingerprints: Merkle trees in DataFrame expressions only.

A text is cut into sections (closed by blank lines), these into paragraphs
(lines), these into leaves (sentences, at most 400 characters). Every character
is in exactly one leaf. A leaf is named by its SHA-256, a paragraph by that of its
leaves' names, and so on up to the root, so equal roots mean equal texts and
unequal branches lead to the edits.

A fingerprint is a string: the root, ``|``, then the shortened names of all
leaves, ``.`` between leaves, ``,`` between paragraphs, ``;`` between sections. Two
fingerprints are compared without their texts: ``likeness`` is the share of leaf
names they have in common, ``differing`` the places of unequal paragraphs.

Defined cases: null is empty, an empty text has a root and no leaf; two empty
texts have likeness 1; other columns are ignored; no rows give no rows.
``next_documents``: a null doc_id comes last, rows with one doc_id are ordered by
hash, and equal rows follow each other, each the next of the one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut
from tessera.operators.ordered import with_rank

__all__ = ["tree", "root", "fingerprint", "likeness", "differing", "edited_by_next"]

_SECTION, _PARAGRAPH, _LEAF = r"(?<=\n\n)(?=[^\n])", r"(?<=\n)(?=[^\n])", r"[^.!?]{1,400}[.!?]*|[.!?]+"
_SHORT = 10


def tree(text: Column) -> Column:
    """Names of the leaves: array (sections) of arrays (paragraphs) of arrays."""
    leaves = lambda p: F.transform(F.regexp_extract_all(p, F.lit(_LEAF), F.lit(0)), lambda x: F.sha2(x, 256))
    return F.transform(F.split(text, _SECTION), lambda s: F.transform(F.split(s, _PARAGRAPH), leaves))


def root(names: Column) -> Column:
    """Name of the root of a ``tree``."""
    up = lambda parts: F.sha2(F.array_join(parts, ""), 256)
    return up(F.transform(names, lambda s: up(F.transform(s, lambda p: up(p)))))


def fingerprint(names: Column) -> Column:
    short = lambda p: F.array_join(F.transform(p, lambda x: F.substring(x, 1, _SHORT)), ".")
    return F.concat(root(names), F.lit("|"), F.array_join(F.transform(names, lambda s: F.array_join(F.transform(s, short), ",")), ";"))


def _leaves(fp: Column) -> Column:
    return F.filter(F.split(F.substring_index(fp, "|", -1), "[.,;]"), lambda x: x != "")


def likeness(a: Column, b: Column) -> Column:
    """Leaf names in both fingerprints over those in either; 1 for equal roots."""
    x, y = _leaves(a), _leaves(b)
    either = F.size(F.array_union(x, y))
    return F.when(F.substring_index(a, "|", 1) == F.substring_index(b, "|", 1), F.lit(1.0)) \
        .when(either == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / either)


def differing(a: Column, b: Column) -> Column:
    """(section, paragraph) of the paragraphs of ``b`` that are not the same in ``a`` at their place; only unequal branches are opened."""
    x, y = (F.split(F.substring_index(c, "|", -1), ";") for c in (a, b))
    opened = F.transform(y, lambda s, i: F.when(F.get(x, i).eqNullSafe(s), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(
        F.filter(F.transform(F.split(s, ","), lambda p, j: F.when(~F.get(F.split(F.get(x, i), ","), j).eqNullSafe(p),
                                                                  F.struct(i.cast("int").alias("section"), j.cast("int").alias("paragraph")))), lambda z: z.isNotNull())))
    return F.flatten(opened)


def edited_by_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, text, edited (its last third replaced by the
    beginning of the next document, descending doc_id, the first after the last),
    fingerprint, edited_fingerprint, next_fingerprint.

    Order is found on narrow rows (key, id, length). Whole texts are shuffled
    once, by key; what goes to the neighbour is a third of it and a fingerprint."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("\n"), F.col("text")), 256))
    docs = docs.withColumn("k", key)
    narrow = docs.groupBy("k").agg(F.min("doc_id").alias("doc_id"), F.min(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    ranked = cut(with_rank(narrow, [], [F.desc_nulls_last("doc_id"), F.col("k")]).select("k", "n", "copies", F.col("_rank").alias("r"), F.col("_n").alias("of")))
    before = ranked.select(F.pmod(F.col("r") + 1, F.col("of")).alias("r"), F.col("k").alias("to"), F.floor(F.col("n") / 3).cast("int").alias("need"))
    links = cut(ranked.join(before, "r").select("k", "copies", "to", "need"))
    whole = docs.groupBy("k").agg(F.max(F.struct("doc_id", "text")).alias("d"))
    own = whole.join(links, "k").select("k", "copies", "to", "need", F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text"))
    own = own.withColumn("fingerprint", fingerprint(tree(F.col("text"))))
    sent = own.select(F.col("to").alias("k"), F.expr("substring(text, 1, need)").alias("tail"), F.col("fingerprint").alias("next_fingerprint"))
    head = F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) AS int))")
    last = own.join(sent, "k").select("doc_id", "text", F.concat(head, "tail").alias("edited"), "fingerprint", "next_fingerprint")
    # Of equal rows all but the last are followed by themselves.
    again = own.where("copies > 1").withColumn("copy", F.explode(F.sequence(F.lit(2), F.col("copies"))))
    again = again.select("doc_id", "text", F.concat(head, F.expr("substring(text, 1, cast(floor(length(text) / 3) AS int))")).alias("edited"), "fingerprint", F.col("fingerprint").alias("next_fingerprint"))
    return last.unionByName(again).withColumn("edited_fingerprint", fingerprint(tree(F.col("edited"))))
