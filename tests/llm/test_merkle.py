import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import merkle
from tests.llm.helpers import docs_of


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain(text):
    leaves = [[[sha(x) for x in re.findall(r"[^.!?]{1,400}[.!?]*|[.!?]+", p)] for p in re.split(r"(?<=\n)(?=[^\n])", s)] for s in re.split(r"(?<=\n\n)(?=[^\n])", text)]
    top = sha("".join(sha("".join(sha("".join(p)) for p in s)) for s in leaves))
    return top + "|" + ";".join(",".join(".".join(x[:10] for x in p) for p in s) for s in leaves)


def near(a, b):
    if a.split("|")[0] == b.split("|")[0]:
        return 1.0
    x, y = ({z for z in re.split("[.,;]", s.split("|")[1]) if z} for s in (a, b))
    return len(x & y) / len(x | y) if x | y else 0.0


ROWS = [(9, "Title.\nOne line! Two?\n\nNext section. ümlaut 漢字.\nEnd"), (7, None), (6, ""), (6, "other text under six. And more. And yet more words here."), (5, "x" * 5000),
        (4, "Same. Words. " * 40), (4, "Same. Words. " * 40), (4, "Same. Words. " * 40), (None, "no id. at all."), (None, "no id. at all."), (1, "a\n\n\n\nb.\n"), (2, "word. " * 30000), (3, "...!!")]


def test_against_plain_version(spark):
    rows = sorted(((i, t or "") for i, t in ROWS), key=lambda x: (x[0] is None, -(x[0] or 0), hashlib.sha256(f"{'-' if x[0] is None else x[0]}\n{x[1]}".encode()).digest()))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        e = t[:len(t) - n] + nxt[:n]
        want[(i, t, e, plain(t), plain(e), plain(nxt))] += 1
    out = merkle.edited_by_next(docs_of(spark, ROWS, k=1, r=2, copies=3))
    out = out.withColumn("near", merkle.likeness(F.col("fingerprint"), F.col("edited_fingerprint"))).collect()
    assert Counter((r.doc_id, r.text, r.edited, r.fingerprint, r.edited_fingerprint, r.next_fingerprint) for r in out) == want
    assert all(abs(r.near - near(r.fingerprint, r.edited_fingerprint)) < 1e-12 for r in out)
    assert merkle.edited_by_next(docs_of(spark, [])).count() == 0
    alone = merkle.edited_by_next(docs_of(spark, [(1, "abcdef")])).first()
    assert alone.edited == "abcdab" and alone.next_fingerprint == alone.fingerprint


def test_branches_locate_edits(spark):
    a, b = "A one. B.\nC two.\n\nD three.\nE.", "A one. B.\nC 2.\n\nD three.\nE.\nF."
    r = spark.createDataFrame([(a, b)], "a string, b string").select(*[merkle.fingerprint(merkle.tree(F.col(c))).alias(c) for c in "ab"])
    x = r.select(merkle.differing(F.col("a"), F.col("b")).alias("d"), merkle.differing(F.col("a"), F.col("a")).alias("same"), merkle.likeness(F.col("a"), F.col("b")).alias("l")).first()
    assert [(d.section, d.paragraph) for d in x.d] == [(0, 1), (1, 1), (1, 2)] and x.same == []
    assert 0 < x.l < 1
