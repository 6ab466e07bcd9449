import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import manifest, queries, ranked, sharding
from tests.llm.helpers import docs_of


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def plain_tree(leaves, fan):
    """(root, path of each leaf: (left, right) by level)."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i:i + fan] for i in range(0, len(level), fan)]
        for k, i in enumerate(at):
            paths[k].append(("".join(runs[i // fan][:i % fan]), "".join(runs[i // fan][i % fan + 1:])))
        level, at = [sha(*r) for r in runs], [i // fan for i in at]
    return level[0], paths


def plain_manifest(rows, fan):
    """rows (doc_id, lang, leaf) -> the same with subroot, root, path."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    sub = {k: plain_tree([r[2] for r in groups[k]], fan) for k in keys}
    root, up = plain_tree([sub[k][0] for k in keys], fan) if keys else (None, [])
    return [(*r, sub[k][0], root, sub[k][1][i] + up[n]) for n, k in enumerate(keys) for i, r in enumerate(groups[k])]


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_manifest_against_plain_tree(spark, fan):
    r = random.Random(fan)
    rows = [(r.choice([None, *range(200)]), lang, sha(str(r.randrange(300)))) for lang, n in
            ((None, 3), ("", 1), ("de", 130), ("fr", 9), ("é", 8), ("z", 2), ("aa", 64), ("ab", 65)) for _ in range(n)]
    rows += [rows[5]] * 3 + [(1, f"l{k}", sha(str(k))) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, leaf string").withColumn("key", F.lit(1)).withColumn("n", F.lit("x")).withColumn("root_", F.lit(None).cast("int"))
    out = manifest.manifest(df, fan=fan)
    assert out.columns == [*df.columns, "subroot", "root", "proof"]
    got = out.withColumn("folded", manifest.fold(F.col("leaf"), F.col("proof"))).withColumn("digest", manifest.proof_digest(F.col("proof"))).collect()
    want = plain_manifest(rows, fan)
    assert sorted(((x.doc_id, x.lang, x.leaf, x.subroot, x.root, [tuple(e) for e in x.proof]) for x in got), key=str) == sorted(want, key=str)
    assert all(x.folded == x.root and x.digest == sha(*(a + b for a, b in x.proof)) for x in got)
    # A changed leaf does not fold to the root.
    bad = out.select((manifest.fold(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).alias("same")).distinct().collect()
    assert [x.same for x in bad] == [False]


def test_manifest_small_tables_and_leaf(spark):
    df = spark.createDataFrame([(7, None, None, 3, "é")], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    leaf = df.select(manifest.leaf_digest(*df.columns and [F.col(c) for c in df.columns]).alias("h")).first().h
    assert leaf == sha(part(7), "-", "-", part(3), part("é"))
    one = manifest.manifest(df.select("doc_id", "lang", F.lit(leaf).alias("leaf"))).first()
    assert one.subroot == one.root == leaf and one.proof == []
    assert manifest.manifest(df.limit(0).select("doc_id", "lang", F.lit(leaf).alias("leaf"))).count() == 0


def test_manifest_query(spark):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet").collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    head = lambda d: part(d.doc_id) + part(d.source) + part(d.lang) + part(d.n_chars)
    want = {}
    for (i, _, leaf, sub, root, path), in zip(plain_manifest([(d.doc_id, d.lang, sha(head(d), part(d.text))) for d in docs], 8)):
        want[i] = leaf, sub, root, path
    for d in docs:
        leaf, sub, root, path = want[d.doc_id]
        t = d.text.translate(lower) if d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 3 == 0 else d.text
        h = sha(head(d), part(t))
        for a, b in path:
            h = sha(a, h, b)
        want[d.doc_id] = leaf, sub, root, sha(*(a + b for a, b in path)), h, h == root
    got = {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in queries.QUERIES["op11_manifest"](spark, base).collect()}
    assert got == want
    assert {v[5] for v in got.values()} == {True, False}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain_search(docs, items, k=10):
    tfs = [(i, Counter(terms_of(t))) for i, t in docs]
    tfs = [(i, c, sum(c.values())) for i, c in tfs if c]
    n_docs, length = len(tfs), sum(n for *_, n in tfs)
    df = Counter(t for _, c, _ in tfs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in tfs:
            m = 10 + (90 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def test_search_against_plain_ranking(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 5))) for _ in range(150)]
    pick = lambda n: r.choice([" ", "-", "\n", " .", "\x7f"]).join(r.choice(words[:r.choice([10, 150])]) for _ in range(n))
    docs = [(k, pick(r.randint(1, 60))) for k in range(400)] + [(900, None), (901, ""), (902, "!? ."), (None, pick(9)), (None, "Zebra zebra"), (903, "ZEBRA"), (904, "zebra"), (905, pick(30000))]
    docs += [docs[3]] * 25 + [(k, docs[7][1]) for k in range(500, 530)]
    items = [(k, pick(r.randint(1, 25))) for k in range(25)] + [(50, None), (51, ""), (52, "never-seen"), (53, "zebra"), (54, docs[7][1]), (54, "zebra"), (None, docs[3][1])]
    df = docs_of(spark, docs, item=1, rank="x", score=2, term="y", n=3, tf=4)
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    rows = lambda out: sorted(map(tuple, out.collect()), key=str)
    want = plain_search(docs, items)
    assert rows(ranked.search(df, bench)) == want
    assert rows(ranked.search(df, bench, block_bytes=300)) == want
    assert rows(ranked.search(df, bench, k=3)) == plain_search(docs, items, 3)
    assert ranked.search(df.limit(0), bench).count() == 0 and ranked.search(df, bench.limit(0)).count() == 0


def test_balls_prune_and_stay_exact():
    r = np.random.default_rng(2)
    width, rows = 60, []
    for topic in range(30):
        own = r.choice(width, 5, replace=False)
        for _ in range(60):
            rows.append({int(t): int(r.integers(900_000_000, 1_000_000_000)) for t in own if r.random() < 0.97})
    starts = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
    terms, values = (np.array([f(x, t) for x in rows for t in sorted(x)], np.int64) for f in (lambda x, t: t, lambda x, t: x[t]))
    tree, order, opened, leaves = ranked.BallTree(starts, terms, values, width, leaf=16), np.arange(len(rows)), 0, 0
    leaves = sum(x is not None for x in tree.rows)
    for _ in range(50):
        q = np.sort(r.choice(width, r.integers(1, 6), replace=False))
        held = []
        opened += tree.best(q, order, held, 10, 1)
        scores = sorted(((sum(x.get(int(t), 0) for t in q), -i) for i, x in enumerate(rows)), reverse=True)[:10]
        assert sorted(held, reverse=True) == [s for s in scores if s[0] > 0]
        bound = tree.bounds(q)
        for n, of in enumerate(tree.rows):
            if of is not None:
                assert max(sum(rows[i].get(int(t), 0) for t in q) for i in of) <= bound[n]
    assert opened < 50 * leaves / 2


def plain_shards(rows, shards):
    """(doc_id, size, crc, shard, slot) by trying every capacity in turn from the sums of runs."""
    size = lambda t: len((t or "").encode()) + 1
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").encode()).digest()].append((i, t or ""))
    weight = {k: sum(size(t) for _, t in g) for k, g in groups.items()}
    rest, left, alone = sum(weight.values()), shards, []
    for k in sorted(groups, key=lambda k: (-weight[k], k)):
        if left == 1 or weight[k] * left < rest:
            break
        alone.append(k)
        rest, left = rest - weight[k], left - 1
    order = [k for k in sorted(groups) if k not in alone]

    def walk(capacity):
        runs = [[]]
        for k in order:
            if sum(weight[x] for x in runs[-1]) + weight[k] > capacity:
                runs.append([])
            runs[-1].append(k)
        return runs

    runs = []
    if order:
        ends = np.concatenate(([0], np.cumsum([weight[k] for k in order])))
        least = min(c for c in {int(b - a) for a in ends for b in ends if b > a} if c >= max(weight[k] for k in order) and len(walk(c)) <= left)
        runs = walk(least)
    out = []
    for s, run in enumerate([[k] for k in alone] + runs):
        placed = [x for k in run for x in sorted(groups[k], key=lambda x: (x[0] is not None, x[0] or 0))]
        out += [(i, size(t), zlib.crc32(t.encode()), s, n) for n, (i, t) in enumerate(placed)]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [1 << 14, 40])
def test_shards_against_plain_version(spark, monkeypatch, blocks):
    monkeypatch.setattr(sharding, "BLOCKS", blocks)  # few blocks: many rounds
    r = random.Random(blocks)
    for shape in ("even", "copies", "few", "one"):
        rows = [(k, "x" * r.randint(0, 30) + str(k)) for k in range({"even": 160, "copies": 90, "few": 5, "one": 0}[shape])]
        rows += [(None, None), (3, ""), (3, ""), (None, "é")]
        if shape == "copies":
            rows += [(1000 + k, "a long copied text " * 3) for k in range(60)] + [(7, "y" * 900)]
        df = docs_of(spark, rows, size=1, shard="x", slot=2, key="k")
        got = sorted((tuple(x) for x in sharding.assign(df, 7).collect()), key=str)
        assert got == plain_shards(rows, 7), shape
    assert sharding.assign(docs_of(spark, [])).count() == 0


def test_written_shards_match_their_assignment(spark, tmp_path):
    rows = [(k, f"text {k % 40} " * (k % 7)) for k in range(200)] + [(None, None)]
    df = docs_of(spark, rows)
    sharding.write_shards(df, str(tmp_path / "s"), 5, files=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(df.columns + ["shard"]) == sorted(back.columns) and back.count() == len(rows)
    want = Counter((x.doc_id, x.shard) for x in sharding.assign(df, 5).collect())
    assert Counter((x.doc_id, x.shard) for x in back.select("doc_id", "shard").collect()) == want
