import difflib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import graph, lines, minhash
from tests.llm.helpers import docs_of


def sets_of(rows, k):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((i, {tuple(w[x:x + k]) for x in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())))
    return out


def brute_classes(rows, k, percent=80):
    s = sets_of(rows, k)
    root = list(range(len(s)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in range(len(s)):
        for q in range(p):
            a, b = s[p][1], s[q][1]
            if a and b and s[p][0] is not None and s[q][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                root[find(p)] = find(q)
    groups = defaultdict(list)
    for p, (i, _) in enumerate(s):
        groups[find(p)].append(i)
    return sorted([(str(i), len(x), str(None if i is None else min(groups[find(p)]))) for p, (i, x) in enumerate(s)])


def near_rows():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijk") for _ in range(r.randint(2, 7)))
    rows = [(900, None), (901, ""), (902, "one"), (903, "ONE"), (904, "\x0b two\twords "), (905, "two words"), (906, "é É"), (None, "two words"), (None, None), (907, "w " * 9000)]
    for g in range(12):
        base = [word() for _ in range(r.randint(6, 90))]
        for c in range(r.randint(1, 14)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 8))):
                w[r.randrange(len(w))] = word()
            rows.append((g * 100 + c * 7, " ".join(w)))
            if c % 5 == 0:
                rows.append((g * 100 + c * 7 + 1, "  ".join(w).upper()))
    rows += [rows[20], (rows[21][0], "another text under the id of another one")]
    return rows


def test_classes_match_brute_force(spark):
    rows = near_rows()
    for k in (2, 5):
        got = minhash.classes(docs_of(spark, rows, v=1, bands=2, comp=3), k=k).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_classes(rows, k)
        assert all(r.kept == (r.doc_id == r.component_id if r.doc_id is not None else True) for r in got)
    assert minhash.classes(docs_of(spark, [])).count() == 0


def test_sketch_fills_and_estimates():
    r = np.random.default_rng(0)
    sets = [r.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 5, 40, 2000)]
    sets.append(np.concatenate((sets[4][:1800], r.integers(0, 2**63, 200).astype(np.uint64))))
    at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    s = minhash.sketches(np.concatenate(sets), at, len(sets) + 1)
    assert (s[:-1] < 2**64 - 1).all() and (s[-1] == 2**64 - 1).all()
    assert abs((s[4] == s[5]).mean() - 1800 / 2200) < 0.15


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (7, 7)]
    got = dict(graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).select("v", "comp").collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def brute_lines(rows, min_words=6):
    """Every document against all earlier ones: the lines in runs of ``min_words`` words that one of them has."""
    docs = sorted({(i, t) for i, t in rows if i is not None and t}, key=lambda x: x[0])
    split = [t.split("\n") for _, t in docs]
    out = {}
    for d, (i, _) in enumerate(docs):
        mine, gone = split[d], set()
        size = [len(x.split()) for x in mine]
        for other in split[:d]:
            # lengths of the equal runs that end at each pair of lines
            run = [0] * (len(other) + 1)
            for a, x in enumerate(mine):
                run = [0] + [run[b] + 1 if x == y else 0 for b, y in enumerate(other)]
                for n in {n for n in run if n}:
                    if sum(size[a + 1 - n:a + 1]) >= min_words:
                        gone.update(range(a + 1 - n, a + 1))
        out[i] = "\n".join(x for k, x in enumerate(mine) if k not in gone), len(gone)
    return out


def test_lines_against_plain_version(spark):
    r = random.Random(3)
    line = lambda n=9: " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    shared = [line() for _ in range(8)]
    rows = [(1, None), (2, ""), (None, shared[0]), (3, "short\n\n" * 3), (4, "\n".join(shared)), (5, "\n".join(shared)), (5, "\n".join(shared))]
    for i in range(30):
        body = [line(r.randint(1, 12)) for _ in range(6)]
        at = r.randrange(6)
        rows.append((10 + i, "\n".join(body[:at] + shared[i % 5:i % 5 + 3] + ["tiny"] + body[at:] + [shared[7]])))
    rows.append((99, "\n".join(line() for _ in range(300)) + "\n" + shared[2]))
    df = docs_of(spark, rows, gone="x", hs=1, id=5, hash="y", _id=6, _hash="z", _gone=7, n_removed=5)
    out = lines.dedup_lines(df)
    assert out.columns == df.columns  # the count takes the place of the column of its name
    assert lines.dedup_lines(df, count="n_gone").columns == [*df.columns, "n_gone"]
    assert {r.n_removed for r in lines.dedup_lines(df, count="n_gone").collect()} == {5}
    got = out.collect()
    assert len(got) == len(rows)
    want = brute_lines(rows)
    for x in got:
        if x.doc_id in want and x.text is not None:
            assert (x.text, x.n_removed) == want[x.doc_id]
        else:
            assert x.n_removed == 0 and (x.doc_id, x.text) in rows
    assert want[5] == ("", 8)
    assert lines.dedup_lines(docs_of(spark, [])).count() == 0


def test_lines_repeated_and_in_another_order(spark):
    r = random.Random(5)
    line = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(8))
    p, q, z = ([line() for _ in range(3)] for _ in range(3))
    own = lambda: [line()]
    rows = [own() + p + own() + p + own(), own() + p + own(), own() + p + p + own() + p, own() + q + own() + z, z + own() + q + own(), own() + q + z + p + q]
    rows += [own() + r.choice([p, q, z]) + own() + r.choice([p, q, z])[:2] + own() for _ in range(20)]
    rows = [(k, "\n".join(x)) for k, x in enumerate(rows)]
    got = {x.doc_id: (x.text, x.n_removed) for x in lines.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == brute_lines(rows)
    assert [got[k][1] for k in range(6)] == [0, 3, 9, 0, 6, 12]


def test_lines_shorter_than_a_block(spark):
    r = random.Random(6)
    line = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    verse, code = [line(5) for _ in range(20)], [x for _ in range(12) for x in (line(1), "", line(2))]
    few = [line(2), line(3)]
    rows = [verse, [line(9)] + verse[3:] + [line(9)], code, [line(9)] + code + [line(9)] + verse + [line(9)], few + [line(9)], [line(9)] + few, verse]
    rows = [(k, "\n".join(x)) for k, x in enumerate(rows)]
    got = {x.doc_id: (x.text, x.n_removed) for x in lines.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == brute_lines(rows)
    assert [got[k][1] for k in range(7)] == [0, 17, 0, 56, 0, 0, 20]


def test_patience_alignment():
    r = random.Random(8)
    for _ in range(300):
        a, b = ([r.randrange(12) for _ in range(r.randint(0, 15))] for _ in range(2))
        runs = lines.align(a, b)
        assert all(a[i:i + n] == b[j:j + n] and n > 0 for i, j, n in runs)
        assert all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for x, y in zip(runs, runs[1:]))
        assert lines.align(a, a) == ([(0, 0, len(a))] if a else [])
    a, b = list(range(50)), list(range(20)) + [99] * 3 + list(range(20, 50))
    best = difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()[:-1]
    assert lines.align(a, b) == [tuple(x) for x in best]


def test_alignment_deletes_every_common_block():
    r = random.Random(21)
    for _ in range(400):
        kinds = r.choice([4, 12, 40])
        held, own = ([r.randint(1, kinds) for _ in range(r.randint(1, 30))] for _ in range(2))
        words = {k: r.choice([0, 1, 2, 7]) for k in range(1, kinds + 1)}
        text = lambda x: "\n".join(f"{k} " + "w " * words[k] if words[k] else "" for k in x)
        # a line of no words is empty, so lines without words are one line
        name = {k: (k if words[k] else -7) for k in words}
        a, b = [name[k] for k in held], [name[k] for k in own]
        ws = [words[k] + 1 if words[k] else 0 for k in own]
        o = np.array([0, len(b)])
        common = lines.common_lines(np.array(b), np.array(ws), o, np.array(a), np.array([0, len(a)]), 6)
        gone = lines.aligned(a, b, ws, common, 6)
        want = brute_lines([(1, text(held)), (2, text(own))])
        assert int(gone.sum()) == want[2][1] if want.get(2) else not gone.any()


def test_first_of_each_class(spark):
    text = " ".join(f"w{k}" for k in range(60))
    near, other = text + " more", " ".join(f"x{k}" for k in range(50))
    rows = [(1, text), (1, text), (2, text), (2, other), (3, other), (4, near), (None, near), (None, "own words that no other text has here"),
            (None, "own words that no other text has here"), (5, None), (6, ""), (6, ""), (7, "\t "), (8, "short"), (9, "SHORT")]
    df = docs_of(spark, rows, ident=3, hashed="q", comp=4, text_hash=1)
    out = minhash.first_of_each(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, text), (2, other), (None, "own words that no other text has here"), (5, None), (6, ""), (6, ""), (7, "\t "), (8, "short")], key=str)
    assert minhash.first_of_each(docs_of(spark, [])).count() == 0


def test_a_bucket_dealt_over_tasks_links_the_same(spark, monkeypatch):
    rows = near_rows()
    monkeypatch.setattr(minhash, "DEALT", 2)
    got = minhash.classes(docs_of(spark, rows), k=2).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_classes(rows, 2)
