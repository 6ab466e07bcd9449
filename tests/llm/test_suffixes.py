import random

import numpy as np

from tessera.llm import suffixes
from tests.llm.helpers import docs_of


def plain(rows, size=50):
    """doc_id -> removed flags, by a table of all strings."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            if i is not None:
                first[b[p:p + size]] = min(first.get(b[p:p + size], i), i)
    out = []
    for i, t in rows:
        b, gone = (t or "").encode(), np.zeros(len((t or "").encode()), bool)
        for p in range(len(b) - size + 1):
            if i is not None and first[b[p:p + size]] < i:
                gone[p:p + size] = True
        runs = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
        out.append((str(i), len(b), tuple(map(tuple, runs.tolist())), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out)


def rows_with_repeats():
    r = random.Random(11)
    text = lambda n, al="abcdefgh é\n": "".join(r.choice(al) for _ in range(n))
    passages = [text(n) for n in (49, 50, 51, 60, 75, 90, 200, 400)]
    rows = [(0, None), (1, ""), (2, passages[0]), (None, passages[7]), (3, "a" * 500), (4, "a" * 49), (5, "ab" * 300), (6, "ba" * 40 + "a" * 60), (7, passages[7]), (7, passages[7]), (8, passages[7])]
    for i in range(60):
        s = text(r.randint(0, 150))
        for _ in range(r.randint(0, 4)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 3)
            s += p[a:len(p) - r.randint(0, len(p) // 3)] + text(r.randint(0, 30))
        rows.append((100 + (i * 37) % 60, s))
    rows.append((500, text(60000) + passages[6] + text(9)))
    rows.append((501, rows[20][1] * 3))
    return rows


def test_against_table_of_all_strings(spark):
    rows = rows_with_repeats()
    got = suffixes.remove_repeats(docs_of(spark, rows, g=1, b="x")).collect()
    assert sorted((str(r.doc_id), r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in got) == plain(rows)
    assert suffixes.remove_repeats(docs_of(spark, [])).count() == 0


def test_refinement_orders_like_suffixes():
    r = np.random.default_rng(5)
    text = r.integers(97, 99, (300, suffixes.SPAN)).astype(np.uint8)
    text[100:200] = text[:100]
    text[100:200, 60] = 99
    p = suffixes.equal_strings(text)
    strings = [[text[u, j:j + suffixes.L].tobytes() for j in range(suffixes.W)] for u in range(len(text))]
    flat = sorted((s, int(p[u, j])) for u, row in enumerate(strings) for j, s in enumerate(row))
    for (a, x), (b, y) in zip(flat, flat[1:]):
        assert (a == b) == (x == y)
