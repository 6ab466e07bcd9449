import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import decontaminate, secrets, toxicity
from tests.llm.helpers import docs_of

HEX = "0123456789abcdef"


def plain_spans(text):
    """Base spans by the stated rules, each pattern alone."""
    out = []
    for kind, pattern, ok in (("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
                              ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), kind, m.end()) for m in re.finditer(pattern, text) if ok(m)]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def secret_rows():
    r = random.Random(5)
    rows = [(1, None), (2, ""), (3, "é password = 'hunter22' tOkEn:abc apikey=1234567"), (4, "AKIA" + "Z" * 16 + " AKIA" + "9" * 15), (5, "ſecret=abcdefgh api_Key=abcdefgh"),
            (6, "f" * 23 + " " + "f" * 24), (6, "f" * 23 + " " + "f" * 24), (None, "secret: " + "a1" * 20), (7, "word " * 4000 + "token=" + "0" * 30)]
    for i in range(60):
        rows.append((100 + i, "plain words here " + "".join(r.choice(HEX) for _ in range(40)) + " token = \"" + "".join(r.choice(HEX) for _ in range(18)) + "\" " + "".join(r.choice("aeiourstlnm") for _ in range(18))))
    rows.append((500, "see " + "".join(r.choice(HEX) for _ in range(20)) + " there"))
    return rows


def test_secrets_keep_base_spans_and_add_formats(spark):
    rows = secret_rows()
    docs = docs_of(spark, rows)
    model = secrets.fit(docs)
    got = sorted((r.doc_id or -1, [f"{s.kind}:{s.start}:{s.end}" for s in r.spans]) for r in secrets.scan(docs, model).collect())
    base = [(i, [s for s in x if not s.startswith("format")]) for i, x in got]
    assert base == sorted((i or -1, plain_spans(t or "")) for i, t in rows)
    assert dict(got)[500] == ["format:4:24"]
    assert all(not any(s.startswith("format") for s in x) for i, x in got if i != 500)
    empty = docs_of(spark, [])
    assert secrets.scan(empty, secrets.fit(empty)).count() == 0


def test_automaton_generalises():
    a = secrets.Automaton(["ab" * n for n in (2, 3, 4, 5, 6) for _ in range(60)])
    assert a.likelihood("ab" * 4) > a.likelihood("zz" * 4) + 10


def labelled(spark, n=400):
    r = random.Random(1)
    bad, good = ["blorg", "snarfle"], ["".join(r.choice("aeioulnrst") for _ in range(r.randint(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        ws = [r.choice(good) for _ in range(40)]
        if i % 5 == 0:
            w = r.choice(bad)
            ws[7] = r.choice([w, w.upper(), w[:2] + "-" + w[2:], w + "$$$", " ".join(w), w + "er"])
        rows.append((i, " ".join(ws)))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_toxicity_held_out_and_edge_rows(spark):
    rows, labels = labelled(spark)
    rows += [(9000, None), (9001, ""), (9002, "blorg"), (None, "snarfle"), (9003, "blorg " * 9000)]
    docs = docs_of(spark, rows, score="clash")
    lab = spark.createDataFrame(labels + [(None, 1), (3, None), (77777, 1)], "doc_id bigint, toxic int")
    texts, y = toxicity.training_sample(docs, lab)
    assert len(texts) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in labels)
    out = toxicity.score(docs, toxicity.fit(texts, y))
    assert set(out.columns) == set(docs.columns)
    got = {r.doc_id: r.score for r in out.select("doc_id", "score").collect()}
    assert all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.3, t) for i, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(p != bool(t) for p, t in held) <= 0.05 * len(held)
    assert got[9002] >= 0.3 and got[None] >= 0.3 and got[9003] >= 0.3 and got[9000] < 0.3 and got[9001] == got[9000]
    assert toxicity.train(docs.limit(0), lab.limit(0)).slope == 0
    assert toxicity.score(docs.limit(0), toxicity.fit([], [])).count() == 0


def test_kernel_against_plain_subsequences():
    """The weights of a unit, its length and a model's score, from all index triples of the definition."""
    r = random.Random(3)
    symbol = lambda c: int(toxicity.SYMBOL[c])

    def plain(unit):
        out = {}
        for i in range(len(unit)):
            for j in range(i + 1, len(unit)):
                for k in range(j + 1, min(len(unit), i + toxicity.REACH + 1)):
                    t = symbol(unit[i]), symbol(unit[j]), symbol(unit[k])
                    if all(t):
                        out[t] = out.get(t, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    units = ["".join(r.choice("abc-1 é") for _ in range(r.randint(1, 14))).strip().encode() or b"a" for _ in range(60)]
    weight = np.random.default_rng(0).normal(size=toxicity.SPACE).astype(np.float32) * (toxicity._WHOLE > 0)
    model = toxicity.Model(weight, -0.1, 1.0, 0.0)
    flat = np.frombuffer(b"".join(units), np.uint8)
    end = np.cumsum([len(u) for u in units])
    start = end - [len(u) for u in units]
    for u, got in zip(units, model.word_scores(flat, start, end)):
        want = plain(u)
        split = lambda c: (c >> 2 * toxicity.BITS, c >> toxicity.BITS & 63, c & 63)
        have = {split(c): w for c, w in toxicity.triples(u).items()}
        assert have.keys() == want.keys() and all(abs(have[t] - want[t]) < 1e-12 for t in want)
        value = sum(w * weight[(t[0] << 2 * toxicity.BITS) | (t[1] << toxicity.BITS) | t[2]] for t, w in want.items())
        exact = value / np.sqrt(sum(w * w for w in want.values())) - 0.1 if want else -0.1
        assert abs(got - exact) < 1e-4 or (got <= 0 and exact <= 0)  # exact where it can call a text toxic


def test_units_of_a_sentence():
    flat = np.frombuffer(b"ab cd. ef  g h\nij " + b"x" * 40 + b" k", np.uint8)
    start, end, doc = toxicity.words(flat, np.array([0, len(flat)]))
    got = sorted(flat[a:b].tobytes() for a, b in zip(start, end))
    assert got == sorted([b"ab", b"cd.", b"ef", b"g h", b"ij", b"x" * 40, b"k", b"ab cd.", b"ef  g h"])


def toxic_texts(n, vocab, r, put):
    texts, y = [], []
    for i in range(n):
        ws = [r.choice(vocab) for _ in range(40)]
        put(i, ws)
        texts.append(" ".join(ws))
        y.append(int(i % 5 == 0))
    return texts, y


def test_toxic_phrases_cut_insults_and_other_scripts():
    from tessera.llm.common import doc_bytes
    r = random.Random(1)
    latin = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(3, 8))) for _ in range(300)]
    other = ["".join(r.choice("абвгдежзиклмнопрст") for _ in range(r.randint(3, 8))) for _ in range(300)]

    def phrase(i, ws):
        for j in r.sample(range(10, 40), 2):
            ws[j] = "green"  # in every text, and "tomato" in half of the clean ones
        if i % 5 == 0:
            ws[7:9] = ["green", "tomato"]
        elif r.random() < 0.5:
            ws[3] = "tomato"

    def word(bad):
        def put(i, ws):
            if i % 5 == 0:
                ws[7] = r.choice(bad)
        return put

    def judged(vocab, put):
        model = toxicity.fit(*toxic_texts(600, vocab, r, put))
        texts, y = toxic_texts(300, vocab, r, put)
        p = model.probability(model.decide(*doc_bytes(pa.array(texts)))) >= 0.3
        y = np.array(y) == 1
        assert p[y].mean() >= 0.95 and p[~y].mean() <= 0.03
        return model

    judged(latin, phrase)
    judged(other, word(["шурубурум", "цыцыкака"]))
    model = judged(latin, word(["blorgfizz", "snarfleblorg"]))
    for w in ("snarfleblorg", "SNAR fleblorg", "snar.fle-blorg", "s n a r f l e b l o r g"):
        assert model.probability(model.decide(*doc_bytes(pa.array(["le ane " + w + " re nelo"]))))[0] >= 0.3


def test_toxicity_on_given_labels(spark):
    base = "/root/testdata/sf0.1"
    docs, lab = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    rows = toxicity.score(docs, toxicity.train(docs, lab)).join(lab, "doc_id").where(held).select("score", "toxic").collect()
    p, y = np.array([r.score >= 0.3 for r in rows]), np.array([r.toxic for r in rows]) == 1
    assert (p & y).sum() >= 0.75 * y.sum() and (p & y).sum() >= 0.75 * p.sum()


def slow_edits(item: str, text: str) -> int:
    """Least edits between the item and any substring, by the plain table, over bytes."""
    fold = lambda s: np.frombuffer(decontaminate.normal(np.frombuffer(s.encode(), np.uint8)).tobytes(), np.uint8)
    a, b = fold(item), fold(text)
    row = np.zeros(len(b) + 1, np.int64)
    for i, c in enumerate(a):
        new = np.minimum(row[1:] + 1, row[:-1] + (b != c))
        new = np.concatenate(([i + 1], new))
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def test_decontamination_against_brute_force(spark):
    r = random.Random(2)
    text = lambda n: " ".join("".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 9))) for _ in range(n))
    items = [(k, text(r.randint(18, 50))) for k in range(12)] + [(50, None), (51, ""), (52, "Short one é"), (None, text(30))]
    docs = [(i, text(120)) for i in range(40)] + [(900, None), (901, ""), (902, text(6000))]
    for k, t in items:
        if not t:
            continue
        s = list(t)
        for _ in range(len(s) // 12):
            p = r.randrange(len(s))
            s[p:p + 1] = r.choice([[], ["x"], [s[p], "y"]])
        docs += [(100 + (k or 0), text(20) + "\n" + t.upper() + " " + text(9)), (200 + (k or 0), "".join(s)), (None, t)]
    d, b = docs_of(spark, docs), spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = decontaminate.hits(d, b).collect()
    want = set()
    for i, t in docs:
        for k, x in items:
            if x and t:
                n = slow_edits(x, t)
                if n <= int(0.2 * len(x.encode())):
                    want.add((i, k, n))
    assert {(r.doc_id, r.item_id) for r in got} == {w[:2] for w in want}
    assert sum((r.doc_id, r.item_id, r.edits) in want for r in got) >= 0.95 * len(got)
    one = {(x.doc_id, x.item_id) for x in decontaminate.hits(d, b, block_bytes=400).collect()}
    assert one == {w[:2] for w in want}
    bad = {w[0] for w in want}
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(i for i, _ in docs if i not in bad and i is not None)
    assert decontaminate.hits(d, b.limit(0)).count() == 0 and decontaminate.hits(d.limit(0), b).count() == 0
    assert decontaminate.clean(d, b.limit(0)).count() == len(docs)


def test_decontamination_at_the_limit():
    from tessera.llm.common import doc_bytes
    r = random.Random(11)
    text = lambda n: " ".join("".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 9))) for _ in range(n))

    def edited(t, way):
        s = list(t)
        for p in range(len(s) - 1 - r.randrange(5), -1, -5) if way != "random" else sorted(r.sample(range(len(s)), len(s) // 5), reverse=True):
            s[p:p + 1] = {"other": ["#"], "gone": [], "more": [s[p], "#"], "random": r.choice([["#"], [], [s[p], "x"]])}[way]
        return "".join(s)

    items = [text(80)[:n] for n in (1, 4, 5, 9, 14, 21, 30, 47, 48, 60, 79) for _ in range(2)]
    docs = [text(9) + " " + edited(t, way) + " " + text(9) for t in items for way in ("other", "gone", "more", "random")]
    docs += [t.replace(" ", "  ") for t in items]
    got = {(d, k) for d, k, *_ in decontaminate.Index(list(range(len(items))), [t.encode() for t in items]).find(*doc_bytes(pa.array(docs)))}
    assert got == {(d, k) for d, t in enumerate(docs) for k, x in enumerate(items) if slow_edits(x, t) <= int(0.2 * len(x))}


def limit_edits(r, t, way):
    """A fifth of the bytes edited, in the ways that leave the least for a search to hold on to."""
    most = len(t) // 5
    if way == "three and five":
        at, step = set(), [4, 6]
        p = 3
        while p < len(t) and len(at) < most:
            at.add(p)
            p += step[len(at) % 2]
        return "".join("#" if i in at else c for i, c in enumerate(t))
    if way == "burst":
        p = r.randrange(len(t) - most)
        return t[:p] + "#" * most + t[p + most:]
    if way == "random":
        s = list(t)
        for _ in range(most):
            p = r.randrange(len(s))
            s[p:p + 1] = r.choice([["#"], [], [s[p], "#"]])
        return "".join(s)
    if way == "two inserted":
        return "".join(c + "##" if i % 10 == 9 else c for i, c in enumerate(t))
    made = {"other": lambda c: "#", "gone": lambda c: "", "more": lambda c: c + "#"}[way]
    return "".join(made(c) if i % 5 == 4 else c for i, c in enumerate(t))


def test_recall_at_the_limit_by_length():
    from tessera.llm.common import doc_bytes
    r = random.Random(12)
    words = ["".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    for n in (50, 80, 110, 170, 230, 400, 1200, 3000):
        each = 40 if n < 1000 else 5
        for way in ("three and five", "burst", "random", "two inserted", "other", "gone", "more"):
            items = [text(n // 3)[:n].rjust(n, "e") for _ in range(each)]
            docs = [text(6) + " " + limit_edits(r, t, way) + " " + text(6) for t in items]
            got = {(d, k) for d, k, *_ in decontaminate.Index(list(range(each)), [t.encode() for t in items]).find(*doc_bytes(pa.array(docs)))}
            found = sum((d, d) in got for d in range(each))
            assert found >= (0.85 if each == 40 else 1) * each, (n, way, found)  # 0.9 on average, less the spread of 40 draws


def test_many_short_items_are_looked_up_together():
    import time
    from tessera.llm.common import doc_bytes
    r = random.Random(13)
    text = lambda n: " ".join("".join(r.choice("aeioustrnlmdcp") for _ in range(r.randint(2, 9))) for _ in range(n))
    items, docs = [text(12)[:40].ljust(40, "a").encode() for _ in range(1000)], [text(8000) for _ in range(4)]
    took = []
    for n in (100, 1000):
        x = decontaminate.Index(list(range(n)), items[:n])
        t = time.perf_counter()
        x.find(*doc_bytes(pa.array(docs)))
        took.append(time.perf_counter() - t)
    assert took[1] < 30


def test_distances_of_many_pairs():
    r = random.Random(14)
    text = lambda n: bytes(r.choice(b"ab c") for _ in range(n))
    items = [text(r.choice([1, 5, 63, 64, 65, 130, 200])) for _ in range(60)]
    flat = np.frombuffer(text(5000), np.uint8)
    lo = np.array([r.randrange(4700) for _ in items])
    hi = lo + np.array([r.randint(0, 300) for _ in items])
    size = np.array([len(t) for t in items])
    dist, end = decontaminate.edit_matches(decontaminate.places_of(items), np.arange(60), size, flat, lo, hi)
    assert [decontaminate.edit_match(t, flat[a:b].tobytes()) for t, a, b in zip(items, lo, hi)] == list(zip(dist.tolist(), end.tolist()))
    short = np.flatnonzero(size <= 64)
    least = decontaminate.edits_at_most(decontaminate.places_of(items)[0], short, size[short], flat, lo[short], 250)
    assert least.tolist() == [decontaminate.edit_match(items[k], flat[lo[k]:lo[k] + 250].tobytes())[0] for k in short]


def test_walks_step_by_step():
    r = np.random.default_rng(15)
    for n in (0, 19, 20, 300, (1 << 14) + 50):  # beyond one piece
        flat = r.integers(0, 256, n).astype(np.uint8)
        got = decontaminate.walks(flat)
        assert [len(x) for x in got] == [max(n - 19, 0)] * decontaminate.SAMPLES
        for a in [*range(max(n - 19, 0))][:40] + [*range(max(n - 19, 0))][-60:]:
            keys, place = [*range(1, decontaminate.SAMPLES + 1)], a
            for j in range(decontaminate.STEPS):
                c = int(flat[place])
                keys = [(k * 0x9E3779B1 + c) % (1 << 32) if j in sampled else k for k, sampled in zip(keys, decontaminate._SAMPLED)]
                place += int(decontaminate._GO_ON[j, c])
            assert [int(x[a]) for x in got] == [(k ^ k >> 15) * 0x85EBCA6B % (1 << 32) for k in keys]


def test_distances_looked_at_now_and_then_are_bounds():
    r = random.Random(16)
    text = lambda n: bytes(r.choice(b"ab c") for _ in range(n))
    items = [text(r.choice([1, 3, 17, 63, 64])) for _ in range(50)]
    flat, lo, size = np.frombuffer(text(3000), np.uint8), np.array([r.randrange(3000) for _ in items]), np.array([len(t) for t in items])
    for steps in (0, 1, 3, 90):
        exact, bound = (decontaminate.edits_at_most(decontaminate.places_of(items)[0], np.arange(50), size, flat, lo, steps, every=e) for e in (1, 4))
        assert (bound <= exact).all() and (bound >= exact - 2).all()


def test_windows_are_given_up_before_all_chunks_are_compared(monkeypatch):
    from tessera.llm.common import doc_bytes
    r = random.Random(17)
    words = ["".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 9))) for _ in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items, docs = [text(150)[:250].encode() for _ in range(60)], [text(400) for _ in range(60)]
    x, pairs, exact = decontaminate.Index(list(range(60)), items), [], decontaminate.edits_at_most
    monkeypatch.setattr(decontaminate, "edits_at_most", lambda peq, which, *a, **k: (pairs.append(len(which)), exact(peq, which, *a, **k))[1])
    flat, offsets = doc_bytes(pa.array(docs + [docs[0] + items[7].decode() + docs[1]]))
    every = sum(int(x.chunk_at[k + 1] - x.chunk_at[k]) for k in x.windows(decontaminate.normal(flat), offsets)[:, 1])
    assert (60, 7) in {(d, k) for d, k, *_ in x.find(flat, offsets)}
    assert every > 1000 and 0 < sum(pairs) < 0.8 * every


def test_bit_parallel_distance():
    r = random.Random(4)
    for _ in range(200):
        a, b = ("".join(r.choice("ab c") for _ in range(n)) for n in (r.randint(1, 20), r.randint(0, 40)))
        assert decontaminate.edit_match(a.encode(), b.encode())[0] == min(slow_edits(a, b), len(a))


def test_chunks_of_documents_do_not_mix():
    x = decontaminate.Index([1], [b"the quick brown fox jumps over the lazy dog and then some more words"])
    half = "the quick brown fox jumps over th"
    from tessera.llm.common import doc_bytes
    assert x.find(*doc_bytes(pa.array([half, "e lazy dog and then some more words"]))) == []


def test_units_of_many_texts_take_little_memory():
    import tracemalloc
    from tessera.llm import toxicity
    from tessera.llm.common import span_hash
    rng = np.random.default_rng(5)
    letters = np.where(rng.random(6 << 20) < 0.18, 32, rng.integers(97, 123, 6 << 20)).astype(np.uint8)
    offsets = np.concatenate((np.arange(0, len(letters), 5000), [len(letters)])).astype(np.int64)
    tracemalloc.start()
    start, end, doc, sign = toxicity.units(letters, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(letters)
    s, e, d = toxicity.words(letters, offsets)
    assert all((a == b).all() for a, b in ((start, s), (end, e), (doc, d), (sign, span_hash(letters, s, e))))
