"""The registered queries themselves, their last columns included, against plain versions on the smallest tables."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import queries
from tests.llm.test_scans import plain_spans

BASE = "/root/testdata/sf0.001"
sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{BASE}/documents.parquet").collect()}


def test_op1_columns(spark, docs):
    first = {}
    for i in sorted(docs):
        b = docs[i].encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op1_suffix_dedup"](spark, BASE).collect()}
    assert set(got) == set(docs)
    for i, t in docs.items():
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        assert got[i] == (len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())), i


def test_op3_columns(spark, docs):
    for r in queries.QUERIES["op3_secret_scan"](spark, BASE).collect():
        base = plain_spans(docs[r.doc_id])
        assert r.base_sha256 == sha(",".join(base))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k + ":") for s in base) for k in ("assign", "access", "hex")]
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("format")] == base
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_op5_columns(spark, docs):
    rows = queries.QUERIES["op5_toxicity"](spark, BASE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op8_columns(spark, docs):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(own.encode(t, add_special_tokens=False).ids + [0], "<u4") for i, t in docs.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op8_packing"](spark, BASE).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, x in ids.items():
        ends = [0] + [s + n for s, n in sorted(pieces[i])]
        assert [s for s, _ in sorted(pieces[i])] == ends[:-1] and ends[-1] == len(x)
    for s in sequences.values():
        ends = [0] + [o + n for o, n in sorted(s)]
        assert [o for o, _ in sorted(s)] == ends[:-1] and ends[-1] <= 1024


def test_op10_columns(spark, docs):
    order = sorted(docs, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    for r in queries.QUERIES["op10_fingerprints"](spark, BASE).collect():
        t = docs[r.doc_id]
        n = len(t) // 3
        assert r.n_chars == len(t) and r.edited_sha256 == sha(t[:len(t) - n] + docs[after[r.doc_id]][:n])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and (r.fingerprint == r.edited_fingerprint) == (r.edited_sha256 == sha(t))


@pytest.mark.parametrize("name", ["op2_minhash", "op6_chat_formatting", "op11_manifest", "op12_ranked_search", "op13_sharding"])
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{BASE}/{t}.parquet')")
    got = queries.QUERIES[name](spark, BASE)
    cur = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == sorted(cur.fetchall(), key=str)
