import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import chat, packing, tokens
from tests.llm.helpers import docs_of

TEXTS = [(1, "One two. Three, four!"), (2, None), (3, ""), (3, ""), (None, "null id"), (5, "a" * 9000 + " b\n\tc"), (6, "漢字 ﬁ ² ½. x²."),
         (7, "<s> </s> <|endoftext|> <0x0A>  \r\n "), (8, "▁a ▁▁b"), (9, "same text"), (10, "same text"), (11, "mot " * 3000)]


def test_token_counts_match_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in tokens.token_counts(docs_of(spark, TEXTS)).collect())
    want = sorted((i or -1, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in TEXTS)
    assert got == want
    assert tokens.token_counts(docs_of(spark, [])).count() == 0


def test_packing_round_trip(spark):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for rows in (TEXTS * 20, []):
        pieces = packing.pack(docs_of(spark, rows).repartition(2), window=64).collect()
        want = defaultdict(int)
        for i, t in rows:
            want[(i, tuple(own.encode(t or "", add_special_tokens=False).ids + [0]))] += 1
        seqs, docs = defaultdict(list), defaultdict(list)
        for p in pieces:
            ids = np.frombuffer(p.ids, "<u4")
            assert len(ids) == p.length
            seqs[p.sequence_id].append((p.offset, p.length))
            docs[p.doc_id].append((p.start, tuple(ids), p.doc_tokens))
        short = []
        for s in seqs.values():
            at = 0
            for offset, length in sorted(s):
                assert offset == at
                at += length
            assert at <= 64
            if at < 64:
                assert at & (at - 1) == 0
                short.append(at)
        assert len(short) <= 12
        got, expected = defaultdict(int), defaultdict(int)
        for i, ps in docs.items():
            got[i] = sum(len(p[1]) for p in ps), sum(sum(p[1]) for p in ps)
        for (i, ids), n in want.items():
            a, b = expected.get(i, (0, 0))
            expected[i] = a + n * len(ids), b + n * sum(ids)
        assert got == expected


def test_single_documents_come_back_in_order(spark):
    rows = [(i, t) for i, t in TEXTS if i not in (None, 3)]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = defaultdict(list)
    for p in packing.pack(docs_of(spark, rows), window=32).collect():
        by[p.doc_id].append((p.start, p.ids, p.doc_tokens))
    for i, t in rows:
        ids = np.frombuffer(b"".join(x[1] for x in sorted(by[i])), "<u4")
        assert ids.tolist() == own.encode(t or "", add_special_tokens=False).ids + [0]
        assert {x[2] for x in by[i]} == {len(ids)}


def test_sum_of_squares_choice():
    p, rng = packing.Packer(16), np.random.default_rng(3)
    for d in range(400):
        size, before = int(rng.integers(1, 16)), p.count.copy()
        best = min(sum(x * x for x in after) for h in range(0, 17 - size) if h == 0 or before[h]
                   for after in [[before[k] - (k == h and h > 0) + (k == h + size and h + size < 16) for k in range(17)]])
        list(p.put(d, np.zeros(size, np.uint32)))
        assert (p.count ** 2).sum() == best


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|>\n b"), (1, 2, "assistant", "<\\|start|>"), (1, 2, "assistant", "<\\|start|>"), (1, 3, "user", ""),
         (2, 0, "assistant", None), (3, 5, None, "x"), (3, None, "sys<|message|>", "first"), (None, 1, "user", "lost"), (4, 0, "user", "<" * 5 + "|>" * 3),
         (5, 0, "assistant", "<"), (5, 1, "assistant", "\\|"), (5, 2, "user", "\\### Assistant: </turn> ok"), (6, 0, "user", "z" * 5000)]


def test_chats_come_back(spark):
    df = spark.createDataFrame(CHATS, "conv_id bigint, turn bigint, role string, text string").withColumn("starts", F.lit(1)).withColumn("t", F.lit("x"))
    out = chat.format_chats(df).select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    rows = {r.conv_id: r for r in out.collect()}
    assert set(rows) == {c[0] for c in CHATS}
    for conv, r in rows.items():
        want = sorted((t if t is not None else -1, ro or "", x or "") for c, t, ro, x in CHATS if c == conv)
        assert [(t.role, t.text) for t in r.turns] == [(ro, x) for _, ro, x in want]
        assert r.loss == "".join(x for _, ro, x in want if ro == "assistant")
        runs = sum(k == 0 or want[k][1] != want[k - 1][1] for k in range(len(want)))
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == runs
    assert chat.format_chats(df.limit(0)).count() == 0


def test_checksum_is_unsigned_little_endian(spark):
    r = packing.pack(docs_of(spark, [(1, "abc def")])).select("ids", F.crc32("ids").alias("c")).first()
    assert r.c == zlib.crc32(np.frombuffer(r.ids, "<u4").astype("<u4").tobytes())
    assert hashlib.sha256(bytes(r.ids)).hexdigest()
