import inspect

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import toxicity
from tessera.llm.common import doc_bytes
from tests.llm.test_duplicates import brute_classes, brute_lines
from tests.llm.test_scans import slow_edits

BASE = "/root/testdata/sf0.001"


def test_stages_and_contract(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "decontamination", "packing"]
    for _, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, BASE).columns == docs.columns
        assert f(spark, docs.limit(0), BASE).count() == 0
        assert list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"]


def test_run_against_plain_version(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{BASE}/benchmark.parquet").collect()]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    model = toxicity.train(docs, spark.read.parquet(f"{BASE}/labels.parquet"))
    import pyarrow as pa
    p = model.probability(model.decide(*doc_bytes(pa.array([t for _, t in rows]))))
    rows = [r for r, x in zip(rows, p) if x < 0.3]
    cleaned = brute_lines(rows)
    rows = [(i, cleaned[i][0] if i in cleaned else t) for i, t in rows if i not in cleaned or cleaned[i][0] or not cleaned[i][1]]
    rows = [r for r, (i, _, c) in zip(sorted(rows, key=lambda r: str(r[0])), brute_classes(rows, 5)) if i == c]
    rows = [(i, t) for i, t in rows if not any(slow_edits(x, t) <= int(0.2 * len(x.encode())) for x in items)]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: own.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}
    got: dict[int, list] = {}
    for r in corpus_pipeline.run(spark, BASE).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    assert set(got) == set(want)
    assert {i: np.frombuffer(b"".join(x for _, x in sorted(ps)), "<u4").tolist() for i, ps in got.items()} == want
