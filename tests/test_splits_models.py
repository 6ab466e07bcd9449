"""Splits, preparation and model jobs: invariants and brute-force checks."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import metrics as K, models as G, neighbors, prep, splits as M


def _frame(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.2).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "x1": rng.normal(size=n) + y, "x2": rng.normal(size=n),
                        "cat": rng.choice(["a", "b", "c"], n), "d": pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 90, n), "D")})
    return pdf, spark.createDataFrame(pdf)


def test_stratified_split_exact_shares(spark):
    pdf, df = _frame(spark)
    out = M.stratified_split(df, "y", ["id"], 0.25).toPandas()
    for cls, grp in out.groupby("y"):
        assert (grp["split"] == "test").sum() == math.ceil(0.25 * len(grp))
    assert len(out) == len(pdf) and out["id"].is_unique


def test_hash_split_disjoint_complete_and_stable(spark):
    _, df = _frame(spark)
    a = M.hash_split(df, ["id"], [0.6, 0.2, 0.2], ["tr", "va", "te"]).select("id", "split")
    b = M.hash_split(df.repartition(7), ["id"], [0.6, 0.2, 0.2], ["tr", "va", "te"]).select("id", "split")
    assert a.count() == df.count() and a.select("id").distinct().count() == df.count()
    assert a.exceptAll(b).count() == 0


def test_stratified_folds_balanced(spark):
    _, df = _frame(spark)
    out = M.stratified_kfold_column(df, "y", ["id"], 5).groupBy("fold", "y").count().toPandas()
    for cls, grp in out.groupby("y"):
        assert grp["count"].max() - grp["count"].min() <= 1


def test_time_folds_expand_without_overlap(spark):
    _, df = _frame(spark)
    prev_train = -1
    for tr, te in M.expanding_time_folds(df.withColumn("d", F.col("d").cast("date")), "d", 3):
        assert tr.agg(F.max("d")).first()[0] < te.agg(F.min("d")).first()[0]
        n = tr.count()
        assert n > prev_train
        prev_train = n


def test_resample_sizes_and_weights(spark):
    pdf, df = _frame(spark)
    n_min, n_maj = int(pdf["y"].sum()), int((pdf["y"] == 0).sum())
    out = M.resample_ratio(df, "y", ["id"], 0.3, 0.6).groupBy("y").count().toPandas().set_index("y")["count"]
    target = max(n_min, math.floor(0.3 * n_maj))
    assert out[1] == target and out[0] == min(n_maj, math.floor(target / 0.6))
    w = M.balanced_weights(df, "y").agg(F.sum("weight")).first()[0]
    assert math.isclose(w, len(pdf))


def test_onehot_drop_first_and_unknown(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "cat string")
    test = spark.createDataFrame([("a",), ("c",), ("z",)], "cat string")
    from pyspark.ml import Pipeline
    model = Pipeline(stages=prep.onehot_drop_first(train, ["cat"])).fit(train)
    got = [list(r[0]) for r in model.transform(test).select(vector_to_array("cat_ohe")).collect()]
    assert got == [[0.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_tfidf_formula(spark):
    docs = spark.createDataFrame([(1, "red red blue"), (2, "blue green"), (3, "red")], "id int, text string")
    toks = prep.text_tokens(docs, "text")
    (out,) = prep.tfidf_top_terms(toks, [], "tokens", vocab=3)
    rows = {r["id"]: r["v"] for r in out.select("id", vector_to_array("tfidf").alias("v")).collect()}
    for v in rows.values():
        assert math.isclose(sum(x * x for x in v), 1.0, rel_tol=1e-9)
    n = 3
    idf_red, idf_blue = math.log((1 + n) / (1 + 2)) + 1, math.log((1 + n) / (1 + 2)) + 1
    w = np.array([2 * idf_red, idf_blue])
    assert np.allclose(sorted(x for x in rows[1] if x > 0), sorted(w / np.linalg.norm(w)))


def test_knn_matches_numpy(spark):
    rng = np.random.default_rng(4)
    tr = pd.DataFrame(rng.normal(size=(300, 3)), columns=["a", "b", "c"]).assign(y=rng.normal(size=300), id=np.arange(300))
    te = pd.DataFrame(rng.normal(size=(40, 3)), columns=["a", "b", "c"]).assign(id=np.arange(1000, 1040))
    got = neighbors.knn_regress(spark.createDataFrame(tr), spark.createDataFrame(te), ["a", "b", "c"], "y", "id", k=4,
                        block_rows=70).toPandas().set_index("id")["prediction"]
    X, Q = tr[["a", "b", "c"]].to_numpy(), te[["a", "b", "c"]].to_numpy()
    for i, q in enumerate(Q):
        d = np.sqrt(((X - q) ** 2).sum(1))
        nn = np.argsort(d)[:4]
        assert math.isclose(got[1000 + i], tr["y"].to_numpy()[nn].mean(), rel_tol=1e-9)


def test_isotonic_calibration_is_monotone_and_ece_le_mce(spark):
    rng = np.random.default_rng(9)
    p = rng.random(500)
    y = (rng.random(500) < p ** 2).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y, "id": np.arange(500)}))
    (cal,) = G.isotonic_calibrate(df, [], "p", "y")
    c = cal.orderBy("p").select("calibrated").toPandas()["calibrated"].to_numpy()
    assert (np.diff(c) >= -1e-12).all()
    e = K.ece_mce(df, "y", "p").first()
    assert e["ece"] <= e["mce"] + 1e-12


def test_one_vs_one_separable(spark):
    from pyspark.ml.feature import VectorAssembler
    rows = [(float(c), float(c * 10 + j % 3), float(j % 2)) for c in range(3) for j in range(30)]
    df = VectorAssembler(inputCols=["f1", "f2"], outputCol="features").transform(
        spark.createDataFrame(rows, "label double, f1 double, f2 double"))
    pred = G.one_vs_one(df, df, [0.0, 1.0, 2.0], make=lambda: G.LogisticRegression(maxIter=50))
    acc = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.95


def test_knn_blocks_bounds_and_metrics(spark):
    """A third of the training rows in one place, ties, cells and blocks of a few rows: the same as brute force."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(240, 6)), 1)
    x[:80] = x[0]
    q = np.vstack((x[:5], np.round(rng.normal(size=(40, 6)), 1), np.full((1, 6), 50.0)))
    y = rng.normal(size=len(x))
    train = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))] + [(999, None, 1.0)], "id long, x array<double>, y double")
    test = spark.createDataFrame([(f"t{i}", v.tolist()) for i, v in enumerate(q)] + [("none", None)], "id string, x array<double>")
    for metric in ("euclidean", "manhattan"):
        got = {}
        for r in neighbors.nearest(train, test, k=7, metric=metric, block_rows=16, pivots=9).collect():
            got.setdefault(r.id, []).append((r.rank, r.near, round(r.d, 9)))
        d = neighbors.distances(q, x, metric)
        assert set(got) == {f"t{i}" for i in range(len(q))}
        for i in range(len(q)):
            want = sorted(range(len(x)), key=lambda j: (d[i, j], j))[:7]
            assert sorted(got[f"t{i}"]) == [(n + 1, j, round(d[i, j], 9)) for n, j in enumerate(want)]
    few = neighbors.nearest(train.limit(3), test, k=7).groupBy("id").count().select("count").distinct().collect()
    assert [r[0] for r in few] == [3]
    assert neighbors.nearest(train.limit(0), test).count() == 0 and neighbors.nearest(train, test.limit(0)).count() == 0


def test_resample_without_minority(spark):
    df = spark.range(20).withColumn("y", F.lit(0))
    assert M.resample_ratio(df, "y", ["id"]).count() == 20


def test_knn_hands_on_vectors_in_bounded_pieces():
    import pyarrow as pa
    from tessera.operators import neighbors as N

    class Frame:   # stands for a frame: takes the function that its tasks run
        schema = type("S", (), {"__getitem__": lambda self, c: type("C", (), {"dataType": type("D", (), {"simpleString": lambda self: "bigint"})()})()})()
        sparkSession = type("P", (), {"sparkContext": type("X", (), {"broadcast": staticmethod(lambda v: type("B", (), {"value": v})())})()})()

        def mapInArrow(self, run, spec):
            return run

    rng = np.random.default_rng(8)
    pivots = rng.normal(size=(256, 64))
    cells = {c: (1, 0.0, 100.0) for c in range(256)}
    x = pa.array(list(rng.normal(size=(2500, 64))), pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500)), x, pa.array([1e9] * 2500)], names=["id", "x", "bound"])
    out = [(b.num_rows, b.nbytes) for b in N._chosen(Frame(), pivots, cells, "euclidean", 5, True)(iter([batch]))]
    assert sum(n for n, _ in out) == 2500 * 251 and max(s for _, s in out) <= 2 * N.SENT


def _brute(q, x, rank, k, metric, bound=None):
    d = neighbors.distances(q, x, metric)
    best = [np.lexsort((rank, d[i]))[:k] for i in range(len(q))]
    return sorted((i, int(rank[j]), d[i, j]) for i, js in enumerate(best) for j in js if bound is None or np.isnan(bound[i]) or d[i, j] <= bound[i])


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_closest_is_exact(metric):
    """Ties, points far from zero, huge and tiny ones, missing and endless coordinates, many and few dimensions: bit by bit as brute force."""
    rng = np.random.default_rng(5)
    ties = np.round(rng.normal(size=(3000, 6)), 1)
    ties[:1000] = ties[0]
    odd = rng.normal(size=(3000, 8))
    odd[3, 2], odd[5, 1], odd[9] = np.nan, np.inf, 1e9
    asked = rng.normal(size=(40, 8))
    asked[4, 4], asked[7, 0] = np.nan, -np.inf
    cases = [(rng.normal(size=(40, n)), rng.normal(size=(3000, n))) for n in (1, 3, 64, 700)]
    cases += [(f(np.vstack((ties[:30], np.full((1, 6), 50.0)))), f(ties)) for f in (lambda v: v, lambda v: v * 1e-9 + 1e6, lambda v: v * 1e150, lambda v: v * 1e-160)]
    cases += [(asked, odd), (asked[:3], odd[:4]), (np.ones((20, 5)), np.zeros((2500, 5)))]
    for q, x in cases:
        rank = rng.permutation(len(x))
        d = neighbors.distances(q, x, metric)
        tenth = np.sort(d, axis=1)[:, min(10, len(x) - 1)]
        for bound in (None, np.where(np.isfinite(d).sum(1) > 10, tenth, np.nan)):
            row, col, dist = neighbors.closest(q, x, rank, 5, metric, bound)
            assert np.array_equal(np.array(sorted(zip(row, rank[col], dist))), np.array(_brute(q, x, rank, 5, metric, bound)), equal_nan=True)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_closest_takes_few_distances(metric, monkeypatch):
    rng = np.random.default_rng(6)
    q, x, taken = rng.normal(size=(256, 64)), rng.normal(size=(20_000, 64)), []
    pairs, plain = neighbors._of_pairs, neighbors.distances
    monkeypatch.setattr(neighbors, "_of_pairs", lambda q, x, row, col, m: taken.append(len(row)) or pairs(q, x, row, col, m))
    monkeypatch.setattr(neighbors, "distances", lambda q, x, m: taken.append(len(q) * len(x)) or plain(q, x, m))
    neighbors.closest(q, x, np.arange(len(x)), 5, metric)
    assert sum(taken) < 0.03 * len(q) * len(x)


def test_knn_zones_hold_neighbouring_cells():
    """Cells of few rows make up a zone, a large one stands alone, and a test row goes to a zone once."""
    import pyarrow as pa
    pivots = np.arange(40.0)[::-1, None]
    cells = {c: (500 if c == 7 else 10, 0.0, 0.5) for c in range(40) if c != 20}
    zones = neighbors._zones(cells, pivots, "euclidean", 100)
    held = {z: sorted(c for c in cells if zones[c] == z) for z in set(zones.values())}
    assert set(zones) == set(cells) and held[zones[7]] == [7] and max(len(v) for v in held.values()) == 10 and len(held) < 8

    class Frame:   # stands for a frame: takes the function that its tasks run
        schema = type("S", (), {"__getitem__": lambda self, c: type("C", (), {"dataType": type("D", (), {"simpleString": lambda self: "bigint"})()})()})()
        sparkSession = type("P", (), {"sparkContext": type("X", (), {"broadcast": staticmethod(lambda v: type("B", (), {"value": v})())})()})()

        def mapInArrow(self, run, spec):
            return run

    x = pa.array([[5.2], [38.9], [float("nan")]], pa.list_(pa.float64()))
    for bound in (1.0, 1e9):
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), x, pa.array([bound, bound, float("nan")])], names=["id", "x", "bound"])
        sent = [[r for b in neighbors._chosen(Frame(), pivots, cells, "euclidean", 5, rest, zones)(iter([batch])) for r in zip(b.column("id").to_pylist(), b.column("zone").to_pylist())] for rest in (False, True)]
        assert len(set(sent[0] + sent[1])) == len(sent[0] + sent[1])
        assert {z for i, z in sent[0] + sent[1] if i == 3} == set(held)
        near = {zones[c] for c in (33, 34, 35)}   # the pivots 6, 5 and 4
        assert {z for i, z in sent[0] + sent[1] if i == 1} >= (near if bound == 1.0 else set(held))
