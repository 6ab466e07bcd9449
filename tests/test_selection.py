"""Linear fits from moments, exact scorers, selection and permutation against numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import linear, models as G, selection


def _ap(y, s):
    """Average precision with equal scores as one threshold."""
    out, total = 0.0, y.sum()
    for t in np.unique(s)[::-1]:
        hit = s >= t
        out += (y[s == t].sum() / total) * y[hit].sum() / hit.sum()
    return out


def _auc(y, s):
    p, n = s[y == 1], s[y == 0]
    return ((p[:, None] > n[None, :]).sum() + 0.5 * (p[:, None] == n[None, :]).sum()) / (len(p) * len(n))


def test_fits_from_moments(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 4)) * [1, 10, 0.1, 3] + [5, -20, 0, 1000]
    y = x @ [2, 0.5, 30, 0] + rng.normal(size=400)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=y)
    pdf.loc[7, "a"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("a", F.nanvl("a", F.lit(None))).repartition(5)
    known = pdf.dropna()
    X, Y = known[list("abcd")].to_numpy(), known["y"].to_numpy()
    fits = linear.alpha_grid(df, list("abcd"), "y", (0.01, 1.0))
    by = {(f.model, f.alpha): f for f in fits}
    own = by["ols", 0.0]
    rest = Y - own.intercept - X @ own.weights
    assert abs(rest.mean()) < 1e-8 and np.abs((X - X.mean(0)).T @ rest).max() < 1e-6  # orthogonal to the columns
    C, c = X - X.mean(0), Y - Y.mean()
    for a in (0.01, 1.0):
        assert np.allclose(by["ridge", a].weights, np.linalg.solve(C.T @ C + a * np.eye(4), C.T @ c))
        w = by["lasso", a].weights
        slope = C.T @ (c - C @ w) / len(c)       # of the squared error; the penalty's slope has to cancel it
        assert all(abs(g - a * np.sign(v)) < 1e-6 if v else abs(g) <= a + 1e-6 for g, v in zip(slope, w))
    table = linear.alpha_grid_scores(fits, df, list("abcd"), "y").toPandas()
    for r in table.itertuples():
        f = by[r.model, r.alpha]
        assert np.isclose(r.mae, np.abs(Y - f.intercept - X @ f.weights).mean())
    assert table.groupby("model")["best"].sum().eq(1).all()
    assert linear.alpha_grid(df.limit(0), ["a"], "y") == []


def test_scorers_match_plain_ones(spark):
    rng = np.random.default_rng(2)
    rows = [(c, f, int(rng.random() < 0.3), float(np.round(rng.random(), 1 if c == "ties" else 9))) for c in ("ties", "fine") for f in range(3) for _ in range(200)]
    df = spark.createDataFrame(rows, "candidate string, fold int, y int, score double")
    pdf = df.toPandas()
    got = selection.ranking_scores(df).toPandas().set_index(["candidate", "fold"])
    cut = selection.threshold_scores(df, 0.5).toPandas().set_index(["candidate", "fold"])
    for k, g in pdf.groupby(["candidate", "fold"]):
        y, s = g["y"].to_numpy(), g["score"].to_numpy()
        assert np.isclose(got.loc[k, "average_precision"], _ap(y, s)) and np.isclose(got.loc[k, "roc_auc"], _auc(y, s))
        assert np.isclose(cut.loc[k, "missed_rate"], ((s <= 0.5) & (y == 1)).sum() / y.sum())
    best = selection.summarise(selection.ranking_scores(df), "roc_auc").orderBy("place").toPandas()
    assert best["mean_score"].is_monotonic_decreasing and list(best["place"]) == [1, 2]


def test_grouped_time_folds(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate([1, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 9])], "id int, d int")
    got = {}
    for r in selection.grouped_time_folds(df, "d", test_periods=2, n_splits=3).collect():
        got.setdefault((r.fold, r.role), set()).add(r.d)
    assert got == {(f, role): set(range(a, b)) for f in range(3) for role, a, b in (("train", 1, 4 + 2 * f), ("validation", 4 + 2 * f, 6 + 2 * f))}


def test_search_over_a_fixed_pair(spark):
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(float)
    df = VectorAssembler(inputCols=list("abc"), outputCol="features").transform(spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(label=y)))
    pair = df.where("c > 0"), df.where("c <= 0")
    grid = {"weak": G.logistic(reg=0.01), "none": G.logistic(reg=1000.0, elastic=1.0)}
    out = selection.search(grid, [pair], "label", "average_precision").orderBy("place").collect()
    assert [r.candidate for r in out] == ["weak", "none"] and out[0].mean_score > 0.9


def test_backward_selection_drops_useless_columns(spark):
    rng = np.random.default_rng(5)
    n = 1500
    x = rng.normal(size=(n, 7))
    y = (x[:, 1] + x[:, 3] - x[:, 5] + 0.2 * rng.normal(size=n) > 0.5).astype(int)
    names = [f"x{i}" for i in range(7)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(y=y, fold=np.arange(n) % 2))
    steps = selection.backward_select(df, names, "y", "fold", keep=3).orderBy("step").collect()
    assert [s.step for s in steps] == [0, 1, 2, 3, 4] and steps[0].dropped is None
    assert steps[-1].left == "x1,x3,x5" and set(s.dropped for s in steps[1:]) == {"x0", "x2", "x4", "x6"}


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_shuffled_rank_is_a_bijection(spark, n):
    df = spark.range(n).select("id", *[G.shuffled_rank(F.col("id"), F.lit(n).cast("bigint"), F.lit(s)).alias(f"p{s}") for s in (1, 2)]).collect()
    for c in ("p1", "p2"):
        assert sorted(r[c] for r in df) == list(range(n))
    if n == 1000:
        assert sum(r.p1 == r.id for r in df) < 20 and sum(r.p1 == r.p2 for r in df) < 20
        assert abs(np.corrcoef([r.id for r in df], [r.p1 for r in df])[0, 1]) < 0.15


def test_permutation_importance_ranks_columns(spark):
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=np.arange(400), y=5 * x[:, 0] + x[:, 1]))
    asm = VectorAssembler(inputCols=list("abc"), outputCol="features")
    m = G.LinearRegression(labelCol="y").fit(asm.transform(df))
    metric = -F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)))
    got = {r.feature: r for r in G.permutation_importance(m, df, list("abc"), "id", metric, asm.transform, repeats=6).collect()}
    # Shuffling a column of unit variance with weight w moves the error to about w * sqrt(2).
    assert abs(got["a"].importance_mean - 5 * 2 ** 0.5) < 0.7 and abs(got["b"].importance_mean - 2 ** 0.5) < 0.25 and abs(got["c"].importance_mean) < 1e-6
    assert got["a"].importance_std > 0


def test_permutation_importance_keeps_one_copy_of_the_rows(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import classic
    rng = np.random.default_rng(7)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(60), "a": rng.normal(size=60)})).withColumn("y", F.col("a") * 2)
    asm = VectorAssembler(inputCols=["a"], outputCol="features")
    m = G.LinearRegression(labelCol="y").fit(asm.transform(df))
    written, plain = [], classic.dataframe.DataFrame.checkpoint

    def counted(self, *args, **kw):
        out = plain(self, *args, **kw)
        written.append(out.count())
        return out

    monkeypatch.setattr(classic.dataframe.DataFrame, "checkpoint", counted)
    G.permutation_importance(m, df, ["a"], "id", -F.avg(F.abs(F.col("prediction") - F.col("y"))), asm.transform, repeats=5)
    assert sum(written) == 60


@pytest.mark.parametrize("n, seed", [(1, 3), (2, 3), (7, 42), (20_000, 44), (20_000, 2**31 - 1)])
def test_unshuffled_rank_undoes_shuffled_rank(spark, n, seed):
    df = spark.range(n).select("id", G.shuffled_rank(F.col("id"), F.lit(n).cast("bigint"), F.lit(seed)).alias("p")).toPandas()
    assert (G.unshuffled_rank(df["p"].to_numpy(), n, seed) == df["id"].to_numpy()).all()


@pytest.mark.parametrize("shift", [0, 1])
def test_shuffled_values_are_those_of_the_shuffled_rank(spark, shift):
    """Nulls, strings, columns of several types, ranks in an order of their own: the same as a join on the shuffled rank."""
    n, seeds = 3000, [5, 6]
    rows = [(float(i) if i % 7 else None, f"s{i}" if i % 5 else None, i % 3 == 0, i, float(-i), i * 701 % n if shift else i) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, s string, o boolean, i bigint, `b c` double, _rank bigint").repartition(3 + shift)
    got = {r["_rank"]: r for r in G._with_shuffled(df.withColumn("_r", F.col("_rank")), ["a", "s", "i"], n, seeds).withColumnRenamed("_r", "_rank").collect()}
    place = {r["_rank"]: r for r in df.select("*", *[G.shuffled_rank(F.col("_rank"), F.lit(n).cast("bigint"), F.lit(x)).alias(f"p{x}") for x in seeds]).collect()}
    assert len(got) == n
    for k, r in got.items():
        own = place[k]
        assert [r[c] for c in ("a", "s", "o", "i", "b c")] == [own[c] for c in ("a", "s", "o", "i", "b c")]
        for p, x in enumerate(seeds, 1):
            assert [r[f"_v{p}_{c}"] for c in ("a", "s", "i")] == [place[own[f"p{x}"]][c] for c in ("a", "s", "i")]


def test_permutation_importance_shuffles_no_row_twice_for_two_repeats(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(i, float(i % 9), float(i % 4), float(i % 9) * 2) for i in range(90)], "id int, a double, b double, y double")
    asm = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    m = G.LinearRegression(labelCol="y").fit(asm.transform(df))
    passes, plain = [], G._with_shuffled
    monkeypatch.setattr(G, "_with_shuffled", lambda ranked, features, n, seeds: passes.append((sorted(ranked.columns), list(seeds))) or plain(ranked, features, n, seeds))
    for metric, kept in ((-F.avg(F.abs(F.col("prediction") - F.col("y"))), []), (-F.avg(F.abs(F.col("prediction") - F.col("y")) + 0 * F.col("id")), ["id"])):
        passes.clear()
        got = G.permutation_importance(m, df, ["a", "b"], "id", metric, asm.transform, repeats=5).collect()
        assert passes == [(sorted(["_rank", "a", "b", "y", *kept]), s) for s in ([42, 43], [44, 45], [46])]   # the key only where it is named
        assert {r.feature: round(r.importance_mean, 6) > 1 for r in got} == {"a": True, "b": False}


def test_dealt_bounds_the_rows_of_a_partition(spark):
    whole = spark.range(1000).coalesce(1)
    got = G.dealt(whole, rows=100)
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 150
    assert G.dealt(whole, rows=1000) is whole
