"""Model training, selection and scoring jobs on ``pyspark.ml``.

Every fit is a distributed Spark job; model selection runs fits in
parallel through ``CrossValidator(parallelism=..., foldCol=...)``.
k-NN (G9) has no ``pyspark.ml`` estimator; it is in ``neighbors``.
"""

from __future__ import annotations

import gc
import random
from itertools import chain
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, IsotonicRegression, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from tessera.functions.columns import sigmoid
from tessera.operators.ordered import with_rank

__all__ = ["baseline", "logistic", "multinomial", "one_vs_rest", "one_vs_one", "linear_svc",
           "huber", "decision_tree", "random_forest", "gbt_regressor", "gbt_classifier",
           "kmeans_elbow", "cluster_feature", "grid_search", "random_param_maps", "isotonic_calibrate",
           "comparison_table", "dealt", "importances", "permutation_importance", "shuffled_rank", "unshuffled_rank", "score", "linear_formula"]


def baseline(train: DataFrame, others: Sequence[DataFrame], label: str, kind: str = "mean",
             out: str = "prediction") -> list[DataFrame]:
    """G1 constant predictor from the training label: mean (regression) or
    most frequent class (classification, ties -> smallest class)."""
    if kind == "mean":
        v = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    else:
        v = (train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col(label).asc()).limit(1).select(label).scalar())
    return [d.withColumn(out, v) for d in [train, *others]]


def logistic(features="features", label="label", reg=0.0, elastic=0.0, weight=None, **kw) -> LogisticRegression:
    """G2 logistic regression (L1/L2/elastic net, optional class weights)."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=elastic, **kw)
    return lr.setWeightCol(weight) if weight else lr


def multinomial(features="features", label="label", reg=0.0) -> LogisticRegression:
    """G3 multinomial logistic regression."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, family="multinomial")


def one_vs_rest(base=None, features="features", label="label") -> OneVsRest:
    """G3 one-vs-rest wrapper."""
    return OneVsRest(classifier=base or LogisticRegression(), featuresCol=features, labelCol=label)


def one_vs_one(train: DataFrame, score_df: DataFrame, classes: Sequence, features="features", label="label",
               make=lambda: LinearSVC(maxIter=50), out: str = "prediction") -> DataFrame:
    """G4 one-vs-one voting: one binary fit per class pair on the rows of
    those two classes; each pair's prediction adds a vote column; the class
    with most votes wins (ties -> smallest class index, like sklearn)."""
    votes = {c: F.lit(0) for c in classes}
    scored = score_df
    for i, a in enumerate(classes):
        for j in range(i + 1, len(classes)):
            b = classes[j]
            sub = train.where(F.col(label).isin(a, b)).withColumn("_bin", (F.col(label) == b).cast("double"))
            pc = f"_p_{i}_{j}"
            m = make().setFeaturesCol(features).setLabelCol("_bin").setPredictionCol(pc)
            for p in ("rawPredictionCol", "probabilityCol"):
                if m.hasParam(p):
                    m = m._set(**{p: f"_{p}_{i}_{j}"})
            scored = m.fit(sub).transform(scored)
            votes[a] = votes[a] + (F.col(pc) == 0).cast("int")
            votes[b] = votes[b] + (F.col(pc) == 1).cast("int")
    best = None
    for c in classes:   # first class with the max vote
        is_best = F.lit(True)
        for d in classes:
            if d != c:
                is_best = is_best & ((votes[c] > votes[d]) if classes.index(d) < classes.index(c) else (votes[c] >= votes[d]))
        best = F.when(is_best, F.lit(c)) if best is None else best.when(is_best, F.lit(c))
    keep = [c for c in score_df.columns]
    return scored.select(*keep, best.alias(out))


def linear_svc(features="features", label="label", weight=None, reg=0.0) -> LinearSVC:
    """G5 linear SVM (hinge loss), balanced via a weight column."""
    m = LinearSVC(featuresCol=features, labelCol=label, regParam=reg)
    return m.setWeightCol(weight) if weight else m


def huber(features="features", label="label", epsilon=1.35, reg=0.0) -> LinearRegression:
    """G7 robust linear regression with Huber loss."""
    return LinearRegression(featuresCol=features, labelCol=label, loss="huber", epsilon=epsilon, regParam=reg)


def decision_tree(features="features", label="label", depth=8, min_leaf=1) -> DecisionTreeRegressor:
    """G8 regression tree."""
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=depth, minInstancesPerNode=min_leaf)


def random_forest(features="features", label="label", trees=100, depth=8, weight=None, seed=42) -> RandomForestClassifier:
    """G10 random forest classifier."""
    m = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return m.setWeightCol(weight) if weight else m


def gbt_regressor(features="features", label="label", iters=50, depth=5, lr=0.1, seed=42) -> GBTRegressor:
    """G11 gradient-boosted trees, regression."""
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=iters, maxDepth=depth, stepSize=lr, seed=seed)


def gbt_classifier(features="features", label="label", iters=50, depth=5, lr=0.1, seed=42) -> GBTClassifier:
    """G11 gradient-boosted trees, binary classification."""
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=iters, maxDepth=depth, stepSize=lr, seed=seed)


def kmeans_elbow(df: DataFrame, features: str, ks: Sequence[int], seed: int = 42) -> tuple[DataFrame, dict]:
    """G12 standardise, fit k-means (k-means||) for each k; returns the
    (k, cost) table and the fitted models."""
    scaler = StandardScaler(inputCol=features, outputCol="_scaled", withMean=True, withStd=True).fit(df)
    scaled = scaler.transform(df).cache()
    models, rows = {}, []
    for k in ks:
        m = KMeans(featuresCol="_scaled", k=k, seed=seed, initMode="k-means||").fit(scaled)
        models[k] = (scaler, m)
        rows.append((k, float(m.summary.trainingCost)))
    scaled.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double"), models


def cluster_feature(train: DataFrame, others: Sequence[DataFrame], features: str, k: int, seed: int = 42,
                    out: str = "cluster") -> list[DataFrame]:
    """G13 k-means cluster id as a feature, fitted on train only."""
    pipe = Pipeline(stages=[StandardScaler(inputCol=features, outputCol="_sc", withMean=True, withStd=True),
                            KMeans(featuresCol="_sc", k=k, seed=seed, predictionCol=out)]).fit(train)
    return [pipe.transform(d).drop("_sc") for d in [train, *others]]


def grid_search(estimator, grid, evaluator, df: DataFrame, fold_col: str | None = None, folds: int = 3,
                parallelism: int = 4, seed: int = 42):
    """G14 cross-validated grid search; returns (best model, ranked results)."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    model = cv.fit(df)
    rows = []
    for pm, m, s in zip(grid, model.avgMetrics, model.stdMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in pm.items()), float(m), float(s)))
    res = df.sparkSession.createDataFrame(rows, "params string, mean_score double, std_score double")
    order = F.col("mean_score").desc() if evaluator.isLargerBetter() else F.col("mean_score").asc()
    return model.bestModel, res.orderBy(order, F.col("params"))


def random_param_maps(estimator, space: dict, n_trials: int, seed: int = 42) -> list:
    """G15 seeded random search: sample ``n_trials`` ParamMaps from bounded
    ranges: ('log', lo, hi), ('int', lo, hi), ('float', lo, hi) or a list."""
    rng = random.Random(seed)
    maps = []
    for _ in range(n_trials):
        pm = {}
        for name, spec in space.items():
            p = estimator.getParam(name)
            if isinstance(spec, list):
                pm[p] = rng.choice(spec)
            elif spec[0] == "log":
                pm[p] = float(np.exp(rng.uniform(np.log(spec[1]), np.log(spec[2]))))
            elif spec[0] == "int":
                pm[p] = rng.randint(spec[1], spec[2])
            else:
                pm[p] = rng.uniform(spec[1], spec[2])
        maps.append(pm)
    return maps


def isotonic_calibrate(calib: DataFrame, others: Sequence[DataFrame], score: str, label: str,
                       out: str = "calibrated") -> list[DataFrame]:
    """G16 isotonic calibration fitted on a held-out set (monotone map score -> P(y=1))."""
    iso = IsotonicRegression(featuresCol="_s", labelCol=label, predictionCol=out)
    prep = VectorAssembler(inputCols=[score], outputCol="_s")
    model = iso.fit(prep.transform(calib.withColumn(score, F.col(score).cast("double"))))
    return [model.transform(prep.transform(d.withColumn(score, F.col(score).cast("double")))).drop("_s")
            for d in [calib, *others]]


def comparison_table(rows: dict[str, DataFrame]) -> DataFrame:
    """G17 stack one-row metric frames with a model name column."""
    out = None
    for name, df in rows.items():
        d = df.select(F.lit(name).alias("model"), "*")
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def dealt(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` in partitions of about ``rows`` rows at most, for fits that read their
    rows again and again: a split of a packed file unpacks to many times its size."""
    n = df.count()
    return df.repartition(max(-(-n // rows), df.sparkSession.sparkContext.defaultParallelism)) if n > rows else df


def importances(model, names: Sequence[str], spark) -> DataFrame:
    """G18 tree importances or linear coefficients with feature names."""
    vals = model.featureImportances.toArray() if hasattr(model, "featureImportances") else model.coefficients.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "feature string, importance double")


def shuffled_rank(rank: Column, n: Column, seed: Column, rounds: int = 12) -> Column:
    """A keyed bijection of 0 .. n-1: swap-or-not rounds, in each of which a place and
    its mirror image about a keyed point change over or not, as a hash of the pair says."""
    keys = F.array(*[F.struct(F.lit(r).alias("r"), F.pmod(F.xxhash64(seed, F.lit(r)), n).alias("k")) for r in range(rounds)])

    def step(x: Column, e: Column) -> Column:
        other = F.pmod(e["k"] - x, n)
        return F.when(F.pmod(F.xxhash64(seed, e["r"], F.greatest(x, other)), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(keys, rank.cast("bigint"), step)


#: constants of xxhash64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _hash_int(i: int, seed: int) -> int:
    """Spark's xxhash64 of one int."""
    p1, p2, p3, _, p5 = (int(p) for p in (_P1, _P2, _P3, _P4, _P5))
    low = (1 << 64) - 1
    h = (seed + p5 + 4 ^ (i & 0xFFFFFFFF) * p1) & low
    h = ((h << 23 | h >> 41) * p2 + p3) & low
    h = (h ^ h >> 33) * p2 & low
    h = (h ^ h >> 29) * p3 & low
    return h ^ h >> 32


def unshuffled_rank(place: np.ndarray, n: int, seed: int, rounds: int = 12) -> np.ndarray:
    """The ranks whose ``shuffled_rank`` (with an int seed) is ``place``: each round
    undoes itself, so they are taken from the last to the first."""
    first, low = _hash_int(seed, 42), (1 << 64) - 1
    keys = [_hash_int(r, first) for r in range(rounds)]
    out = np.array(place, np.int64)
    for i in range(0, len(out), 8192):   # so many that the working numbers stay in the cache
        x = out[i:i + 8192]
        other, h, t = np.empty(len(x), np.int64), np.empty(len(x), np.uint64), np.empty(len(x), np.uint64)
        signed, spare = h.view(np.int64), t.view(np.int64)

        def rotated(left: int) -> None:
            np.left_shift(h, np.uint64(left), out=t)
            np.right_shift(h, np.uint64(64 - left), out=h)
            np.bitwise_or(h, t, out=h)

        for key in reversed(keys):
            np.subtract((key - (key >> 63 << 64)) % n, x, out=other)
            np.right_shift(other, 63, out=spare)
            np.bitwise_and(spare, n, out=spare)
            np.add(other, spare, out=other)
            np.maximum(x, other, out=signed)
            np.multiply(h, _P2, out=h)
            rotated(31)
            np.multiply(h, _P1, out=h)
            np.bitwise_xor(h, np.uint64((key + int(_P5) + 8) & low), out=h)
            rotated(27)
            np.multiply(h, _P1, out=h)
            np.add(h, _P4, out=h)
            for down, by in ((33, _P2), (29, _P3)):
                np.right_shift(h, np.uint64(down), out=t)
                np.bitwise_xor(h, t, out=h)
                np.multiply(h, by, out=h)
            np.right_shift(h, np.uint64(32), out=t)
            np.bitwise_xor(h, t, out=h)
            np.bitwise_and(signed, 1, out=signed)   # x and other change over where the hash is odd
            np.negative(signed, out=signed)
            np.bitwise_xor(x, other, out=spare)
            np.bitwise_and(spare, signed, out=spare)
            np.bitwise_xor(x, spare, out=x)
    return out


#: ranks that meet in one group at most, bytes of rows dealt out at a time, repeats in one pass
RANKS, DEALT, TOGETHER = 1 << 18, 1 << 24, 2


def _flat(column: pa.ChunkedArray) -> pa.Array:
    """The elements of an array column, one after another."""
    return pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], column.type.value_type)


def _taken(values: pa.Array, width: int, rows: np.ndarray, columns: Sequence[int]) -> list[pa.Array]:
    """The named columns of some rows of ``values``, which holds rows of ``width`` values."""
    if not values.null_count and (pa.types.is_floating(values.type) or pa.types.is_integer(values.type)):
        found = values.to_numpy().reshape(-1, width)[rows]
        return [pa.array(np.ascontiguousarray(found[:, j])) for j in columns]
    return [values.take(pa.array(rows * width + j)) for j in columns]


def _with_shuffled(ranked: DataFrame, features: Sequence[str], n: int, seeds: Sequence[int]) -> DataFrame:
    """``ranked(..., _rank)`` with ``_v<i>_<feature>``, the features of the row that holds the
    rank shuffled by the i-th seed. Runs of ranks meet in groups: a row goes to the group of its
    rank, its features to those of the rows which get them, as arrays that hold many rows,
    since what a row costs on its way goes by its columns (those of one type are one array)."""
    columns = [f for f in ranked.schema.fields if f.name != "_rank"]
    kinds = list({f.dataType.json(): f.dataType for f in columns}.values())
    members = [[f.name for f in columns if f.dataType == k] for k in kinds]
    moved = [[j for j, c in enumerate(m) if c in features] for m in members]
    along = kinds.index(DoubleType()) if DoubleType() in kinds else None   # the rank goes along with the doubles, which hold it exactly
    widths = [len(m) + (i == along) for i, m in enumerate(members)]
    run = int(min(RANKS, max(-(-n // (2 * ranked.sparkSession.sparkContext.defaultParallelism)), 1024)))
    # part 0: the rows themselves; part i: features shuffled by the i-th seed
    sent = StructType([StructField("_run", LongType()), StructField("_part", IntegerType()), StructField("_at", ArrayType(IntegerType())),
                       *[StructField(f"_{i}_{j}", ArrayType(k)) for i, k in enumerate(kinds) for j in range(len(members[i]))]])

    def pieces(part: int, rank: np.ndarray, values: list[pa.Array]) -> pa.RecordBatch:
        to = rank // run
        order = np.argsort(to.astype(np.uint16) if to.max() < 1 << 16 else to, kind="stable")   # 16 bits are sorted by counting
        to, at = to[order], (rank % run)[order]
        cuts = np.concatenate(([0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]))
        follow = not part and len(cuts) - 2 == np.count_nonzero(np.diff(at) != 1)   # of places that follow each other the first will do
        places = pa.ListArray.from_arrays(pa.array(np.arange(len(cuts)) if follow else cuts, pa.int32()), pa.array(at[cuts[:-1]] if follow else at, pa.int32()))

        def listed(i: int, j: int) -> pa.Array:
            if part and j not in moved[i]:
                return pa.nulls(len(cuts) - 1, pa.list_(values[i].type))
            return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), taken[i][j])

        taken = [dict(zip(js, _taken(values[i], widths[i], order, js))) for i, js in enumerate(moved if part else [range(len(m)) for m in members])]
        return pa.RecordBatch.from_arrays([pa.array(to[cuts[:-1]]), pa.array(np.full(len(cuts) - 1, part, np.int32)), places,
                                           *[listed(i, j) for i, m in enumerate(members) for j in range(len(m))]], names=sent.names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in chain(batches, [None]):
            if b is not None and b.num_rows:
                held.append(b)
                size += b.nbytes
            if held and (b is None or size >= DEALT):
                rows = pa.Table.from_batches(held)
                values = [_flat(rows.column(f"_{i}")) for i in range(len(kinds))]
                rank = (rows.column("_rank").to_numpy() if along is None
                        else values[along].to_numpy(zero_copy_only=False).reshape(-1, widths[along])[:, -1].astype(np.int64))
                yield pieces(0, rank, values)
                for part, seed in enumerate(seeds, 1):
                    yield pieces(part, unshuffled_rank(rank, n, seed), values)
                held, size = [], 0

    def meet(group: pa.Table) -> pa.Table:
        part, out = group.column("_part").to_numpy(), {}
        for p in range(len(seeds) + 1):
            own = group.take(pa.array(np.flatnonzero(part == p)))
            if p:
                at, place = _flat(own.column("_at")).to_numpy(), np.empty(run, np.int64)
                place[at] = np.arange(len(at))
                place = place[rows]
            else:
                sizes = np.concatenate([c.value_lengths().to_numpy() for c in own.column("_0_0").chunks])
                rows = np.concatenate([np.arange(a[0], a[0] + m) if len(a) < m else a for a, m in zip((a.values.to_numpy() for a in own.column("_at")), sizes)])
            for i, m in enumerate(members):
                for j in moved[i] if p else range(len(m)):
                    values = _flat(own.column(f"_{i}_{j}"))
                    out[f"_v{p}_{m[j]}" if p else m[j]] = _taken(values, 1, place, [0])[0] if p else values
        return pa.table({c: out[c] for c in met.names})

    met = StructType([*columns, *[StructField(f"_v{p}_{c}", ranked.schema[c].dataType) for p in range(1, len(seeds) + 1) for c in features]])
    packed = ranked.select(*["_rank"] * (along is None),
                           *[F.array(*[F.col(f"`{c}`") for c in m], *[F.col("_rank").cast("double")] * (i == along)).alias(f"_{i}") for i, m in enumerate(members)])
    return packed.mapInArrow(deal, sent).groupBy("_run").applyInArrow(meet, met)


def permutation_importance(model, df: DataFrame, features: Sequence[str], key: str, metric: Column,
                           assemble: Callable[[DataFrame], DataFrame], repeats: int = 10, seed: int = 42) -> DataFrame:
    """G19 drop in ``metric`` (an aggregate of the prediction, larger is better)
    when one column is permuted. Rows are ranked once, and a row's shuffled
    values are those of the rank a keyed bijection gives it, another one for
    each repeat. A pass over the ranked rows is one shuffle, in which rows and the
    shuffled values of ``TOGETHER`` repeats meet by runs of ranks, and scores all columns;
    nothing of it is written but its shuffle, which goes before the next pass starts."""
    base, n = model.transform(assemble(df)).agg(metric, F.count(F.lit(1))).first()
    unused = []
    if key not in features:
        try:   # a key that neither model nor metric names is not written or shuffled
            model.transform(assemble(df.drop(key))).agg(metric)
            unused = [key]
        except AnalysisException:
            pass
    ranked = with_rank(df, [], [F.col(key)], without=unused, reread=True).drop("_n").withColumn("_rank", F.col("_rank").cast("bigint"))
    rest = [F.col(f"`{c}`") for c in ranked.columns if c not in features and c != "_rank"]

    def turn(some: Sequence[int]) -> list[dict[str, float]]:
        swaps = F.array(*[F.struct(F.lit(r).alias("_repeat"), F.lit(c).alias("_feature"), *[F.col(f"_v{i}_{x}" if x == c else x).alias(x) for x in features])
                          for i, r in enumerate(some, 1) for c in features])
        swapped = _with_shuffled(ranked, features, max(n, 1), [seed + r for r in some]).select(*rest, F.inline(swaps))
        got = model.transform(assemble(swapped)).groupBy("_repeat", "_feature").agg(metric.alias("m")).collect()  # a row a repeat and column
        return [{r["_feature"]: base - r.m for r in got if r["_repeat"] == i} for i in some]

    drops = []
    for r in range(0, repeats, TOGETHER):
        drops += turn(range(r, min(r + TOGETHER, repeats)))
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()   # shuffle files are removed when the driver's JVM collects their frames
    rows = []
    for c in features:
        own = [d[c] for d in drops if c in d]
        rows.append((c, float(np.mean(own)), float(np.std(own))))
    return df.sparkSession.createDataFrame(rows, "feature string, importance_mean double, importance_std double")


def linear_formula(df: DataFrame, coefs: dict, intercept: float, means: dict | None = None,
                   stds: dict | None = None, out: str = "formula_prediction") -> DataFrame:
    """F6 prediction from explicit coefficients: intercept + sum coef * x
    (x standardised with the given means / stds when provided) as one
    column expression."""
    expr = F.lit(float(intercept))
    for c, w in coefs.items():
        x = F.col(c).cast("double")
        if means is not None and stds is not None:
            x = (x - F.lit(float(means[c]))) / F.lit(float(stds[c]))
        expr = expr + F.lit(float(w)) * x
    return df.withColumn(out, expr)


def score(df: DataFrame, model, raw_col: str = "rawPrediction", out: str = "score") -> DataFrame:
    """G20 score with a fitted pipeline; probability of class 1 as the
    sigmoid of the raw margin (for margin-only models such as LinearSVC)."""
    t = model.transform(df)
    return t.withColumn(out, sigmoid(vector_to_array(F.col(raw_col))[1]))
