"""Feature preparation on ``pyspark.ml``.

Statistics are always fitted on the training frame only and applied to
every split. Scaling uses explicit population/sample statistics (D5);
one-hot reproduces 'drop first, ignore unknown'; the TF-IDF variant uses
idf = ln((1+n)/(1+df)) + 1 with L2 normalisation (D15).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VarianceThresholdSelector, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import join_stats

__all__ = ["onehot_drop_first", "target_encode", "standardize", "minmax", "variance_filter", "text_tokens",
           "tfidf_vocabulary", "tfidf", "tfidf_top_terms", "route_text", "impute", "column_routing", "drop_columns"]


def onehot_drop_first(train: DataFrame, cols: Sequence[str], out_suffix: str = "_ohe") -> list:
    """M12 stages: index categories alphabetically (unknown -> extra last
    index), one-hot everything, then slice away the first category and the
    unknown slot - sklearn ``drop='first', handle_unknown='ignore'``."""
    stages = []
    for c in cols:
        n = train.select(c).where(F.col(c).isNotNull()).distinct().count()   # category count: plan metadata
        if n <= 1:          # a single category carries no information once the first is dropped
            continue
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
                   OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_oh_all", dropLast=False, handleInvalid="keep"),
                   VectorSlicer(inputCol=f"{c}_oh_all", outputCol=f"{c}{out_suffix}", indices=list(range(1, n)))]
    return stages


def target_encode(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str], label: str,
                  smoothing: float = 1.0) -> list[DataFrame]:
    """M13 smoothed mean-target encoding fitted on train:
    enc = (sum_y + m * prior) / (n + m); unseen categories get the prior."""
    prior = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    out = [train, *others]
    for c in cols:
        stats = train.groupBy(c).agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n"))
        enc = stats.select(c, ((F.col("_s") + smoothing * prior) / (F.col("_n") + smoothing)).alias(f"{c}_te"))
        out = [join_stats(d, enc, [c]).withColumn(f"{c}_te", F.coalesce(F.col(f"{c}_te"), prior)) for d in out]
    return out


def standardize(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str], population: bool = True) -> list[DataFrame]:
    """M14 (x - mean) / std with train statistics (population std like
    sklearn's StandardScaler by default, sample std when population=False)."""
    sd = F.stddev_pop if population else F.stddev_samp
    stats = {c: (train.agg(F.avg(c)).scalar(), train.agg(sd(c)).scalar()) for c in cols}
    res = []
    for d in [train, *others]:
        for c, (m, s) in stats.items():
            d = d.withColumn(c, F.try_divide(F.col(c).cast("double") - m, s))
        res.append(d)
    return res


def minmax(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str]) -> list[DataFrame]:
    """M14 (x - min) / (max - min) with train statistics."""
    stats = {c: (train.agg(F.min(c)).scalar(), train.agg(F.max(c)).scalar()) for c in cols}
    res = []
    for d in [train, *others]:
        for c, (lo, hi) in stats.items():
            d = d.withColumn(c, F.try_divide(F.col(c).cast("double") - lo, hi - lo))
        res.append(d)
    return res


def variance_filter(features_col: str = "features", threshold: float = 0.0, out: str = "selected"):
    """M15 drop features whose (sample) variance is <= threshold."""
    return VarianceThresholdSelector(featuresCol=features_col, outputCol=out, varianceThreshold=threshold)


# English stop words removed from review text before TF-IDF.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no",
              "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to",
              "was", "will", "with"]


def text_tokens(df: DataFrame, text: str, out: str = "tokens", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """M17 lower-case, put a space for everything that is not a Unicode letter, digit,
    underscore or space (Python's \\w semantics, D17), split on spaces,
    remove stop words and tokens of one character."""
    clean = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}_\s]", " ")
    toks = F.filter(F.split(clean, r"\s+"), lambda t: F.length(t) >= 2)
    stop = set(stop_words)
    return df.withColumn(out, F.filter(toks, lambda t: ~t.isin(*stop)))


def tfidf_vocabulary(train: DataFrame, tokens: str, vocab: int = 5) -> DataFrame:
    """M17 (place, term, idf) of the ``vocab`` terms that occur most often in
    ``train``, of equally frequent ones the first by name; places in order of the
    terms, idf = ln((1 + n) / (1 + df)) + 1. One pass: a row gives each token as
    an occurrence and each distinct one as a document, added up before the shuffle."""
    one = lambda tf: lambda t: F.struct(t.alias("term"), F.lit(tf).alias("tf"), F.lit(1 - tf).alias("df"))
    seen = train.select(F.inline(F.concat(F.transform(tokens, one(1)), F.transform(F.array_distinct(tokens), one(0)))))
    terms = seen.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")).orderBy(F.col("tf").desc(), F.col("term")).limit(vocab)
    n = train.agg(F.count(F.lit(1))).scalar()
    terms = terms.select("term", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    return terms.withColumn("place", F.row_number().over(Window.orderBy("term")) - 1)      # over ``vocab`` rows


def tfidf(df: DataFrame, tokens: str, vocabulary: DataFrame, out: str = "tfidf") -> DataFrame:
    """Adds an array with the L2-normalised tf * idf of each term of a
    ``tfidf_vocabulary``; rows without any of them have zeros. The vocabulary
    is one scalar subquery: no row of ``df`` is shuffled and nothing collected."""
    terms = vocabulary.agg(F.sort_array(F.collect_list(F.struct("place", "term", "idf")))).scalar()
    x = df.withColumn("_terms", terms)
    x = x.withColumn("_w", F.transform("_terms", lambda t: F.size(F.filter(F.coalesce(F.col(tokens), F.array()), lambda w: w == t["term"])) * t["idf"]))
    norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda a, w: a + w * w))
    x = x.withColumn("_norm", norm)
    return x.withColumn(out, F.transform("_w", lambda w: F.when(F.col("_norm") > 0, w / F.col("_norm")).otherwise(0.0))).drop("_terms", "_w", "_norm")


def tfidf_top_terms(train: DataFrame, others: Sequence[DataFrame], tokens: str, vocab: int = 5,
                    out: str = "tfidf") -> list[DataFrame]:
    """M17 TF-IDF vectors on the ``vocab`` most frequent terms of ``train``,
    for ``train`` and the other frames."""
    terms = tfidf_vocabulary(train, tokens, vocab)
    return [tfidf(d, tokens, terms, out).withColumn(out, array_to_vector(out)) for d in [train, *others]]


def impute(cols: Sequence[str], strategy: str = "median", suffix: str = "") -> Imputer:
    """M18 imputer stage (median/mean/mode) fitted inside the pipeline."""
    return Imputer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols], strategy=strategy,
                   relativeError=0.0)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F3 drop listed columns before assembling."""
    return df.drop(*cols)


def route_text(train: DataFrame, others: Sequence[DataFrame], text: Sequence[str], vocab: int = 5) -> list[DataFrame]:
    """The text branch of ``column_routing``: ``<c>_tfidf`` for each text column,
    vocabulary and weights fitted on ``train``."""
    frames = [train, *others]
    for c in text:
        frames = [text_tokens(d, c, "_tokens") for d in frames]
        frames = [d.drop("_tokens") for d in tfidf_top_terms(frames[0], frames[1:], "_tokens", vocab, f"{c}_tfidf")]
    return frames


def column_routing(train: DataFrame, numeric: Sequence[str] = (), onehot: Sequence[str] = (),
                     passthrough: Sequence[str] = (), impute_numeric: bool = True, out: str = "features",
                     text: Sequence[str] = (), target: Sequence[str] = ()) -> Pipeline:
    """M19 column routing: numeric (median-imputed), one-hot (drop first),
    passthrough, text (the vectors of ``route_text``) and target-encoded
    columns (``<c>_te`` of ``target_encode``) assembled into one vector."""
    stages = []
    num = list(numeric)
    if impute_numeric and num:
        stages.append(impute(num, "median", "_imp"))
        num = [f"{c}_imp" for c in num]
    stages += onehot_drop_first(train, onehot)
    encoded = {st.getOutputCol().removesuffix("_ohe") for st in stages if isinstance(st, VectorSlicer)}
    inputs = num + [f"{c}_ohe" for c in onehot if c in encoded] + list(passthrough) \
        + [f"{c}_tfidf" for c in text] + [f"{c}_te" for c in target]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)
