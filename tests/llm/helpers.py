"""Small frames for the operators' tests."""

from pyspark.sql import DataFrame, SparkSession


def docs_of(spark: SparkSession, rows, **extra) -> DataFrame:
    """(doc_id, text) rows with further columns whose names clash with what operators add."""
    more = {"n_tokens": "x", "row": 1, "key": None, "h": 2, **extra}
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    from pyspark.sql import functions as F
    for k, v in more.items():
        df = df.withColumn(k, F.lit(v))
    return df
