"""Sources, sinks and hand-off checks."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import checkpoint_dir

__all__ = [
    "TABLES", "read_table", "read_csv", "read_tsv_decimal_comma", "read_query",
    "register_mart", "scratch_table", "write_partitioned", "write_predictions", "check_batch",
    "check_written", "publish", "save_model", "load_model", "same_predictions",
]

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One parquet table of a data directory; columns are pruned and filters
    pushed to the scan by Catalyst when the caller selects/filters."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
             header: bool = True, null_value: str | None = None) -> DataFrame:
    """Delimited text with an explicit schema (never inferSchema in jobs)."""
    reader = spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_tsv_decimal_comma(spark: SparkSession, path: str, schema: StructType,
                           numeric_cols: Sequence[str]) -> DataFrame:
    """Tab-separated text whose numbers use a decimal comma. The numeric
    columns are read as text, the comma swapped for a dot, then try_cast."""
    from pyspark.sql.types import StringType, StructField
    text_schema = StructType([StructField(f.name, StringType(), True) if f.name in numeric_cols else f
                              for f in schema.fields])
    raw = spark.read.schema(text_schema).option("header", True).option("sep", "\t").csv(path)
    target = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[
        F.expr(f"try_cast(regexp_replace(trim(`{c}`), ',', '.') AS {target[c].simpleString()})").alias(c)
        if c in numeric_cols else F.col(f"`{c}`") for c in raw.columns])


def read_query(spark: SparkSession, sql: str, jdbc_url: str | None = None,
               properties: dict | None = None) -> DataFrame:
    """S3: a query against a database (JDBC, the query is pushed to the
    server) or against registered views (``spark.sql``)."""
    if jdbc_url:
        return (spark.read.format("jdbc").option("url", jdbc_url).option("query", sql)
                .options(**(properties or {})).load())
    return spark.sql(sql)


def register_mart(df: DataFrame, name: str, table: bool = False) -> DataFrame:
    """Publish a mart under a name (temp view, or a managed table)."""
    if table:
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Drop-and-recreate a scratch table inside one job: the view is
    replaced and the data written to the checkpoint folder for reuse, from
    where it goes with the last frame that reads it."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        spark.catalog.dropTempView(name)
    checkpoint_dir(spark)
    out = df.checkpoint()
    out.createOrReplaceTempView(name)
    return out


def write_partitioned(df: DataFrame, path: str, run_date: str, fmt: str = "parquet") -> None:
    """Write one run's rows into ``run_date=<d>/`` replacing only that
    partition (dynamic partition overwrite)."""
    (df.withColumn("run_date", F.lit(run_date).cast("date"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_date").format(fmt).save(path))


def check_batch(df: DataFrame, key: Sequence[str] | str) -> dict:
    """Checks in one job: row count, rows with a null in the key, duplicated keys."""
    key = [key] if isinstance(key, str) else list(key)
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    row = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("nulls"),
                  F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("dups"))
             .first())
    result = {"rows": int(row["rows"]), "null_keys": int(row["nulls"]), "duplicate_keys": int(row["dups"])}
    if result["rows"] == 0:
        raise ValueError("batch is empty")
    if result["null_keys"] > 0:
        raise ValueError(f"{result['null_keys']} rows without key {key}")
    if result["duplicate_keys"] > 0:
        raise ValueError(f"{result['duplicate_keys']} duplicated keys on {key}")
    return result


def publish(df: DataFrame, path: str, key: Sequence[str] | str, partition: str | None = None, fmt: str = "parquet") -> dict:
    """S6-S8 write, check, publish. ``df`` is computed once, into a staging
    folder under ``path``; rows, null keys and duplicated keys are counted
    there, from the key columns alone. Only if the rows pass does the staged folder take the place of ``path``'s
    ``partition`` (``run_date=...``) or, without one, of the whole table. A
    failing check raises and leaves what was published as it was."""
    key = [key] if isinstance(key, str) else list(key)
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.format(fmt).save(staged)
        result = check_batch(spark.read.format(fmt).load(staged).select(*key), key)
        target = f"{path.rstrip('/')}/{partition}" if partition else path.rstrip("/")
        old = [folder(target)] if partition else [f.getPath() for f in fs.listStatus(folder(path)) if not f.getPath().getName().startswith("_staging-")]
        for p in old:
            fs.delete(p, True)
        if partition:
            fs.rename(folder(staged), folder(target))
        else:
            for f in fs.listStatus(folder(staged)):
                fs.rename(f.getPath(), folder(f"{target}/{f.getPath().getName()}"))
        spark.catalog.refreshByPath(path)
        return result
    finally:
        fs.delete(folder(staged), True)


def write_predictions(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet") -> dict:
    """Replace a prediction table, stamped with the write time, if its keys are unique."""
    return publish(df.withColumn("prediction_timestamp", F.current_timestamp()), path, keys, fmt=fmt)


def check_written(spark: SparkSession, path: str, run_date: str | None = None, fmt: str = "parquet") -> int:
    """Read the stored result back (partition-pruned when a run date is
    given) and fail when it is missing or empty."""
    df = spark.read.format(fmt).load(path)
    if run_date is not None:
        df = df.where(F.col("run_date") == F.lit(run_date).cast("date"))
    if df.isEmpty():
        raise ValueError(f"stored result at {path} is empty")
    return df.count()


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline (overwriting)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def same_predictions(a: DataFrame, b: DataFrame, key: Sequence[str], col: str = "prediction",
                     tol: float = 1e-9) -> bool:
    """S10 check: two scorings agree row by row (anti-join of mismatches is empty)."""
    key = list(key)
    left = a.select(*key, F.col(col).alias("_a"))
    right = b.select(*key, F.col(col).alias("_b"))
    bad = left.join(right, key, "full_outer").where(
        F.col("_a").isNull() | F.col("_b").isNull() | (F.abs(F.col("_a") - F.col("_b")) > tol))
    return bad.isEmpty()
