"""Streaming re-aims, sources/sinks and job checks on temporary folders."""

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.plans import domains as D
from tessera.plans.jobs import batch_features_job
from tessera.sources import io
from tessera.streaming import jobs as S

BASE = "/root/testdata/sf0.001"


def _as_files(spark, n):
    """The events in ``n`` files, and the frame itself."""
    ev = spark.read.parquet(f"{BASE}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    ev.repartition(n).write.mode("overwrite").parquet(src)
    return ev, src


@pytest.mark.parametrize("files,per_batch", [(1, 100), (15, 100), (45, 10)])
def test_daily_users_stream_matches_batch(spark, files, per_batch):
    ev, src = _as_files(spark, files)
    got = {tuple(r) for r in S.run_daily_users(spark, src, per_batch).collect()}
    exp = {tuple(r) for r in ev.groupBy(F.col("ts").cast("date").alias("session_date"))
           .agg(F.count_distinct("user_id"), F.count_distinct(F.when(F.col("event_type") == "signup", F.col("user_id")))).collect()}
    assert got == exp


def test_run_date_stream_recomputes_dates_of_several_batches(spark):
    ev, src = _as_files(spark, 6)
    out, ck = tempfile.mkdtemp(prefix="tessera-out-"), tempfile.mkdtemp(prefix="tessera-ck-")

    def feats(rows):
        return rows.groupBy("run_date", "user_id").agg(F.count(F.lit(1)).alias("n"))
    day = F.col("ts").cast("date")
    q = S.run_date_feature_stream(S.event_stream(spark, src, ev.schema, 2), lambda: spark.read.parquet(src), out, ck, feats, day)
    q.awaitTermination(120)
    got = {(str(r["run_date"]), r["user_id"], r["n"]) for r in spark.read.parquet(out).collect()}
    assert got == {(str(r["run_date"]), r["user_id"], r["n"]) for r in feats(ev.withColumn("run_date", day)).collect()}


def test_csv_and_decimal_comma_readers(spark):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    p1, p2 = os.path.join(d, "a.csv"), os.path.join(d, "b.tsv")
    pd.DataFrame({"id": ["1", "2"], "v": ["1.5", "x"]}).to_csv(p1, index=False)
    with open(p2, "w") as f:
        f.write("id\tw\n1\t12,5\n2\tbad\n")
    schema = StructType([StructField("id", StringType()), StructField("v", StringType())])
    assert io.read_csv(spark, p1, schema).count() == 2
    s2 = StructType([StructField("id", StringType()), StructField("w", DoubleType())])
    vals = [r["w"] for r in io.read_tsv_decimal_comma(spark, p2, s2, ["w"]).orderBy("id").collect()]
    assert vals == [12.5, None]


def test_batch_job_write_and_check(spark):
    out = tempfile.mkdtemp(prefix="tessera-bf-")
    stored = batch_features_job(D.Tables(spark, BASE), out_path=os.path.join(out, "bf"))
    assert stored.count() == spark.read.parquet(f"{BASE}/customer.parquet").count()
    try:
        io.check_batch(stored.unionByName(stored), ["customer_id"])
        raise AssertionError("duplicate keys not detected")
    except ValueError:
        pass


def test_model_save_load_same_predictions(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.read.parquet(f"{BASE}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                                                 "l_extendedprice")
    df = df.withColumn("rk", F.xxhash64("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features"),
                            LinearRegression(labelCol="l_extendedprice", maxIter=5)]).fit(df)
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-model-"), "m")
    io.save_model(pipe, path)
    again = io.load_model(path)
    a = pipe.transform(df).select("rk", "prediction").dropDuplicates(["rk"])
    b = again.transform(df).select("rk", "prediction").dropDuplicates(["rk"])
    assert io.same_predictions(a, b, ["rk"])


def test_publish_computes_once_and_only_replaces_what_passes(spark):
    from pyspark.accumulators import AccumulatorParam  # noqa: F401 - the counter below is one
    made = spark.sparkContext.accumulator(0)
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-pub-"), "t")

    def rows(ids):
        def run(batches):
            for b in batches:
                made.add(len(b))
                yield b
        return spark.createDataFrame([(i, "a") for i in ids], "id long, v string").mapInPandas(run, "id long, v string")

    assert io.publish(rows([1, 2, 3]), path, "id", partition="run_date=2024-01-01") == {"rows": 3, "null_keys": 0, "duplicate_keys": 0}
    assert made.value == 3
    io.publish(rows([7]), path, "id", partition="run_date=2024-01-02")
    stored = lambda: sorted((r.id, str(r.run_date)) for r in spark.read.parquet(path).collect())
    first = [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-01"), (7, "2024-01-02")]
    assert stored() == first
    for bad in ([4, 4], [5, None], []):
        try:
            io.publish(rows(bad), path, "id", partition="run_date=2024-01-01")
            raise AssertionError(bad)
        except ValueError:
            pass
        assert stored() == first and not [x for x in os.listdir(path) if x.startswith("_staging")]
    io.publish(rows([9]), path, "id", partition="run_date=2024-01-01")
    assert stored() == [(7, "2024-01-02"), (9, "2024-01-01")]
    whole = path + "-whole"
    for ids in ([1, 2], [3]):
        io.publish(rows(ids), whole, "id")
        assert sorted(r.id for r in spark.read.parquet(whole).collect()) == ids
