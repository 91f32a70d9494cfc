"""Row identity from storage (S1), the batch manifest (S4, S5) and the sparse one-hot form."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab import schema as S
from churnlab.operators import clean as C
from churnlab.sources import io as IO

CSV_SCHEMA = T.StructType([T.StructField("state", T.StringType()), T.StructField("account_length", T.IntegerType()),
                           T.StructField("churn", T.BooleanType())])


def ids(df):
    return sorted((r["state"] or "", r["account_length"] or -1, r[S.ID]) for r in df.collect())


def with_splits(spark, size, read):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", size)
    try:
        df = read()
        return df.rdd.getNumPartitions(), ids(df)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_csv_ids_do_not_depend_on_splits(spark):
    base = tempfile.mkdtemp(prefix="churnlab-id-")
    lines = "".join(f"{'K' * (i % 3)},{i % 50},{i % 2 == 0}\n" for i in range(3000)) + ",7,\n,,True\n7,,\n" + "KS,1,True\n" * 500
    for name in ("a", "b"):                                   # the same content twice
        with open(f"{base}/{name}.csv", "w") as out:
            out.write("State,Account length,Churn\n" + lines)
    read = lambda: IO.read_customers(spark, base, schema=CSV_SCHEMA)
    _, whole = with_splits(spark, "128m", read)
    _, small = with_splits(spark, "2k", read)
    assert whole == small and len(whole) == 2 * 3503 and len({i for *_, i in whole}) == len(whole)


def test_parquet_ids_do_not_depend_on_splits(spark):
    base = tempfile.mkdtemp(prefix="churnlab-id-") + "/t"
    rows = spark.range(4000).select(F.lit("KS").alias("State"), (F.col("id") % 3).cast("int").alias("Account length"))
    rows.coalesce(1).write.option("parquet.block.size", 4096).parquet(base)
    rows.coalesce(1).write.mode("append").parquet(base)
    read = lambda: IO.read_customers(spark, base, fmt="parquet")
    one, whole = with_splits(spark, "128m", read)
    many, small = with_splits(spark, "512", read)
    assert one < many and whole == small and len({i for *_, i in whole}) == 8000


def test_id_column_is_kept(spark):
    base = tempfile.mkdtemp(prefix="churnlab-id-") + "/t"
    spark.createDataFrame([(5, "KS")], f"{S.ID} long, State string").write.parquet(base)
    assert [tuple(r) for r in IO.read_customers(spark, base, fmt="parquet").collect()] == [(5, "KS")]


def test_manifest_decides_what_is_read(spark):
    base = tempfile.mkdtemp(prefix="churnlab-land-") + "/batches"
    assert IO.read_batches(spark, base, ["x", "churn"]).count() == 0        # nothing has landed
    row = spark.createDataFrame([(1.5, 1, "n")], "x double, churn int, note string")
    IO.write_batch(row, base, "b1")
    IO.write_batch(row.drop("x"), base, "b2")                               # lacks a required column
    IO.write_batch(row.select(F.lit(7).alias("x"), "churn"), base, "b3")    # an integer column there
    IO.write_batch(row.withColumn("x", F.lit(None).cast("double")), base, "b4")
    IO.write_batch(row.limit(0), base, "b5")
    row.write.parquet(f"{base}/batch_ts=b6")                                # broke off: no manifest row
    got = IO.read_batches(spark, base, ["x", "churn"])
    assert sorted((r["batch_ts"], r["x"]) for r in got.collect()) == [("b1", 1.5), ("b3", 7.0), ("b4", None)]
    assert got.columns == ["x", "churn", "batch_ts"]
    assert [r[0] for r in IO.read_batches(spark, base, ["x"], ["b3", "b6"]).collect()] == [7]
    IO.write_batch(row.unionByName(row), base, "b1")                        # landed again: replaced
    assert IO.read_batches(spark, base, ["x"], ["b1"]).count() == 2
    about = {r["batch_ts"]: (r["rows"], r["columns"].get("x")) for r in IO.read_manifest(spark, base).collect()}
    assert about == {"b1": (2, "double"), "b2": (1, None), "b3": (1, "int"), "b4": (1, "double"), "b5": (0, "double")}


def test_scan_is_pruned_to_the_batches(spark):
    base = tempfile.mkdtemp(prefix="churnlab-land-") + "/batches"
    for i in range(3):
        IO.write_batch(spark.createDataFrame([(float(i), 1)], "x double, churn int"), base, f"b{i}")
    # files of other batches may be gone without the read noticing: they are never opened
    for name in os.listdir(f"{base}/batch_ts=b0"):
        if name.endswith(".parquet"):
            shutil.copyfile(__file__, f"{base}/batch_ts=b0/{name}")
    checks = [n for n in os.listdir(f"{base}/batch_ts=b0") if n.endswith(".crc")]
    for name in checks:
        os.remove(f"{base}/batch_ts=b0/{name}")
    assert [r[0] for r in IO.read_batches(spark, base, ["x"], ["b2"]).collect()] == [2.0]


def test_vector_form_equals_column_form(spark):
    rows = [(i, v) for i, v in enumerate(["b", "a", None, "c", "a", "d d", "b"])]
    df = spark.createDataFrame(rows, "customer_id long, state string")
    for drop in (True, False):
        cols = C.one_hot(df, "state", drop_first=drop)
        names = [c for c in cols.columns if c != "customer_id"]
        want = {r["customer_id"]: [float(r[c]) for c in names] for r in cols.collect()}
        wide = C.one_hot_vector(df, "state", drop_first=drop)
        assert wide.columns == ["customer_id", "state_onehot"]
        assert {r[0]: list(r[1].toArray()) for r in wide.collect()} == want
    levels = C.level_table(df)
    unseen = C.one_hot_vector(spark.createDataFrame([(1, "zz"), (2, "d d")], "customer_id long, state string"), "state", levels)
    assert {r[0]: list(r[1].toArray()) for r in unseen.collect()} == {1: [0, 0, 0], 2: [0, 0, 1]}


@pytest.mark.parametrize("values", [[], [None], ["a"], ["a", None]])
def test_vector_form_without_levels(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "customer_id long, state string")
    assert [r[1].numNonzeros() for r in C.one_hot_vector(df, "state").collect()] == [0] * len(values)


def test_vector_form_of_many_levels(spark):
    df = spark.range(120_000).select(F.col("id").alias("customer_id"), F.format_string("%06d", F.col("id") % 100_000).alias("state"))
    wide = C.one_hot_vector(df, "state")
    picked = {r[0]: r[1] for r in wide.where(F.col("customer_id").isin(0, 1, 99_999, 100_007)).collect()}
    assert picked[0].size == 99_999 and picked[0].numNonzeros() == 0
    assert [int(picked[i].indices[0]) for i in (1, 99_999, 100_007)] == [0, 99_998, 6]
