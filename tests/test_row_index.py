import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.row_index import has_stable_partitions, with_row_index
from tidemark.sources.tables import batch_of


def test_physical_order_numbers_are_1_to_n_in_partition_order(spark):
    df = spark.range(0, 1000, 1, numPartitions=7).withColumnRenamed("id", "x")
    out = with_row_index(df).collect()
    assert [r["RowIndex"] for r in out] == list(range(1, 1001))
    # physical order of a range is x ascending
    assert all(r["RowIndex"] == r["x"] + 1 for r in out)


def test_ordered_numbers_match_row_number(spark):
    df = spark.range(0, 5000, 1, numPartitions=5).select(
        ((F.col("id") * 7919) % 5003).alias("k"), F.col("id"))
    got = with_row_index(df, order_by=["k", "id"])
    want = df.select("id", F.row_number().over(Window.orderBy("k", "id")).alias("rn"))
    bad = got.join(want, "id").where(F.col("RowIndex") != F.col("rn")).count()
    assert bad == 0 and got.count() == 5000


def test_batch_numbering_after_filter(spark):
    df = spark.range(0, 100, 1, numPartitions=4).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("batch_id"))
    out = batch_of(df, "1", order_by=["id"]).orderBy("id").collect()
    assert [r["RowIndex"] for r in out] == list(range(1, 34))


def test_empty_input(spark):
    df = spark.range(0).withColumnRenamed("id", "x")
    assert with_row_index(df).count() == 0


def test_shuffled_input_numbered_from_a_checkpoint(spark):
    df = spark.range(0, 3000, 1, 4).repartition(7, "id").withColumnRenamed("id", "x")
    out = with_row_index(df, materialize=True)
    rows = out.collect()
    assert sorted(r["RowIndex"] for r in rows) == list(range(1, 3001))
    assert sorted(r["x"] for r in rows) == list(range(3000))


def _is_numbered(df, n):
    row = with_row_index(df).agg(F.count("*"), F.countDistinct("RowIndex"), F.min("RowIndex"), F.max("RowIndex")).first()
    assert tuple(row) == (n, n, 1, n)


def test_default_numbering_of_shuffled_frames_is_complete(spark):
    """Adaptive execution coalesces the two reads of a shuffle differently."""
    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
    keys = lines.select("l_orderkey", "l_partkey", "l_suppkey").dropDuplicates()
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        _is_numbered(keys, keys.count())
        few = keys.limit(1000)
        _is_numbered(few, 1000)
        keys.join(keys.groupBy("l_partkey").count(), "l_partkey").createOrReplaceTempView("tm_joined")
        view = spark.read.table("tm_joined")
        _is_numbered(view, view.count())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_plans_that_need_no_copy(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert has_stable_partitions(scan.where("id > 3").withColumn("x", F.col("id") * 2))
    assert not has_stable_partitions(scan.groupBy("id").count())
    assert not has_stable_partitions(scan.where(F.rand() > 0.5))
    assert not has_stable_partitions(scan.limit(3))


def test_numbers_follow_file_positions_whatever_the_splits(spark, tmp_path):
    """Several files of several row groups, with and without a filter."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 30000, 1, 3).select(F.col("id").alias("x"), (F.col("id") % 3).alias("batch_id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    rows.write.option("parquet.block.size", str(64 << 10)).option("parquet.page.size", "8192").parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for size in ("100k", "300k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            scan = spark.read.parquet(path)
            whole = with_row_index(scan.select("x"))
            batch = with_row_index(scan.where("batch_id = 1").select("x", "pad"))
            assert "Exchange" not in re.sub(r"BroadcastExchange.*", "", _rows_side(whole))
            _is_numbered(whole, 30000)
            _is_numbered(batch, 10000)
            seen.append((scan.rdd.getNumPartitions(), sorted(map(tuple, whole.collect())), sorted(map(tuple, batch.select("x", "RowIndex").collect()))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({n for n, _, _ in seen}) > 1
    assert all(x[1:] == seen[0][1:] for x in seen)


def _rows_side(df):
    """The plan above the broadcast of the offsets: what the rows go through."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan[:plan.index("BroadcastExchange")] if "BroadcastExchange" in plan else plan.splitlines()[0]


def test_a_column_named_like_the_metadata(spark, tmp_path):
    spark.range(50).select("id", F.lit("m").alias("_metadata"), F.lit(1).alias("a.b")).write.parquet(str(tmp_path / "m"))
    _is_numbered(with_row_index(spark.read.parquet(str(tmp_path / "m"))), 50)
