"""Session helpers: checkpoint folder, durable writes, spreading small inputs."""

import os

from pyspark.sql import functions as F

from labelqa.operators import leaves, scoring
from labelqa.session import durable, ensure_checkpoint_dir, spread


def test_checkpoint_dir_is_stable(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first and os.path.isdir(first)
    assert spark.sparkContext.getCheckpointDir() is not None


def test_durable_writes_under_checkpoint_dir(spark):
    df = spark.range(10).withColumn("x", F.rand(seed=1))
    d = durable(df, "unit")
    base = ensure_checkpoint_dir(spark)
    assert any(os.path.basename(p).startswith("unit-") for p in os.listdir(base))
    assert sorted(r.x for r in d.collect()) == sorted(r.x for r in d.collect())  # stable re-reads


def test_spread_only_when_needed(spark):
    small = spark.range(100).coalesce(1)
    assert spread(small, 4).rdd.getNumPartitions() == 4
    big = spark.range(100).repartition(8)
    assert spread(big, 4) is big


def test_score_records_without_last_win_policy(spark):
    before = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    try:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
        df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": 2}}', '{"a": 1, "b": {"c": 3}}')],
                                   "case_no int, e string, a string")
        rec = df.select("case_no", leaves.json_leaves("e").alias("e"), leaves.json_leaves("a").alias("a"))
        got = {r.path: r.score for r in scoring.score_records(rec, "e", "a", ["case_no"]).collect()}
        assert got == {"a": 100.0, "b.c": 0.0}
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", before)


def test_spread_by_rows_of_the_row_groups(spark, tmp_dir):
    """Many tasks over one row group: all rows lie in one of them."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from labelqa.sources.tables import table

    n = 4000
    pq.write_table(pa.table({"id": list(range(n)), "t": [f"{k * 7919 % n:030d}" for k in range(n)]}), f"{tmp_dir}/one.parquet")
    pq.write_table(pa.table({"id": list(range(n)), "t": [f"{k * 7919 % n:030d}" for k in range(n)]}), f"{tmp_dir}/even.parquet",
                   row_group_size=n // 40, use_dictionary=False, compression="none")
    pq.write_table(pa.table({"id": pa.array([], pa.int64())}), f"{tmp_dir}/none.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        scan = spark.read.parquet(f"{tmp_dir}/one.parquet")
        held = [len(p) for p in scan.rdd.glom().collect()]
        assert len(held) >= 4 and max(held) == n
        dealt = [len(p) for p in table(spark, tmp_dir, "one").rdd.glom().collect()]
        assert sum(dealt) == n and max(dealt) <= n // 2
        assert "REPARTITION" not in table(spark, tmp_dir, "even")._jdf.queryExecution().logical().toString().upper()
        assert table(spark, tmp_dir, "none").collect() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
