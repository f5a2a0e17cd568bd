"""Inputs are dealt out evenly, and filters run after that."""
from pyspark.sql import functions as F

from checks.queries import _write
from spanveil.sources.tables import spread


def test_rows_of_one_row_group_are_dealt_to_all_tasks(spark, tmp_path):
    path, setting = str(tmp_path / "t"), "spark.sql.files.maxPartitionBytes"
    spark.range(40_000).coalesce(1).write.parquet(path)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "8k")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() > 8  # and yet one task reads all rows
        rows = spread(df).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    finally:
        spark.conf.set(setting, before)
    assert rows.sum() == 40_000 and rows.max() < 2 * 40_000 / len(rows)


def test_filters_run_after_the_rows_are_dealt_out(spark, table):
    df = spread(table("orders")).where(F.concat(F.lit("n"), "o_orderkey").rlike("7$"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("Repartition")
    assert df.count() == table("orders").where("o_orderkey % 10 = 7").count()


def test_a_day_gets_no_more_files_than_there_are_cores(spark, tmp_path):
    rows = spark.range(4000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"))
    _write(rows.repartition(40), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000
    cores = spark.sparkContext.defaultParallelism
    assert all(len(list(day.glob("*.parquet"))) <= cores for day in (tmp_path / "t").glob("date=*"))
