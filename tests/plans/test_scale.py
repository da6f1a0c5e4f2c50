"""Datasets over made inputs are parsed once, and by more than one task."""

from pyspark.sql import functions as F

from docketloom.plans import agencies


def test_datasets_parse_once_and_in_many_tasks(spark, tmp_path):
    spark.range(1, 9).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    assert agencies._suppliers(spark, tmp_path).rdd.getNumPartitions() > 1
    made = agencies.dataset_district_of_columbia(spark, tmp_path)
    assert "ArrowEvalPython" not in made._jdf.queryExecution().executedPlan().toString()  # written rows are read
    assert [r.case_number for r in made.collect()] == [f"12-RC-{k}" for k in range(1, 9)]
