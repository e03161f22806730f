import os

import pytest
from pyspark.sql import functions as F

from loomframe import session as ses


def test_the_configured_folder_wins(spark, monkeypatch):
    monkeypatch.setattr(ses, "configured_root", lambda s: "/shared/place/")
    assert ses.shared_root(spark) == "/shared/place"


def test_a_local_master_without_setting_gets_one_folder(spark, monkeypatch):
    monkeypatch.setattr(ses, "configured_root", lambda s: None)
    assert os.path.isdir(ses.shared_root(spark)) and ses.shared_root(spark) == ses.shared_root(spark)


def test_a_cluster_without_setting_fails(spark, monkeypatch):
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(ses, "configured_root", lambda s: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ses.shared_root(Session())


def test_materialised_tables_have_no_lineage(spark):
    table = ses.materialise(spark.range(100).selectExpr("id", "id % 3 k").groupBy("k").count())
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    assert table.count() == 3


def test_balanced_leaves_wide_frames_alone(spark):
    wide = spark.range(0, 1000, 1, 64)
    assert ses.balanced(wide) is wide
    assert ses.balanced(spark.range(0, 1000, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_bounded_deals_rows_over_tasks(spark, tmp_path):
    spark.range(0, 5000, 1, 1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    parts = ses.bounded(table, 500).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 5000 and max(r["count"] for r in parts) <= 600
    assert ses.bounded(table, 5000) is table
