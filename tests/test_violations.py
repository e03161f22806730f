from pyspark.sql import functions as F

from loomframe.queries.registry import violations


def counts(frame, *what):
    return tuple(violations(frame, *what).first())


def test_a_property_of_all_rows_is_found_in_the_same_pass(spark):
    rows = spark.createDataFrame([(1.0, False), (2.0, True), (3.0, None)], "x double, wrong boolean")
    assert counts(rows, F.col("wrong")) == (3, 2)
    assert counts(rows, F.col("wrong"), F.avg("x") > 1.5) == (3, 2)
    assert counts(rows, F.col("wrong"), F.avg("x") > 2.5) == (3, 3)
    assert counts(rows, F.col("wrong"), F.avg("x") > F.lit(None)) == (3, 3)
    assert counts(rows.where("false"), F.col("wrong"), F.avg("x") > 2.5) == (0, 0)
    plan = violations(rows.repartition(3, "x"), F.col("wrong"), F.avg("x") > 1.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "Subquery" not in plan
