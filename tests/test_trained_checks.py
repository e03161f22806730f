"""Queries that train a model and check it against its own scores, on rows built here."""

import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Line items whose flags, bands and prices follow from their quantity."""
    rows = [
        (k, 1 + k % 4, "ANR"[k % 3], "OF"[k % 2], float(1 + k % 50), (1 + k % 50) * 900.0 + k % 7, k % 11 / 100, k % 9 / 100)
        for k in range(600)
    ]
    names = "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double"
    folder = tmp_path_factory.mktemp("lines")
    spark.createDataFrame(rows, f"{names}, l_discount double, l_tax double").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["clf_mlp", "reg_forest", "reg_gbt"])
def test_models_pass_their_own_checks(spark, lines, name):
    assert [tuple(r) for r in contract.queries()[name](spark, lines).collect()] == [(600, 0)]


def test_forest_that_cannot_know_its_label_breaks_every_row(spark, tmp_path):
    """One flag for all rows: no model says more than the frequencies do, and none is taken for learnt."""
    rows = [(k, 1, "A", "O", float(k % 50), 100.0 * k, 0.01, 0.02) for k in range(60)]
    names = "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double"
    spark.createDataFrame(rows, f"{names}, l_discount double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in contract.queries()["clf_forest"](spark, str(tmp_path)).collect()] == [(60, 60)]


def test_forest_passes_its_own_check(spark, tmp_path):
    rows = [(k, 1, "ANR"[k % 50 // 17], "O", float(k % 50), 100.0 * k, 0.01, 0.02) for k in range(300)]
    names = "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double"
    spark.createDataFrame(rows, f"{names}, l_discount double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in contract.queries()["clf_forest"](spark, str(tmp_path)).collect()] == [(300, 0)]
