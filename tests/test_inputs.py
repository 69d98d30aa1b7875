"""Inputs derived from the driver's tables."""

import os

import pytest
from pyspark.sql import functions as F

from proofs.inputs import _WORD, CELLS, INPUTS, SPARK, SPARK_TEXTS, Inputs
from proofs.queries import Lake

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(set(SPARK_TEXTS) - {CELLS}))
def test_groups_of_cells_equal_groups_of_line_items(spark, name):
    """Also with a status that no network of its own belongs to, and without a day, a supplier or a price."""
    inputs = Inputs(spark, SF_DIR)
    rest = F.col("l_orderkey") % 11
    status = F.when(rest == 1, "P").when(rest == 2, None).otherwise(F.col("l_linestatus"))
    odd = inputs.table("lineitem").withColumns(
        {"l_linestatus": status, "l_shipdate": F.when(rest != 3, F.col("l_shipdate")), "l_suppkey": F.when(rest != 4, F.col("l_suppkey")),
         "l_extendedprice": F.when(rest != 5, F.col("l_extendedprice"))}
    )
    inputs._built["lineitem"] = odd
    text = _WORD.sub(lambda m: SPARK.get(m[1], m[0]), INPUTS[name])
    plain = spark.sql(text, **{word: inputs[word] for word in _WORD.findall(INPUTS[name])})
    ours = inputs[name]
    assert ours.dtypes == plain.dtypes
    assert plain.count() > 0
    assert ours.exceptAll(plain).count() == plain.exceptAll(ours).count() == 0


def test_sources_and_the_search_for_their_newest_run_read_stored_cells(spark):
    lake = Lake(spark, SF_DIR)
    for df in (lake.results, lake.state_results, lake.targets, lake.state_targets, lake.national_targets, lake.indicator):
        assert "l_shipdate" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_both_branches_of_the_indicator_read_stored_targets(spark):
    lake = Lake(spark, SF_DIR)
    files = [f for f in lake.indicator.inputFiles() if "/targets-" in f]
    assert files and not [f for f in lake.indicator.inputFiles() if "lineitem" in f]
