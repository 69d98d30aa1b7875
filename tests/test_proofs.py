"""Queries against their SQL on the smallest tables (all of them with ALL_PROOFS=1)."""

import os

import pytest

import __spark_entry__ as contract
from proofs.oracles import oracles
from proofs.queries import QUERIES
from tools.compare import compare, open_tables

SF_DIR = "/root/testdata/sf0.001"
USUAL = ("f1_latest_run", "w1_keep_latest", "p1_safe_cast", "m2_result", "st5_dead_letter", "st6_stream_equals_batch",
         "io4_sample_once", "g_indicador_municipio", "o3_top10")
NAMES = list(contract.queries()) if os.environ.get("ALL_PROOFS") else USUAL


def test_every_expected_result_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(oracles()) == set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    ok, message = compare(spark, open_tables(SF_DIR), name, SF_DIR)
    assert ok, message
