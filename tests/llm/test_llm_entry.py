"""The registered queries of this subpackage against their SQL twins."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from check import compare
from conftest import SF
from tierwatch.llm.queries import ORACLES, QUERIES

TWINLESS = {"op1_cross_entropy", "op5_quality_classifier", "op7_sharding", "op8_best_fit_packing", "op9_direct_codes", "op12_whitening",
            "pipeline"}


def test_all_are_registered():
    assert set(QUERIES) - set(ORACLES) == TWINLESS and set(ORACLES) <= set(QUERIES) <= set(driver.queries())
    assert [q for q in QUERIES if q != "pipeline"] and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} - {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    state, _, _, note = compare(spark, connection, name, SF)
    assert state == "same", note


@pytest.mark.parametrize("name", sorted(TWINLESS))
def test_other_queries_run(spark, name):
    assert driver.queries()[name](spark, SF).count() > 0
