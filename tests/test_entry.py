"""Every registered query against its SQL twin on the smallest given tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from check import compare
from conftest import SF
from tierwatch.plans.registered import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        made.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return made


def test_entry(spark):
    found = driver.entry(spark)
    assert found.columns == ["ml_decision", "n", "violations", "pct", "violation_rate"] and found.count() == 3


#: Trees are beyond SQL: tests/test_model.py holds these against a plain recount of the stored predictions.
TWINLESS = {"train_score", "held_out_quality", "model_metrics"}


def test_every_other_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES) - TWINLESS and set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, connection, name):
    state, _, _, note = compare(spark, connection, name, SF)
    assert state == "same", note
