"""Every registered query against its SQL, on the smallest scale."""

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import SF

import __spark_entry__ as contract
from verification.compare import SAME_TYPES, normalised, open_oracle


#: Queries of the optional training-data operators are tested beside them.
CORE = [name for name in contract.queries() if name not in contract._training_data_queries()]


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF)


def test_every_query_has_its_sql():
    assert set(CORE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", CORE)
def test_query_equals_sql(spark, oracle, name):
    frame = contract.queries()[name](spark, SF)
    wanted = oracle.execute(contract.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in wanted.description}
    assert {column: SAME_TYPES[kind] for column, kind in frame.dtypes} == types
    assert normalised(frame.toPandas()) == normalised(wanted.df())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:2] == ["season", "team"] and frame.count() == 200


def test_the_optional_queries_are_left_out_if_they_cannot_be_imported():
    code = "import sys; sys.modules['sentencepiece'] = None; import __spark_entry__ as c; print(*c.queries())"
    root = Path(__file__).resolve().parents[1]
    listed = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert set(listed) == set(CORE) or contract._llm is None
