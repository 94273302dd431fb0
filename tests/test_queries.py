"""Every checkable query against its SQL twin on the smallest tables, and the others for shape."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT, SMALL, normal
from veilframe.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql_twin(spark, duck, name):
    got = catalog.QUERIES[name](spark, SMALL).toPandas()
    assert normal(got) == normal(duck.execute(catalog.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_import_without_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
