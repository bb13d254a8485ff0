import pytest

import __spark_entry__ as entry
from cohortrail.plans import oracle
from cohortrail.plans import queries as registry
from tests.compare import difference, duck_rows, spark_rows
from tests.conftest import DATA

QUERIES, SQL = registry.registered(), oracle.statements()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    sf_dir = f"{DATA}/sf0.01"
    columns, got = spark_rows(QUERIES[name](spark, sf_dir))
    names, want = duck_rows(duck(sf_dir), SQL[name])
    assert columns == names
    assert want, "the oracle must not be empty"
    assert got == want, difference(got, want)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
