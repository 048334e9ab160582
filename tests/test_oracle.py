import pytest

from harness import check, oracle, registry

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(GIVEN)


def test_every_query_has_a_counterpart():
    assert set(oracle.statements()) == set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_its_counterpart(spark, duck, name):
    same, note = check.compare(spark, duck, name, GIVEN)
    assert same, note
