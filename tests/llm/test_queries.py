import pytest

from tidemart.llm.queries import ORACLE, QUERIES
from tidemart.plans.compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    if name in QUERIES:
        assert compare(spark, name, SF, QUERIES[name], ORACLE[name])["match"]


def test_all_are_registered():
    import __spark_entry__ as entry
    assert {n.split("_")[0] for n in entry.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()
