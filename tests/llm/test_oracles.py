import pytest

from ledgerloom.llm import queries

from ..compare import differences


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query(spark, name):
    assert differences(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), "/root/testdata/sf0.01", queries.ORACLE[name]) == ""
