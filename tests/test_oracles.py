"""Every core query runs over its whole tables; those with SQL equal it."""

import pytest

from ledgerloom.plans import answer_queries, data_queries, search_queries, table_queries

from .compare import differences

SF = "/root/testdata/sf0.001"
MODULES = (table_queries, search_queries, answer_queries, data_queries)
NAMES = [(m, k) for m in MODULES for k in m.QUERIES]


@pytest.mark.parametrize("module,name", NAMES, ids=[k for _, k in NAMES])
def test_query(spark, module, name):
    df = module.QUERIES[name](spark, SF)
    if name in module.ORACLE:
        assert differences(df, SF, module.ORACLE[name]) == ""
    else:
        assert df.count() > 0


def test_names_are_unique():
    names = [k for _, k in NAMES]
    assert len(names) == len(set(names))
    for m in MODULES:
        assert set(m.ORACLE) <= set(m.QUERIES)
