import __spark_entry__ as entry
import pytest

SMALL = "/root/testdata/sf0.001"
CORE = [n for n in entry.queries() if n.startswith(("q_", "p3_"))]


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["pair_index", "case_a_uid", "case_b_uid", "pair_key"] and df.count() > 0


def test_names():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and {"p3_found", "p3_report"} <= set(q)


@pytest.mark.parametrize("name", CORE)
def test_query_against_its_oracle(spark, name):
    from oracle_check import compare

    said, _, _ = compare(spark, SMALL, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert said in ("ok", "no oracle")
