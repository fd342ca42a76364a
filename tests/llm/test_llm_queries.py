import __spark_entry__ as entry
import pytest

NAMES = [n for n in entry.queries() if n.startswith("p") and not n.startswith("p3_")]
COLUMNS = {
    "p1_found": ["source_table", "source_column", "source_key"], "p2_found": ["record_index", "field", "term_id"], "p4_found": ["graph", "member", "group_id"], "p6_found": ["doc_id", "item_id"], "p7_found": ["doc_id", "start_pos", "end_pos", "kind"],
}


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    rows = df.collect()
    assert len(rows) == len({tuple(map(str, r)) for r in rows})
    assert name not in COLUMNS or df.columns == COLUMNS[name]


def test_components_against_sql(spark):
    from oracle_check import compare

    assert compare(spark, "/root/testdata/sf0.001", "p4_found", entry.queries()["p4_found"], entry.oracle_sql()["p4_found"])[0] == "ok"
