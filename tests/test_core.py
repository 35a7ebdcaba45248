import __spark_entry__ as entry


def test_entry(spark):
    assert {r.issue_kind for r in entry.entry(spark).collect()} <= {"ok", "parent_missing", "ship_before_order"}
