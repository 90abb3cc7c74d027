"""Whole scopes are replaced whatever their names are."""

from laserfold.sources import tables


def rows(spark, *pairs):
    return spark.createDataFrame([*pairs], "n int, siteId string")


def test_null_and_odd_sites_are_replaced_and_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = "a\u2028b\u0085c"
    tables.replace_snapshot(rows(spark, (1, None), (2, odd), (3, "x")), path, [(None,), (odd,), ("x",)])
    shape = rows(spark).schema

    def found():
        return {(r.n, r.siteId) for r in tables.read_table(spark, path, shape).collect()}

    assert found() == {(1, None), (2, odd), (3, "x")}
    tables.replace_snapshot(rows(spark, (4, None), (5, odd)), path, [(None,), (odd,)])
    assert found() == {(4, None), (5, odd), (3, "x")}
    # Sites that have no rows any more keep no old ones; others stay.
    tables.replace_snapshot(rows(spark, (6, "x")), path, [(None,), (odd,), ("x",)])
    assert found() == {(6, "x")}
