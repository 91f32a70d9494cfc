"""Modes of string columns are counted by (column, value), not in one task's map."""

from churnlab.operators import clean as C


def test_modes_without_a_map_of_all_values(spark, monkeypatch):
    rows = [("b", "x", None, 1)] * 2 + [("a", "y", None, 2)] * 2 + [(None, "y", None, 3), ("c", None, None, 4), ("Z", "x", None, 5)]
    df = spark.createDataFrame(rows, "s string, t string, u string, n int")

    def refused(*_):
        raise AssertionError("the mode aggregate holds every distinct value")

    monkeypatch.setattr(C.F, "mode", refused)
    assert C.fit_imputation(df).modes == {"s": "a", "t": "x", "u": None}
