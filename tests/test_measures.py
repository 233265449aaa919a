import pytest
from pyspark.sql import functions as F

from orebed.operators.measures import Members, Ratio, Total, measured

SCHEMA = "region string, product string, who bigint, owed double, late double"
ROWS = [
    ("n", "a", 1, 10.0, 5.0), ("n", "b", 1, 30.0, 0.0), ("s", "a", 1, 0.0, 0.0), ("s", "a", 2, 60.0, 20.0),
    (None, "a", 3, 0.0, 0.0), (None, "a", None, 0.0, 0.0), ("n", "a", 1, 10.0, 5.0),
]


def measures():
    return [Total("owed_sum", F.col("owed")), Total("late_sum", F.col("late")), Ratio("npl", "late_sum", "owed_sum", 4), Members("people", "who")]


def test_groups_and_totals_from_their_parts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = measured(df, measures(), ["region", "product"], [["region"], ["product"], []])
    rows = {(r.level, r.region, r.product): (r.owed_sum, r.npl, r.people) for r in found.collect()}
    assert rows == {
        (1, "n", None): (50.0, 0.2, 1), (1, "s", None): (60.0, 0.3333, 2), (1, None, None): (0.0, None, 1),
        (2, None, "a"): (80.0, 0.375, 3), (2, None, "b"): (30.0, 0.0, 1), (3, None, None): (110.0, 0.2727, 3),
    }


def test_what_cannot_be_measured_is_refused(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        measured(df, [Ratio("npl", "late_sum", "owed_sum")], ["region"], [[]])
    with pytest.raises(ValueError):
        measured(df, [Members("a", "who"), Members("b", "product")], ["region"], [[]])


def test_empty_input(spark):
    assert measured(spark.createDataFrame([], SCHEMA), measures(), ["region"], [["region"], []]).count() == 0
