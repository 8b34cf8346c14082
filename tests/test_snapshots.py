from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from rosterlake.operators.snapshots import snapshot_changes

T0 = datetime(2024, 1, 1)
SCHEMA = "run long, k long, active int, at timestamp, h string, x string, y string"


def changes(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return rows(snapshot_changes(df, "run", "k", F.col("active") == 1, "at", "h", ["x", "y"]))


def test_kinds_of_change(spark):
    t = lambda d: T0 + timedelta(days=d)
    one = [(1, 1, 1, t(0), "A", "x", "y"), (1, 2, 1, t(0), "A", "x", "y"), (1, 3, 1, t(0), None, "x", None), (1, 4, 1, t(0), None, "x", None), (1, 5, 1, t(0), "A", "x", "y"), (1, 6, 0, t(0), "A", "x", "y")]
    two = [
        (2, 1, 1, t(1), " a ", "other", "y"), (2, 2, 1, t(1), "B", "x", "y"), (2, 2, 1, t(0), "A", "x", "y"), (2, 3, 1, t(1), "Z", "x", None), (2, 4, 1, t(1), None, None, "x"),
        (2, 5, 0, t(1), "A", "x", "y"), (2, 6, 1, t(1), "A", "x", "y"), (None, 7, 1, t(1), "A", "x", "y"), (2, None, 1, t(1), "A", "x", "y"),
    ]
    assert changes(spark, one + two) == [("2", "2", "changed"), ("2", "4", "changed"), ("2", "5", "removed"), ("2", "6", "added")]
    assert changes(spark, one) == [] and changes(spark, []) == []


def test_returning_key(spark):
    data = [(1, 1, 1, T0, "A", "", ""), (2, 9, 1, T0, "A", "", ""), (5, 1, 1, T0, "A", "", "")]
    assert changes(spark, data) == [("2", "1", "removed"), ("2", "9", "added"), ("5", "1", "added"), ("5", "9", "removed")]
