from __future__ import annotations

from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import functions as F

from callmeter import fixtures


def test_orders_meet_customers_before_lines(spark, tmp_path):
    """Null and repeated keys as an inner join has them; lines are not dealt anew by their customer."""
    given = {
        "customer": ("c_custkey long, c_mktsegment string", [(1, "BUILDING"), (2, "MACHINERY"), (2, None), (None, "BUILDING")]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderdate date",
            [(10, 1, "1998-01-02"), (11, 2, None), (12, None, "1998-01-03"), (13, 9, "1998-01-03"), (None, 1, "1998-01-04")],
        ),
        "lineitem": (
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string",
            [(k, i, 43, 25, 2.0, "A", "F") for i, k in enumerate((10, 10, 11, 12, 13, None))],
        ),
    }
    for name, (schema, rows) in given.items():
        text = schema.replace(" date", " string")
        made = spark.createDataFrame(rows, text)
        if "o_orderdate" in made.columns:
            made = made.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        made.write.parquet(str(tmp_path / f"{name}.parquet"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        calls = fixtures.calls(spark, str(tmp_path))
        with redirect_stdout(StringIO()) as plan:
            calls.explain()
        got = {(r.call_id, r.timestamp, r.team, r.user_id) for r in calls.collect()}
    finally:
        spark.conf.set(limit, before)
    assert got == {
        ("10-0-43-25", "1998-01-02T06:47:09Z", "data", "user_1"),
        ("10-1-43-25", "1998-01-02T06:47:09Z", "data", "user_1"),
        ("11-2-43-25", None, "finance", "user_2"),
        ("11-2-43-25", None, None, "user_2"),
    }
    first, second = (line for line in plan.getvalue().splitlines() if "Join" in line)
    assert "l_orderkey" in first and "o_custkey" in second
