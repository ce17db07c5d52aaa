"""The registered query keeps each 500th sale."""

import datetime

from tillcast.plans import catalog


def test_every_nth_step(spark, tmp_path):
    rows = [(i, 1, 1, 1, 1.0, 10.0, 0.0, "N", datetime.datetime(1996, 1, 1)) for i in range(10_000, 11_201)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                                "l_discount double, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted((r.rn, r.SalesKey.split("|")[0]) for r in catalog.q_every_nth(spark, str(tmp_path)).collect())
    assert got == [(1, "10000"), (501, "10500"), (1001, "11000")]
