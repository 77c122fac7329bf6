"""Counts gathered by the write itself."""
from newsflow.operators import combine as C


def test_counts_equal_a_group_by(spark, tmp_out):
    rows = [("ifm", 1)] * 5 + [("webdo", 2)] * 3 + [(None, 3), ("other", 4)]
    df = spark.createDataFrame(rows, "site string, v int").repartition(3)
    got = {r.site: r.n for r in C.write_with_counts(df, tmp_out).collect()}
    assert got == {"ifm": 5, "webdo": 3, None: 2}
    assert spark.read.parquet(tmp_out).count() == 10
    assert C.write_with_counts(df.where("false"), tmp_out).collect() == []
