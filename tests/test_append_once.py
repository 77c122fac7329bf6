"""K3: a run is stored once, whatever dies in between."""
import pytest

from newsflow.sinks import tables as TB


def rows(spark, path, schema="a int, art_source string"):
    from pyspark.sql.types import _parse_datatype_string
    return sorted((r.a, r.art_source) for r in TB.read_committed(spark, path, _parse_datatype_string(schema)).collect())


def data(spark, k):
    return spark.createDataFrame([(k, "x"), (k, "x"), (k + 1, "y/ é")], "a int, art_source string")


def test_runs_count_once(spark, tmp_out):
    assert rows(spark, tmp_out) == [] and TB.committed_runs(spark, tmp_out) == {}
    assert TB.append_once(data(spark, 1), tmp_out, "r1")
    want = [(1, "x"), (1, "x"), (2, "y/ é")]
    assert rows(spark, tmp_out) == want
    assert not TB.append_once(data(spark, 1), tmp_out, "r1") and rows(spark, tmp_out) == want
    assert TB.append_once(data(spark, 5), tmp_out, "r2")
    assert rows(spark, tmp_out) == want + [(5, "x"), (5, "x"), (6, "y/ é")]
    assert TB.append_once(data(spark, 1).where("false"), tmp_out, "r3") and len(rows(spark, tmp_out)) == 6
    assert set(TB.committed_runs(spark, tmp_out)) == {"r1", "r2", "r3"}


def test_dead_attempts_are_not_read(spark, tmp_out, monkeypatch):
    def die(*_):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:                    # killed between the rows and the manifest
        m.setattr(TB, "commit", die)
        with pytest.raises(RuntimeError):
            TB.append_once(data(spark, 1), tmp_out, "r1")
    assert rows(spark, tmp_out) == []
    files = TB._Files(spark, tmp_out)
    files.publish(f"{TB.MANIFESTS}/r1.json", '{"attem')   # killed within the manifest
    assert rows(spark, tmp_out) == [] and len(files.names(TB.DATA)) == 1
    assert TB.append_once(data(spark, 1), tmp_out, "r1") and len(rows(spark, tmp_out)) == 3
    late = f"{TB.DATA}/{TB.ATTEMPT}=r1-late"                           # a second attempt comes last
    data(spark, 1).write.partitionBy("art_source").parquet(f"{tmp_out}/{late}")
    assert not TB.commit(spark, tmp_out, "r1", late) and len(rows(spark, tmp_out)) == 3
    assert len(TB.sweep(spark, tmp_out)) == 2 and len(rows(spark, tmp_out)) == 3 and TB.sweep(spark, tmp_out) == []


def test_new_columns_and_bad_ids(spark, tmp_out):
    TB.append_once(data(spark, 1), tmp_out, "r1")
    TB.append_once(data(spark, 2).selectExpr("*", "'n' AS more"), tmp_out, "r2")
    assert sorted((r.a, r.more or "") for r in TB.read_committed(spark, tmp_out).collect()) == [(1, ""), (1, ""), (2, ""), (2, "n"), (2, "n"), (3, "n")]
    for bad in ("", "a/b", "..", "_x"):
        with pytest.raises(ValueError):
            TB.append_once(data(spark, 1), tmp_out, bad)
