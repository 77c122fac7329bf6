"""Union of unlike records: types against a direct rule, values kept."""
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from newsflow.operators import shapes as SH

RECORDS = "site string, json string"


def kind(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "bigint"
    return "decimal" if isinstance(v, Decimal) else "string" if isinstance(v, str) else "json"


def spelt(v, to):
    """The value as the union's type holds it."""
    if v is None or to in ("bigint", "boolean"):
        return v
    if to.startswith("decimal"):
        return Decimal(v)
    return v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else json.dumps(v, separators=(",", ":")) if isinstance(v, (list, dict)) else str(v)


def made(draw):
    one = {"int": lambda: draw.randrange(-10**12, 10**12), "dec": lambda: Decimal(draw.randrange(1, 10**6) * 10 + 5) / 1000,
           "str": lambda: draw.choice(["", "x", "1", "ü\"'"]), "bool": lambda: draw.random() < 0.5, "null": lambda: None,
           "list": lambda: [1, "a"], "obj": lambda: {"k": 1}}
    allowed = {f: draw.sample(list(one), draw.randrange(1, 3)) for f in ("a", "b c", "d.e", "f'g", "$h")}
    rows = []
    for _ in range(60):
        r = {f: one[draw.choice(kinds)]() for f, kinds in allowed.items() if draw.random() < 0.8}
        rows.append((draw.choice("xyz"), r))
    return rows


def as_json(r):
    return "{" + ", ".join(f"{json.dumps(k)}: {v if isinstance(v, Decimal) else json.dumps(v)}" for k, v in r.items()) + "}"


@pytest.mark.parametrize("seed", range(4))
def test_types_and_values(spark, seed):
    rows = made(random.Random(seed))
    df = spark.createDataFrame([(i, s, as_json(r)) for i, (s, r) in enumerate(rows)], "i int, " + RECORDS).repartition(3)
    report = SH.shape_report(df)
    types = {r.field: r.type for r in report.collect()}
    for f in {f for _, r in rows for f in r}:
        kinds = {kind(r[f]) for _, r in rows if f in r} - {"null"}
        want = "decimal" if kinds in ({"decimal"}, {"decimal", "bigint"}) else kinds.pop() if len(kinds) == 1 else "string"
        assert types[f].split("(")[0] == ("string" if want == "json" else want)
    for r in report.collect():
        wrote = [kind(x[r.field]) for s, x in rows if s == r.site and r.field in x]
        assert r.n == len(wrote) and r.kinds == ",".join(sorted(set(wrote)))
    names = SH.columns(list(types))
    for r in SH.union_shapes(df, report).collect():
        for f, v in rows[r.i][1].items():
            assert r.fields[names[f]] == spelt(v, types[f])
        assert all(r.fields[names[f]] is None for f in types if f not in rows[r.i][1]) and r.unread is None


def test_edges(spark):
    texts = [None, "", "{cut", "[1]", "3", "{}", '{"A": 1, "a": 2, "a_2": 3}', '{"n": null}', '{"q\'\\"": 1}',
             '{"big": 12345678901234567890123456789012345678}', '{"big": 0.5}', '{"e": 1e300}', '{"fields": "f", "site": "g"}']
    df = spark.createDataFrame([("s", t) for t in texts], RECORDS)
    report = SH.shape_report(df)
    types = {r.field: r.type for r in report.collect()}
    assert types["big"] == "string" and types["n"] == "string" and types["e"] == "double"
    got = SH.union_shapes(df, report).collect()
    assert [r.unread for r in got[:6]] == [None, "", "{cut", "[1]", "3", None]
    assert all(r.fields is None for r in got[:5]) and got[5].fields is not None
    assert (got[6].fields["A"], got[6].fields["a_2"], got[6].fields["a_2_2"]) == (1, 2, 3)
    assert got[9].fields["big"] == "12345678901234567890123456789012345678" and got[10].fields["big"] == "0.5"
    assert got[12].site == "s" and got[12].fields["site"] == "g"
    assert SH.union_shapes(df, report).select(F.to_json("record").alias("j")).collect()[8].j == '{"q\'\\"":1}'
    with pytest.raises(ValueError, match="more than 3"):
        SH.union_shapes(df, report, max_fields=3)
    none = df.where("false")
    assert SH.shape_report(none).collect() == [] and SH.union_shapes(none, SH.shape_report(none)).collect() == []
    plan = SH.union_shapes(df.coalesce(1), report)._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
