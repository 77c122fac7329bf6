"""One-array files read by byte ranges."""
import io
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.sources import jsonarray as JA
from newsflow.sources import jsonio as J

NASTY = ["", "\\", "\\\\\"", '"', "],[", '{"a":1},{"b":[', ",", '","', ":", "é ش 😀", "\n\t", "[[[[", "}}}}", "\\" * 7]


def by_ranges(raw: bytes, step: int) -> list:
    f, size = io.BytesIO(raw), len(raw)
    cuts = [(a, min(a + step, size)) for a in range(0, size, step)]
    rows = [dict(zip(("quotes", "outside", "inside", "sound"), JA.summary(f, a, b), strict=True), file=0, start=a) for a, b in cuts]
    states = JA.chained([("memory", size)], rows)
    return [json.loads(r) for (a, b), s in zip(cuts, states, strict=True) for r in JA.records(f, a, b, size, *s)]


VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.text(alphabet='ab"\\\\[]{},:\n é', max_size=8) | st.sampled_from(NASTY),
                      lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='k"\\\\,{', max_size=3), x, max_size=3), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(VALUES, max_size=6), st.integers(1, 40), st.booleans(), st.sampled_from([None, 1]))
def test_any_range_size_gives_the_records_in_order(values, step, ascii_only, indent):
    raw = json.dumps(values, ensure_ascii=ascii_only, indent=indent).encode()
    assert by_ranges(raw, step) == values


def test_cut_off_files_raise():
    whole = json.dumps([{"a": "x", "b": [1]}] * 3).encode()
    for n in range(1, len(whole)):
        with pytest.raises(ValueError):
            by_ranges(whole[:n], 5)
    with pytest.raises(ValueError):
        by_ranges(b'{"a": 1}', 3)
    assert by_ranges(b"\xef\xbb\xbf [] \n", 2) == []


def test_one_file_in_many_tasks(spark, tmp_path):
    draw = random.Random(1)
    rows = [{"art_url": f"u{i}", "art_title": draw.choice(NASTY), "art_content": draw.choice(NASTY) * draw.randrange(40),
             "art_type": None, "inactive": bool(i % 2)} for i in range(400)]
    rows[17]["art_content"] = 'long "],[{' * 3000         # one record over many ranges
    for name, kw in (("one", {}), ("ascii", {"ensure_ascii": True}), ("pretty", {"indent": 2})):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(rows, **({"ensure_ascii": False} | kw)), encoding="utf-8")
        for step in (997, 8192, 1 << 24):
            df = JA.read_json_arrays(spark, str(path), J.ARTICLE_JSON, step)
            assert df.rdd.getNumPartitions() == -(-path.stat().st_size // step)
            got = sorted(df.select("art_url", "art_title", "art_content", "art_type", "inactive").collect())
            assert [tuple(r) for r in got] == sorted(tuple(r[k] for k in ("art_url", "art_title", "art_content", "art_type", "inactive")) for r in rows)


def test_folders_empty_files_and_odd_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"art_url": "a"}, null, 5, {"art_url": "b", "other": {"x": [1, {"y": "}"}]}}]')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "_SUCCESS").write_text("x")
    got = JA.read_json_arrays(spark, str(tmp_path), J.ARTICLE_JSON, 7).select("art_url").collect()
    assert sorted(r[0] or "" for r in got) == ["", "", "a", "b"]
    assert JA.read_json_arrays(spark, str(tmp_path / "none*"), J.ARTICLE_JSON).collect() == []


def test_written_arrays_are_arrays(spark, tmp_out):
    df = spark.createDataFrame([(i, None if i % 3 else f'q"{i}') for i in range(20)], "id int, v string").repartition(3)
    JA.write_json_arrays(df, tmp_out)
    files = JA.array_files(spark, tmp_out)
    rows = [r for uri, _ in files for r in json.load(open(uri.removeprefix("file:")))]
    assert sorted((r["id"], r["v"]) for r in rows) == sorted(map(tuple, df.collect())) if rows else False
    assert sorted(map(tuple, JA.read_json_arrays(spark, tmp_out, df.schema, 11).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
