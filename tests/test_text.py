from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsflow.functions import text as T

WS = T.WS_CHARS


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_python_whitespace_set():
    assert len(WS) == 29
    assert all(c.isspace() for c in WS)


def test_whitespace_golden(spark):
    assert one(spark, T.collapse_ws, "a b　c\u0085d\u001ce") == "a b c d e"
    assert one(spark, T.collapse_ws, "  a \n\t b  ") == "a b"
    assert one(spark, T.strip_ws, "  a  b  ") == "a  b"


def test_boilerplate_golden(spark):
    out = one(spark, lambda c: T.remove_phrase(T.collapse_ws(c), "email facebook pinterest twitter print"),
              "x email facebook pinterest twitter print y")
    assert out == "x  y"


def test_title_lower(spark):
    assert one(spark, lambda c: T.lower(T.collapse_ws(c)), "  Le\n  PRÉSIDENT ") == "le président"


def test_chunks(spark):
    df = spark.createDataFrame([(1100,), (1024,), (512,), (0,), (5,)], "n int")
    got = df.select("n", T.chunks(F.expr("repeat('x', n)")).alias("c")).collect()
    sizes = {r["n"]: [len(c) for c in r["c"]] for r in got}
    assert sizes == {1100: [512, 512, 76], 1024: [512, 512], 512: [512], 0: [], 5: [5]}


def test_chunks_code_points(spark):
    s = "é" * 600 + "😀" * 3
    got = one(spark, T.chunks, s)
    assert [len(c) for c in got] == [512, 91] and "".join(got) == s


def test_newline_removal(spark):
    assert one(spark, T.drop_newlines, "x\ny\n") == "xy"


alphabet = st.sampled_from(list("ab é" + WS[:12] + "　 .!?"))


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet, max_size=30), min_size=40, max_size=40))
def test_collapse_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r["i"]: (r["c"], r["s"]) for r in df.select("i", T.collapse_ws("x").alias("c"),
                                                        T.strip_ws("x").alias("s")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (" ".join(v.split()), v.strip())
        assert " ".join(got[i][0].split()) == got[i][0]   # idempotent


def test_java_class_is_python_whitespace(spark):
    """The Spark-side class and the portable class both match exactly str.isspace."""
    cps = [c for c in range(0x3001) if not 0xD800 <= c <= 0xDFFF] + [0xFEFF, 0x1F600, 0x10FFFF]
    df = spark.createDataFrame([(c, chr(c)) for c in cps], "cp int, ch string")
    got = {r["cp"]: (r["a"], r["b"]) for r in df.select(
        "cp", F.col("ch").rlike("^" + T.WS_RE + "$").alias("a"),
        F.col("ch").rlike("^" + T.WS_CLASS + "$").alias("b")).collect()}
    assert all(got[c] == (chr(c).isspace(), chr(c).isspace()) for c in cps)
