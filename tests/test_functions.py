"""Column helpers at their edges: none of them may raise under ANSI mode."""

from pyspark.sql import functions as F

from carelake.functions import columns as C


def one_col(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_integral_key(spark):
    vals = ["5", " 05 ", "5.0", "5.5", "XX", None, "1e30", "inf", "NaN", "-3", ""]
    got = [r.k for r in one_col(spark, vals).select(C.integral_key("x").alias("k")).collect()]
    assert got == [5, 5, 5, None, None, None, None, None, None, -3, None]


def test_safe_bigint(spark):
    vals = ["5", " 05 ", "5.0", "XX", None, "99999999999999999999"]
    got = [r.k for r in one_col(spark, vals).select(C.safe_bigint("x").alias("k")).collect()]
    assert got == [5, 5, None, None, None, None]


def test_number_or_zero(spark):
    vals = ["1.5", "abc", None, "NaN", "-2"]
    got = [r.k for r in one_col(spark, vals).select(C.number_or_zero("x").alias("k")).collect()]
    assert got == [1.5, 0.0, 0.0, 0.0, -2.0]


def test_iso_date_text(spark):
    vals = ["2015-01-02", "20150102", "02-Mar-2015", "Jan 2 2015", None]
    got = [r.k for r in one_col(spark, vals).select(C.iso_date_text("x").alias("k")).collect()]
    assert got == ["2015-01-02", "2015-01-02", "2015-03-02", "Jan 2 2015", None]


def test_strip_ws_and_month(spark):
    df = one_col(spark, ["\t D001 \n", "2020-07-15"])
    got = [tuple(r) for r in df.select(C.strip_ws("x"), C.month_of("x")).collect()]
    assert got == [("D001", "\t D001 "), ("2020-07-15", "2020-07")]


def test_strip_ws_of_text_with_and_without_blanks(spark):
    vals = ["D 1", " D1", "D1\u2003", "\u00a0", "", "\u00e9x", "x\u00e9", "~", "\x1f!", "!\x7f", None]
    want = ["D 1", "D1", "D1", "", "", "\u00e9x", "x\u00e9", "~", "!", "!\x7f", None]
    df = one_col(spark, vals)
    assert [r[0] for r in df.select(C.strip_ws("x")).collect()] == want
    assert [r[0] for r in df.select(F.expr(C.strip_ws_sql("x"))).collect()] == want
    padded = one_col(spark, [f"{chr(i)}a{chr(i)}b{chr(i)}" for i in range(1, 0x3100)])
    by_pattern = F.regexp_replace("x", rf"^{C.WHITESPACE}+|{C.WHITESPACE}+\z", "")
    assert padded.where(by_pattern != C.strip_ws("x")).count() == 0
    assert padded.where(C.strip_ws("x") != F.expr(C.strip_ws_sql("x"))).count() == 0


def test_non_negative_amount(spark):
    vals = ["0", "1.5", "-0.01", "NaN", None]
    got = [r.k for r in one_col(spark, vals).select(C.non_negative_amount("x").alias("k")).collect()]
    assert got == [True, True, False, False, None]
    assert one_col(spark, ["1"]).where(C.non_negative_amount("x")).count() == 1
