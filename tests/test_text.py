"""Micro-fixtures of the text functions."""

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as T


def values(spark, expr, rows):
    """``expr(column)`` over the rows, in order."""
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, v string")
    return [r[0] for r in df.orderBy("k").select(expr(F.col("v"))).collect()]


def test_junk_paragraphs(spark):
    junk = ["574027", "8192x5464", "1/3", "10.", "Topics", "Trending Now", "Share:", "Story ID:", "Date of Birth:", "RELATED / GALLERY"]
    good = ["He died.", "NASA.", "F-35 (LRIP)", "The quick brown fox jumped"]
    assert values(spark, T.junk_paragraph, junk + good) == [True] * len(junk) + [False] * len(good)


def test_furniture_lines(spark):
    gone = ["IMAGE INFO", "Date Taken: 01.02.2026", "PUBLIC DOMAIN", "01.02.2026", "Photo by Sgt. X", "MORE LIKE THIS", "read more", "MARINE CORPS BASE HAWAII, HAWAII, UNITED STATES"]
    kept = ["The photo by the river was taken at dawn.", "marine corps base hawaii, united states"]
    assert values(spark, T.furniture_line, gone + kept) == [True] * len(gone) + [False] * len(kept)
    assert values(spark, T.without_furniture, ["a b\nTAGS\nc d\n\nPRINT\n\n e", None, ""]) == ["a b\nc d\n\ne", "", ""]


@pytest.mark.parametrize("paras, out", [
    (["He died.", "Long para here now."], ["He died. Long para here now."]),
    (["A b.", "C d.", "Long para here now."], ["A b. C d.", "Long para here now."]),
    (["Long para here now.", "He died."], ["Long para here now.", "He died."]),
    (["X y z w.", "X y z w.", "Other para here now."], ["X y z w.", "Other para here now."]),
    (["X y z w.", "Topics", "X y z w."], ["X y z w."]),
    ([], []),
])
def test_clean_array(spark, paras, out):
    df = spark.createDataFrame([(paras,)], "p array<string>")
    assert df.select(T.clean_array(F.col("p"))).first()[0] == out


def test_titles_and_segments(spark):
    assert values(spark, T.strip_gallery, ["Exercise Alpha [Image 2 of 5]", None, "(image 1 of 2) B"]) == ["Exercise Alpha", "", "B"]
    assert values(spark, T.title_key, ["Hello, World_2!", "英国 国防部：报告", None]) == ["helloworld2", "英国国防部报告", ""]
    assert values(spark, T.last_segment, ["http://www.example.org/entity/Q728"]) == ["Q728"]


def test_dates(spark):
    rows = ["Mon, 06 Jan 2025 10:00:00 +0000", "6 Jan 2025 10:00:00 GMT", "2025-01-06T10:00:00+08:00", "2025-01-06T10:00:00", "2025-01-06T10:00:00Z", "garbage", "", None]
    found = values(spark, lambda c: F.date_format(T.timestamp(c), "MM-dd HH:mm"), rows)
    assert found == ["01-06 10:00", "01-06 10:00", "01-06 02:00", "01-06 10:00", "01-06 10:00", None, None, None]


def test_url_guard(spark):
    bad = ["ftp://a.example/", "http://localhost/", "http://x.internal/", "https://10.0.0.1/", "https://[::1]/", "not a url", None]
    assert values(spark, T.url_allowed, [*bad, "https://a.example/x"]) == [False] * len(bad) + [True]
    assert values(spark, lambda c: T.url_allowed(c, ("https",), ["a.example"]), ["https://A.example/", "https://b.example/", "http://a.example/"]) == [True, False, False]


def test_ratio(spark):
    df = spark.createDataFrame([("abcd", ""), ("abcdefghij", "字"), ("ab", "123456789"), (None, "x"), ("a", None)], "a string, b string")
    assert [r[0] for r in df.select(T.ratio_ok(F.col("a"), F.col("b"), 0.1, 4.0)).collect()] == [False, True, False, True, False]
    assert df.select(T.ratio_ok(F.col("a"), F.col("b"), 0.05, 5.0)).collect()[2][0]


def test_model_output(spark):
    two = lambda c: T.parse_array(c, F.lit(2))
    assert values(spark, two, ['pre ["a","b"] post', '["a"]', '["a",""]', '["a",null]', "none", None]) == [["a", "b"], None, None, None, None, None]
    assert values(spark, lambda c: T.parse_titles(c, F.lit(1)), ['[{"t":"x"}]', "[x"]) == [None, None]
    field = lambda c: T.parse_field(c, "p")
    rows = ['{"p":"他说"你好"了"}', "10月10日，好", '{"p":"[1] 译文"}', "p：译文：一\n{", "", None, "a\nb"]
    assert values(spark, field, rows) == ['他说"你好"了', "10月10日，好", "译文", "一", "", "", "a\nb"]
    assert values(spark, lambda c: T.parse_field(c, "t"), ["first\nsecond"]) == ["first"]


def test_summary(spark):
    assert values(spark, T.summary, ["<p>a  b</p>" + "x" * 700])[0] == ("a b " + "x" * 589)[:500]
