import base64
import html

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.functions import text as T

CASES = ["", " ", "a", " a b ", " x　", "\x1c\x1dy\x85", "[missing]", " [missing]\n", "née <&\"'>", "~~~???>>>", "x" * 200, "日本語 ÿ"]


def values(spark, cases, column):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string").select("i", column.alias("y"))
    return [r["y"] for r in sorted(rows.collect(), key=lambda r: r["i"])]


def test_strip_is_pythons(spark):
    assert values(spark, CASES, T.strip(F.col("x"))) == [c.strip() for c in CASES]


def test_missing(spark):
    assert values(spark, ["a", " [missing] ", None, " b "], T.missing_to_blank(F.col("x"))) == ["a", "", "", " b "]
    assert values(spark, ["a", "[missing]", None, "  "], T.has_text(F.col("x"))) == [True, False, False, False]
    assert values(spark, ["a", "  ", None, " a"], T.not_blank(F.col("x"))) == [True, False, None, True]


def test_codec_is_pythons(spark):
    coded = values(spark, CASES, T.urlsafe_encode(F.col("x")))
    assert coded == [base64.urlsafe_b64encode(c.encode()).decode() for c in CASES]
    assert values(spark, coded, T.urlsafe_decode(F.col("x"))) == CASES


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00")), min_size=20, max_size=60))
def test_random_text(spark, cases):
    assert values(spark, cases, T.strip(F.col("x"))) == [c.strip() for c in cases]
    assert values(spark, cases, T.html_escape(F.col("x"))) == [html.escape(c) for c in cases]
    assert values(spark, cases, T.urlsafe_encode(F.col("x"))) == [base64.urlsafe_b64encode(c.encode()).decode() for c in cases]


def test_page_numbers_and_flags(spark):
    cases = ["12", "iv", " 12", "[missing]", None, "", "9" * 30]
    assert values(spark, cases, T.printed_page_number(F.col("x"))) == [12, 0, 0, 0, 0, 0, 0]
    assert values(spark, ["true", " TRUE ", "false", "yes", None], T.is_true(F.col("x"))) == [True, True, False, False, False]


def test_paths(spark):
    assert values(spark, [".\\in\\a b.pdf", "in/c.pdf", "d"], T.base_name(F.col("x"))) == ["a b.pdf", "c.pdf", "d"]
    cases = ["a/b.PNG", "x.y/z", "q.tiff", "r.what"]
    assert values(spark, cases, T.mime_type(F.col("x"))) == ["image/png", T.DEFAULT_MIME, "image/tiff", T.DEFAULT_MIME]
    path = T.page_image_path("img", F.lit(".\\s\\d.pdf"), F.col("x"))
    assert values(spark, ["e\\d.pdf_page_3.png.json"], path) == ["img/d.pdf/d.pdf_page_3.png"]


def test_chunk_text_leaves_no_gaps(spark):
    b = F.lit("")
    text = T.chunk_text(b, F.lit("t"), b, b, F.lit("s"), F.lit("body"), b, b, F.lit(0), F.lit(4))
    assert values(spark, ["-"], text)[0].split("\n") == [
        "----", "----", "Document title: t", "----", "Section name: s", "Text content: body", "----", "Page sequence number: 4", "----",
    ]
