"""JavaScript regex / whitespace semantics on Java regex (traps T5-T7, T20, T21)."""

import pytest
from pyspark.sql import functions as F

from boardlake.functions.jscompat import (
    JsRegexError,
    WORD_BOUNDARY,
    js_regex,
    js_trim,
    py_js_trim,
    utf16_len,
    validate_java_regex,
)
from evaluate import one


def test_js_regex_rewrites_dollar_to_absolute_end():
    assert js_regex("abc$").endswith(r"abc\z")


def test_js_regex_rejects_inline_flags():
    with pytest.raises(JsRegexError):
        js_regex("(?i)abc")


def test_js_regex_keeps_groups_and_lookarounds():
    js_regex("(?:a)(?=b)(?!c)(?<=d)(?<!e)(?<n>f)")


def test_js_regex_class_bracket_and_amp():
    out = js_regex("[[]&&x", ignore_case=False)
    assert out == r"[\[]&&x"
    assert js_regex("[a&&b]", ignore_case=False) == r"[a&\&b]"


def test_js_regex_empty_and_any_class():
    assert js_regex("[]", ignore_case=False) == "(?!)"
    assert js_regex("[^]", ignore_case=False) == r"[\s\S]"


def test_js_regex_literal_brace():
    assert js_regex("a{b", ignore_case=False) == r"a\{b"
    assert js_regex("a{2}", ignore_case=False) == "a{2}"


def test_invalid_pattern_fails_at_plan_build(spark):
    with pytest.raises(JsRegexError):
        validate_java_regex(spark, js_regex("a(b"))


def test_unicode_case_insensitive(spark):  # T5
    assert one(spark, F.col("x").rlike(js_regex("équipe")), "ÉQUIPE Data")


def test_dollar_is_absolute_end(spark):  # T21
    assert one(spark, F.col("x").rlike(js_regex("abc$")), "abc")
    assert not one(spark, F.col("x").rlike(js_regex("abc$")), "abc\n")


def test_word_boundary_is_ascii(spark):  # T6
    assert one(spark, F.col("x").rlike(WORD_BOUNDARY + "us" + WORD_BOUNDARY), "zéus")
    assert one(spark, F.col("x").rlike(js_regex(r"\bus\b")), "zéus")
    assert not one(spark, F.col("x").rlike(js_regex(r"\bus\b")), "australia")


def test_backslash_s_includes_nbsp(spark):  # T7
    assert one(spark, F.col("x").rlike(js_regex(r"a\sb")), "a b")
    assert one(spark, F.col("x").rlike(js_regex(r"a\Sb")), "axb")
    assert not one(spark, F.col("x").rlike(js_regex(r"a\Sb")), "a b")


def test_js_trim_strips_unicode_whitespace(spark):  # T7
    v = "﻿  x y \n "
    assert one(spark, js_trim("x"), v) == "x y"
    assert py_js_trim(v) == "x y"


def test_utf16_length():  # T23
    assert utf16_len("emea") == 4
    assert utf16_len("\U0001f600") == 2


@pytest.mark.parametrize(("pattern", "text", "hit"), [
    (r"\Aa", "Aa", True), (r"\Aa", "a", False), (r"x\Z", "xZ", True), (r"x\z", "xz", True), (r"\Qa.b\E", "Qa.bE", True),
    (r"\Qa.b\E", "a.b", False), (r"\h\R\X\e\a", "hRXea", True), (r"a\vb", "a\x0bb", True), (r"a\vb", "a\nb", False),
    (r"^[\S]$", "\u00a0", False), (r"^[\Sx ]$", " ", True), (r"^[^\S]$", "\u00a0", True), (r"^[^\S ]$", " ", False),
    (r"^[^\S ]$", "\t", True), (r"\cJ", "\n", True), (r"\x4", "x4", True), (r"\u12", "u12", True), (r"(a)\1", "aa", True),
    (r"\101", "A", True), (r"[\b]", "\x08", True), (r"[\B]", "B", True), (r"a{,2}", "a{,2}", True), (r"a+?", "a", True),
])
def test_escapes_mean_what_javascript_means(spark, pattern, text, hit):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(F.col("x").rlike(js_regex(pattern, ignore_case=False)).alias("r")).first()["r"] is hit


@pytest.mark.parametrize("pattern", ["a*+", "a++", "a?+", "a{2}+", "a+?+"])
def test_possessive_quantifiers_are_rejected(pattern):
    with pytest.raises(JsRegexError):
        js_regex(pattern)
