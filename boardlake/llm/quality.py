"""Line-first cleaning and rejection of documents (operator 4), in DataFrame functions only.

Every line is judged alone:

* punctuation: a line without any sentence mark, or with more loud marks (``!`` and
  symbols) than two for three words, fails;
* navigation: a line whose words are cut by separators (``|``, ``>``, ``»``, ``·``) at
  least every fourth word fails;
* boilerplate: a line with a phrase of consent banners, scripts, rights or placeholder
  text fails.  The phrases are English; such lines of other languages fail only by the
  other rules.

Failing lines are removed.  A document that loses more than ``max_loss`` of its word
characters is rejected, as is one that fails the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import BLANKS

SYMBOLS = r"[#*$%&|<>]"
LOUD = r"[!#*$%&|<>]"
SEPARATORS = r"[|>»·]"
SENTENCE_MARK = r"[.!?…。！？]"
BOILERPLATE = (
    r"(?i)lorem ipsum|javascript|cookie policy|accept (?:all )?cookies|privacy policy|terms of (?:use|service)"
    r"|all rights reserved|licensed under|skip to (?:main )?content|click here|read more\b|subscribe to our"
)


def words_of(text: Column) -> Column:
    """Words of a text: runs of characters other than blank and U+0009 to U+000D."""
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def _line(line: Column) -> Column:
    """(chars, ok) of a line: its word characters, and whether all line rules pass."""
    body = F.regexp_replace(line, f"[{BLANKS}]+", " ")
    body = F.btrim(body)
    return F.struct(body.alias("body"), F.regexp_count(body, F.lit(" ")).alias("gaps"))


def _passes(x: Column) -> Column:
    body, words = x["body"], x["gaps"] + 1
    loud = F.regexp_count(body, F.lit(LOUD)) * 3 > words * 2
    cut = F.regexp_count(body, F.lit(SEPARATORS)) * 4 >= words
    return F.when(~body.rlike(SENTENCE_MARK), False).when(loud, False).when(cut, False).otherwise(~body.rlike(BOILERPLATE))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_loss: float = 0.4, min_words: int = 50, max_repeat: float = 0.5) -> DataFrame:
    """One row per input row: id, base measures, the cleaned text and the verdict.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` are the base measures of
    the whole text; ``n_lines``, ``n_bad_lines`` and ``lost_chars`` belong to the line rules;
    ``cleaned`` is the text without the failing lines.  A null text counts as empty: no
    words, base_failed, not kept.  Repeated rows and ids keep a row each.  Lines without a
    word neither pass nor fail and are left in place.  An empty table gives an empty result;
    further columns of ``docs`` are ignored.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    cut = base.select(
        "id", "t", words_of(F.col("t")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{BLANKS}]")).alias("lines"),
    )
    # the 3-word windows with their place, in sorted order: equal windows stand side by side
    windows = cut.select(
        "id", "t", "lines", F.size("w").cast("long").alias("n_words"),
        F.sort_array(F.when(
            F.size("w") >= 3,
            F.transform(
                F.slice("w", 1, F.size("w") - 2),
                lambda x, i: F.struct(F.concat(x, F.lit(" "), F.get("w", i + 1), F.lit(" "), F.get("w", i + 2)).alias("k"), i.alias("i")),
            ),
        ).otherwise(F.expr("cast(array() as array<struct<k:string,i:int>>)"))).alias("s"),
    )
    same = lambda x, i, d: F.coalesce(x["k"] == F.get("s", i + d)["k"], F.lit(False))
    places = windows.select(
        "id", "t", "lines", "n_words",
        F.sort_array(F.transform(F.filter("s", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"])).alias("p"),
        F.transform("lines", _line).alias("ls"),
    )
    judged = places.select(
        "id", "t", "n_words", "lines", "p", "ls", F.transform("ls", _passes).alias("ok"),
    )
    covered = F.aggregate(
        F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    chars = F.transform("ls", lambda x: F.length(x["body"]) - x["gaps"])
    lost = F.transform("ls", lambda x, i: F.when(F.get("ok", i), F.lit(0)).otherwise(F.length(x["body"]) - x["gaps"]))
    measured = judged.select(
        "id", "t", "n_words", total(chars).alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("ok", lambda x: ~x)).cast("long").alias("n_bad_lines"), total(lost).alias("lost_chars"),
        F.array_join(F.filter("lines", lambda x, i: F.get("ok", i)), "\n").alias("cleaned"),
    )
    base_failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > F.col("n_words") * max_repeat)
    return measured.withColumn("base_failed", base_failed).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("lost_chars") <= F.col("word_chars") * max_loss)).alias("kept"),
        "n_lines", "n_bad_lines", "lost_chars", "cleaned",
    )
