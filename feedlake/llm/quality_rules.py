"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "[^#*$%&|<>]+"
BLANK = "[\\x09-\\x0D\\x20]+"
#: Function words of the four languages, as they stand alone in a text.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by are this from or an at "
    "der die das und ist von zu den mit für ein eine nicht auch auf im sich dem "
    "le la les de des et un une que en est du dans pour pas qui sur au avec par "
    "el los las y del con por se no su para al lo como"
).split()


class Rule(NamedTuple):
    """A measure that has to lie within bounds; an open bound is None."""

    measure: str
    low: float | None
    high: float | None


RULES = (
    Rule("word_length", 2.0, 12.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.04, None),
    Rule("dup_line_ratio", None, 0.4),
)


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.col(text), BLANK), "")


def _windows(words: str) -> Column:
    """One number per 3-word window: its hash above, its place in the lowest ``bits`` bits."""
    return F.expr(
        f"transform(slice({words}, 1, greatest(size({words}) - 2, 0)), (w, i) -> "
        f"(shiftleft(xxhash64(w, {words}[i + 1], {words}[i + 2]), bits) | i))"
    )


def _repeated() -> Column:
    """Places of windows that stand twice or more, ascending; equal hashes are checked on the words."""
    same = "(shiftright(sorted[{0}], bits) = shiftright(sorted[{1}], bits) and {words})"
    words = " and ".join(
        f"words[cast(sorted[{{0}}] & mask as int) + {k}] = words[cast(sorted[{{1}}] & mask as int) + {k}]" for k in range(3)
    )

    def pair(a: str, b: str) -> str:
        return same.replace("{words}", words).format(a, b)

    return F.expr(
        "sort_array(transform(filter(sorted, (x, i) -> "
        f"(i > 0 and {pair('i', 'i - 1')}) or (i + 1 < size(sorted) and {pair('i', 'i + 1')})), x -> x & mask))"
    )


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``measures`` of counts and ratios of the text."""
    names = docs.columns
    kept = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    texts = docs.select(kept, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("row", "text", _words("text").alias("words"), F.split("text", "\n").alias("lines"))
    # at least 16 bits of place, more for longer texts
    bits = F.greatest(F.lit(16), F.ceil(F.log2(F.size("words") + 1)).cast("int"))
    texts = texts.select("*", F.filter("lines", lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0).alias("full"), bits.alias("bits"))
    texts = texts.select("*", F.sort_array(_windows("words")).alias("sorted"), F.expr("shiftleft(1L, bits) - 1").alias("mask"))
    texts = texts.select("*", _repeated().alias("at"))
    stop = F.filter("words", lambda w: w.isin([*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS), *(w.upper() for w in STOP_WORDS)]))
    # a repeated window covers three words, fewer where the next one begins earlier
    covered = F.expr("aggregate(transform(at, (p, k) -> least(3L, coalesce(get(at, k + 1) - p, 3L))), 0L, (a, x) -> a + x)")
    long = lambda c: c.cast("long")
    texts = texts.select(
        "row",
        long(F.size("words")).alias("n_words"),
        long(F.length(F.array_join("words", ""))).alias("word_chars"),
        long(F.length(F.regexp_replace("text", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("full") - F.size(F.array_distinct("full"))).alias("n_dup_lines"),
        long(F.size("full")).alias("n_lines"),
        covered.alias("n_repeat_words"),
        long(F.size(stop)).alias("n_stop_words"),
    )
    words = F.greatest("n_words", F.lit(1))
    ratios = [
        (F.col("word_chars") / words).alias("word_length"),
        (F.col("n_symbols") / words).alias("symbol_ratio"),
        (F.col("n_stop_words") / words).alias("stop_word_ratio"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_ratio"),
    ]
    # the line number keeps a later filter above this projection: pushed below, it would work out the
    # nested arrays anew for every mention
    line = F.monotonically_increasing_id().alias("line")
    return texts.select("row", F.struct(*texts.columns[1:], *ratios, line).alias("measures"))


def compiled(rules: tuple[Rule, ...]) -> Column:
    """The whole table as one condition on ``measures``."""
    passed = F.lit(True)
    for rule in rules:
        value = F.col("measures").getField(rule.measure)
        if rule.low is not None:
            passed = passed & (value >= rule.low)
        if rule.high is not None:
            passed = passed & (value <= rule.high)
    return passed


def judged(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, measures, base_failed, kept): the input row as a struct, so that no names clash.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated 3-word windows.
    ``kept``: not base_failed and within all thresholds. A null text is empty and fails the base.
    Rows are judged one by one, so repeated rows get the same verdict and no rows give none.
    """
    n = F.col("measures.n_words")
    failed = (n < 50) | (100 * F.col("measures.n_repeat_words") > 50 * n)
    out = measured(docs, text_col).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & compiled(rules))


def rule_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: (doc_id, n_words, word_chars, …, base_failed, kept); see ``judged``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words"]
    return judged(docs, "text", rules).select("row.doc_id", *(f"measures.{c}" for c in names), "base_failed", "kept")
