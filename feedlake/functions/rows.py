"""Row checks and projections.

What has to happen to the rows of a file depends on its header only. It is worked out once per
file as a few regular expressions; a row then takes plain string functions that stay inside
generated code. Array functions with lambdas do the same several times slower.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.text import US

LOAD_FLAG = "0"  # fixed first audit field
WIDE = 800  # columns; a match recurses per column, so wider rows take the array functions below

_FIELD = r"[^\x1f]*+"
_SPACE = r"[\x00-\x1e\x20]*+"  # what a trim removes, without the field separator


def _digits_up_to(bound: str) -> str:
    """Alternatives for numbers as long as ``bound`` that do not exceed it."""
    smaller = [
        f"{bound[:i]}[0-{int(d) - 1}][0-9]{{{len(bound) - i - 1}}}" for i, d in enumerate(bound) if d != "0"
    ]
    return "|".join([*smaller, bound])


def _number_pattern() -> str:
    """Empty, a double when it has a point, or else a 64-bit integer; spaces around it allowed."""

    def long(bound: str) -> str:
        return rf"(?=[0-9])0*+(?:[0-9]{{0,18}}+(?![0-9.])|(?:{_digits_up_to(bound)})(?![0-9.]))"

    short = r"[0-9]{1,18}+(?![0-9.xX])"
    decimal = r"(?:[0-9]++\.[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+[dDfF]?+"
    hexadecimal = r"0[xX](?:[0-9a-fA-F]++\.[0-9a-fA-F]*+|\.[0-9a-fA-F]++)[pP][+-]?+[0-9]++[dDfF]?+"
    usual = r"-?+[0-9]{1,18}+(?:\.[0-9]++)?+(?![^\x1f])"  # most values; the rest is exact
    signed = rf"[+-]?+(?:{short}|{decimal}|{hexadecimal})"
    positive = r"\+?+" + long("9223372036854775807")
    negative = "-" + long("9223372036854775808")
    return rf"(?:{usual}|{_SPACE}(?:{signed}|{positive}|{negative}){_SPACE})?+"


NUMBER = _number_pattern()


def is_number_text(value: Column) -> Column:
    return F.coalesce(value, F.lit("")).rlike(rf"^{NUMBER}\z")


def field_count(value: Column) -> Column:
    return F.octet_length(value) - F.octet_length(F.replace(value, F.lit(US), F.lit(""))) + 1


# -- per file -----------------------------------------------------------------------------------


def _each(items: Column, piece) -> Column:
    return F.array_join(F.transform(items, piece), "")


def all_fields_pattern(names: Column) -> Column:
    """One group per column of the file."""
    return F.concat(F.lit("^"), _each(names, lambda n: F.lit(rf"\x1f({_FIELD})")), F.lit(r"\z"))


def golden_text(positions: Column, pii: Column) -> Column:
    """Replacement that puts the groups in catalog order; personal and absent ones stay empty."""
    return F.array_join(
        F.transform(
            positions,
            lambda p, i: F.when((p == 0) | F.get(pii, i), F.lit("")).otherwise(
                F.concat(F.lit("$"), p.cast("string"))
            ),
        ),
        US,
    )


def source_pattern(known: Column, pii: Column) -> Column:
    """Matches rows of any width: a group per known column, without the text of personal ones.

    ``known`` and ``pii`` follow the file's own columns. Fields beyond them are unknown.
    """
    return F.concat(
        F.lit("^"),
        _each(
            known,
            lambda k, i: F.when(F.get(pii, i), F.lit(rf"(?:(\x1f){_FIELD})?+"))
            .when(k, F.lit(rf"(\x1f{_FIELD})?+"))
            .otherwise(F.lit(rf"(?:\x1f{_FIELD})?+")),
        ),
        F.lit(r"(?s:.*+)\z"),
    )


def source_text(known: Column) -> Column:
    groups = F.sequence(F.lit(1), F.size(F.filter(known, lambda k: k)))
    return F.when(
        F.exists(known, lambda k: k), _each(groups, lambda g: F.concat(F.lit("$"), g.cast("string")))
    ).otherwise("")


def numbers_pattern(names: Column, numeric: Column) -> Column:
    """Matches rows whose numeric positions (0-based) all hold numbers; null without any."""
    piece = _each(
        names,
        lambda n, i: F.when(F.array_contains(numeric, i), F.lit(rf"\x1f{NUMBER}")).otherwise(
            F.lit(rf"\x1f{_FIELD}")
        ),
    )
    return F.when(F.size(numeric) > 0, F.concat(F.lit("^"), piece, F.lit(r"\z")))


# -- per row ------------------------------------------------------------------------------------


def _led(value: Column) -> Column:
    """Every field, the first one too, after its separator."""
    return F.concat(F.lit(US), value)


def to_golden_order(value: Column, pattern: Column, replacement: Column) -> Column:
    return F.regexp_replace(_led(value), pattern, replacement)


def blank_personal(value: Column, pattern: Column, replacement: Column) -> Column:
    """Source order with personal data emptied and columns unknown to the catalog left out."""
    kept = F.regexp_replace(_led(value), pattern, replacement)
    return F.substr(kept, F.lit(2))


def numbers_ok(value: Column, pattern: Column) -> Column:
    return pattern.isNull() | (F.regexp_instr(_led(value), pattern) > 0)


# -- per row of a very wide file ----------------------------------------------------------------


def wide_golden_order(fields: Column, positions: Column, pii: Column) -> Column:
    return F.array_join(
        F.transform(
            positions,
            lambda p, i: F.when((p == 0) | F.get(pii, i), F.lit("")).otherwise(F.get(fields, p - 1)),
        ),
        US,
    )


def wide_blank_personal(fields: Column, known: Column, pii: Column) -> Column:
    kept = F.transform(
        fields, lambda v, i: F.when(F.get(pii, i), F.lit("")).when(F.get(known, i), v)
    )
    return F.array_join(F.filter(kept, lambda v: v.isNotNull()), US)


def wide_numbers_ok(fields: Column, numeric: Column) -> Column:
    return F.forall(numeric, lambda i: is_number_text(F.get(fields, i)))


def with_audit(value: Column, job_id: Column, source_file: Column) -> Column:
    return F.concat(value, F.lit(US + LOAD_FLAG + US), job_id, F.lit(US), source_file)
