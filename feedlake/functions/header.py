"""File header against catalog columns. Positions are worked out once per file layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.text import NUMBER_TYPE, normalise_title


def normalise_all(names: Column) -> Column:
    return F.transform(names, normalise_title)


def last_position(names: Column, wanted: Column) -> Column:
    """1-based position of the last occurrence, 0 when absent."""
    from_end = F.array_position(F.reverse(names), wanted)
    return F.when(from_end > 0, F.size(names) - from_end + 1).otherwise(0).cast("int")


def golden_positions(names: Column, golden: Column) -> Column:
    """For every catalog column, where the file has it (a repeated title: the last one)."""
    return F.transform(golden, lambda g: last_position(names, g))


def needs_reorder(names: Column, golden: Column) -> Column:
    return names != golden


def header_pairs(names: Column, types: Column) -> Column:
    """Array of (title, type); a repeated title keeps its last position.

    Null when the file has more titles than types.
    """
    pairs = F.filter(
        F.transform(
            names,
            lambda n, i: F.when(
                last_position(names, n) == i + 1,
                F.struct(n.alias("title"), F.get(types, i).alias("type")),
            ),
        ),
        lambda p: p.isNotNull(),
    )
    return F.when(F.size(types) >= F.size(names), pairs)


def number_positions(types: Column) -> Column:
    """0-based positions whose type is NUMBER, in any case."""
    return F.filter(
        F.transform(types, lambda t, i: F.when(F.upper(t) == NUMBER_TYPE, i)),
        lambda i: i.isNotNull(),
    )
