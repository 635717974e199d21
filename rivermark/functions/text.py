"""Text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(column: str, field: str) -> Column:
    """A JSON object's field as text."""
    return F.get_json_object(column, f"$.{field}")


def tokens(column: str | Column) -> Column:
    """Lower-case words of a text: letters and digits of any script, and underscores."""
    return F.split(F.lower(column), r"(?U)\W+")


def any_token(column: str | Column, text: str) -> Column:
    """True when the column holds any word of ``text``, case ignored."""
    wanted = F.array_remove(tokens(F.lit(text)), "")
    return F.arrays_overlap(tokens(column), wanted)


def phrase(column: str | Column, text: str) -> Column:
    """True when the column holds the words of ``text`` in sequence."""

    def spaced(c: str | Column) -> Column:
        return F.concat(F.lit(" "), F.array_join(F.array_remove(tokens(c), ""), " "), F.lit(" "))

    return spaced(column).contains(spaced(F.lit(text)))


def contains_text(column: str | Column, part: str) -> Column:
    """Case-insensitive containment."""
    return F.lower(column).contains(part.lower())


def without_prefix(column: str | Column, prefix: str) -> Column:
    text = F.col(column) if isinstance(column, str) else column
    rest = F.substring(text, F.lit(len(prefix) + 1), F.length(text))
    return F.when(text.startswith(prefix), rest).otherwise(text)


def joined(column: str | Column, separator: str = ", ") -> Column:
    return F.array_join(column, separator)
