"""Whitespace checks and text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 21 characters that are replaced by "_".
SPECIAL_CHARACTERS = "\\:^${}[]().*+?|<>-&% "

# Everything up to and including the space is trimmed from tag values.
_TRIMMED = "".join(map(chr, range(0x21)))


def has_no_whitespace(text: Column) -> Column:
    """True unless the text holds whitespace; NULL and "" pass."""
    return ~F.coalesce(text, F.lit("")).rlike(r"\p{javaWhitespace}")


def has_text(text: Column) -> Column:
    """True when the text holds at least one character that is not whitespace."""
    return F.coalesce(text, F.lit("")).rlike(r"[^\p{javaWhitespace}]")


def sanitize(text: Column) -> Column:
    """Replace each special character by an underscore."""
    return F.translate(text, SPECIAL_CHARACTERS, "_" * len(SPECIAL_CHARACTERS))


def sanitize_if_spaced(text: Column) -> Column:
    """Sanitize only text that holds whitespace; anything else stays as it is.

    Tabs and newlines trigger the cleaning but are not among the replaced
    characters, so they stay.
    """
    return F.when(has_no_whitespace(text), text).otherwise(sanitize(text))


def trim_controls(text: Column) -> Column:
    """Strip control characters and spaces from both ends (``trim`` strips spaces only)."""
    return F.btrim(text, F.lit(_TRIMMED))


def wrap(text: Column) -> Column:
    """Put a tag value in double quotes; NULL becomes ``"null"``."""
    return F.concat(F.lit('"'), F.coalesce(text, F.lit("null")), F.lit('"'))
