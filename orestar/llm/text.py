"""Column expressions on text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of the contracts, as a class of a regular
# expression and as characters, and the two halves of the ASCII alphabet.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def present(text: Column) -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` does the same on pure ASCII and is far cheaper than ``translate``.
    """
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def without_space(text: Column) -> Column:
    return F.regexp_replace(present(text), f"[{SPACE_CLASS}]+", "")


def count_words(text: Column) -> Column:
    """Number of runs without white space, as long; 0 for null."""
    return F.coalesce(F.regexp_count(present(text), F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")


def row_digest(text: Column) -> Column:
    """Tells apart rows that share an id but not the text."""
    return F.xxhash64(present(text))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def same(left: Column, right: Column) -> Column:
    """Equality under which null equals null."""
    return left.eqNullSafe(right)
