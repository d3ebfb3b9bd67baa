"""Words and lines as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that separates words.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


_ODD = ("  ", "\t", "\x0b", "\x0c", "\r")


def let(value: Column, use) -> Column:
    """use(value), with value evaluated once."""
    return F.transform(F.array(value), use)[0]


def spaced(text: Column) -> Column:
    """A text's words with one blank between two; null and blank texts are empty."""
    bare = F.btrim(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" ")), F.lit(SPACE))
    bare = F.replace(F.replace(bare, F.lit("  "), F.lit(" ")), F.lit("  "), F.lit(" "))
    odd = F.lit(False)
    for x in _ODD:
        odd = odd | F.contains(bare, F.lit(x))
    return F.when(odd, F.regexp_replace(bare, SPACE_RUN, " ")).otherwise(bare)


def words(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    return let(spaced(text), lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " ")))


def count_words(spaced_text: Column) -> Column:
    """How many words a text with one blank between two has."""
    blanks = F.octet_length(spaced_text) - F.octet_length(F.replace(spaced_text, F.lit(" "), F.lit("")))
    return F.when(spaced_text == "", F.lit(0)).otherwise(blanks + 1)


def n_words(text: Column) -> Column:
    """How many words a text has, as a long; null: 0."""
    return let(spaced(text), count_words).cast("long")
