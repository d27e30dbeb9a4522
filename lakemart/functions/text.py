"""Text normalisation with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters after which a new word starts (with white space).
WORD_DELIMITERS = r"""!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def lower_trim(text: Column) -> Column:
    """F8"""
    return F.lower(F.trim(text))


def upper_trim(text: Column) -> Column:
    """F9"""
    return F.upper(F.trim(text))


def initcap_words(text: Column) -> Column:
    """first letter of each word upper, the rest lower; words end at any delimiter, not only blanks."""
    words = F.split(F.lower(text), rf"(?<=[\s{WORD_DELIMITERS}])")
    capitals = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1)))
    return F.array_join(capitals, "")


def initcap_trim(text: Column) -> Column:
    """F10, F11"""
    return initcap_words(F.trim(text))
