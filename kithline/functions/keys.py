"""Keys by which records meet: tokens and character n-grams, as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import tokens


def token_set(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def token_list(text: Column) -> Column:
    return tokens(text)


def _runs(text: Column, n: int) -> Column:
    """Distinct runs of n characters of a text of at least n."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n))))


def block_ngrams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams with spaces as _, not padded; a shorter text is its own; an empty one has none."""
    marked = F.translate(text, " ", "_")
    return F.when(F.length(marked) >= n, _runs(marked, n)).when(marked != "", F.array(marked)).otherwise(F.array().cast("array<string>"))


def padded_ngrams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams with two spaces before and behind; an empty text has none."""
    return F.when(text != "", _runs(F.concat(F.lit("  "), text, F.lit("  ")), n)).otherwise(F.array().cast("array<string>"))
