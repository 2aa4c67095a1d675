"""Text → set elements (word shingles), all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII whitespace; the same class is used by the DuckDB oracle.
WHITESPACE = r"[ \t\n\r\f\x0B]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def word_tokens(text) -> Column:
    """Lower-cased words split on whitespace, empty tokens removed."""
    return F.filter(F.split(F.lower(_c(text)), WHITESPACE), lambda t: t != F.lit(""))


def word_shingles(text, k: int = 3) -> Column:
    """Array of k-word shingles (words joined by one space).

    A text with fewer than ``k`` words yields one shingle of all its words;
    a text without words yields null (no elements).
    """
    if k < 1:
        raise ValueError("shingle size must be >= 1")
    return shingles_of_tokens(word_tokens(text), k)


def shingles_of_tokens(toks, k: int = 3) -> Column:
    """k-word shingles of an ``array<string>`` token column (see ``word_shingles``)."""
    if k < 1:
        raise ValueError("shingle size must be >= 1")
    toks = _c(toks)
    n = F.size(toks)
    starts = F.sequence(F.lit(1), F.greatest(n - F.lit(k - 1), F.lit(1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(toks, i, k), " "))
    return F.when(n > 0, grams)
