"""Field-name similarity measures for automatic mapping.

Everything but the sequence ratio is a built-in expression.  Python's
``difflib.SequenceMatcher.ratio`` has no JVM equivalent (Levenshtein gives
different numbers), so it runs as an Arrow-batched pandas UDF, applied only to
distinct candidate name pairs.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.text import norm_name


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_score(a, b) -> Column:
    return F.when(_col(a) == _col(b), F.lit(1.0)).otherwise(F.lit(0.0))


def substring_score(a, b) -> Column:
    """1 when one normalised name contains the other; 0 if either is empty."""
    x, y = _col(a), _col(b)
    nonempty = (F.length(x) > 0) & (F.length(y) > 0)
    return F.when(nonempty & (y.contains(x) | x.contains(y)), F.lit(1.0)).otherwise(F.lit(0.0))


def words(c) -> Column:
    return F.array_distinct(F.filter(F.split(_col(c), " "), lambda w: F.length(w) > 0))


def word_jaccard(a, b) -> Column:
    """Jaccard similarity of the word sets (0 when either set is empty)."""
    wa, wb = words(a), words(b)
    inter = F.size(F.array_intersect(wa, wb))
    union = F.size(F.array_union(wa, wb))
    return F.when((F.size(wa) > 0) & (F.size(wb) > 0), inter.cast("double") / union.cast("double")).otherwise(F.lit(0.0))


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib ratio of two normalised names (0 when either is empty)."""
    out = []
    for x, y in zip(a, b):
        if not x or not y:
            out.append(0.0)
        else:
            out.append(difflib.SequenceMatcher(None, x, y).ratio())
    return pd.Series(out, dtype="float64")


def collapse_blanks(c) -> Column:
    """Runs of whitespace become one blank (as the char n-gram analyser does)."""
    return F.regexp_replace(_col(c), r"\s\s+", " ")


def char_ngrams(c, lo: int = 2, hi: int = 3) -> Column:
    """Array of all character n-grams, lo <= n <= hi, of a string (with repeats)."""
    s = _col(c)

    def grams_of(n: int) -> Column:
        # one-argument lambda: Spark passes (element, index) to two-argument ones
        return F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substring(s, i, n))

    parts = [F.when(F.length(s) >= n, grams_of(n)).otherwise(F.array().cast("array<string>"))
             for n in range(lo, hi + 1)]
    return F.flatten(F.array(*parts))


__all__ = ["norm_name", "exact_score", "substring_score", "word_jaccard", "seq_ratio", "char_ngrams",
           "collapse_blanks", "words"]
