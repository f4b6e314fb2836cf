"""Text column expressions (JVM-side, codegen'd)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode-aware "not a word character and not whitespace" (Python's \w is
# Unicode; Java's is ASCII unless spelled out).
# A run of these and of whitespace becomes one space; a single space is such a run already and is not matched.
_GAP = r"[^\p{L}\p{N}_]{2,}|[^\p{L}\p{N}_ ]"
# Tokens of two or more word characters (Unicode).
TOKEN_PATTERN = r"(?U)\b\w\w+\b"


def clean_text(c) -> Column:
    """Lower-case, punctuation to space, collapse whitespace, trim."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.lower(c), _GAP, " "))


def char_len(c) -> Column:
    """Characters."""
    c = F.col(c) if isinstance(c, str) else c
    return F.char_length(c)


def word_count(c) -> Column:
    """Whitespace-split word count without empty pieces."""
    c = F.col(c) if isinstance(c, str) else c
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != F.lit("")))


def words(c) -> Column:
    """Lower-cased whitespace-split words, empties removed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != F.lit(""))


def tokens(c) -> Column:
    """Word tokens of length >= 2 from (already lower-cased) text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), 0)


def strip_accents(c) -> Column:
    """Unicode accent folding: NFKD decomposition, then drop combining marks.

    Spark SQL has no Unicode normaliser, so decomposition is a vectorised
    pandas UDF (Arrow batches); the mark removal stays a JVM regex.
    """
    c = F.col(c) if isinstance(c, str) else c
    plain = F.when(c.rlike(r"[^\x00-\x7f]"), c)   # ASCII text needs no decomposition and stays in the JVM
    return F.regexp_replace(F.coalesce(_nfd_udf(plain), c), r"\p{M}", "")


@F.pandas_udf(T.StringType())
def _nfd_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKD", x) if isinstance(x, str) else x)
