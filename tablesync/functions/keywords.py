"""Case-insensitive keyword tests on column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ignore_case(text: Column, piece: Column) -> Column:
    return F.coalesce(F.contains(F.lower(text), F.lower(piece)), F.lit(False))


def keyword_array(keywords: str | list[str] | tuple[str, ...] | Column) -> Column:
    """Keywords as an array column; blanks around them and empty ones are dropped."""
    if isinstance(keywords, Column):
        words = F.split(keywords, ",")
    elif isinstance(keywords, str):
        words = F.split(F.lit(keywords), ",")
    else:
        words = F.array(*[F.lit(k) for k in keywords]) if keywords else F.expr("cast(array() as array<string>)")
    return F.filter(F.transform(words, lambda w: F.trim(w)), lambda w: w != "")


def has_keyword(text: Column, keywords) -> Column:
    return F.exists(keyword_array(keywords), lambda k: contains_ignore_case(text, k))


def matched_keywords(text: Column, keywords) -> Column:
    """The keywords found in ``text``, in list order, joined by ``/``."""
    return F.array_join(F.filter(keyword_array(keywords), lambda k: contains_ignore_case(text, k)), "/")
