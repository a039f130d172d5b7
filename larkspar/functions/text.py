"""Text helpers built from Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Split on single spaces, dropping the empty strings at the end but keeping inner ones.

    A text of spaces only has no words; an empty text has one empty word.
    """
    kept = F.rtrim(text)
    only_spaces = (kept == "") & (F.length(text) > 0)
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(F.split(kept, " "))


def numbers(text: Column, sep: str = " ") -> Column:
    """Parse separated numbers; a part that is no number becomes null."""
    return F.transform(F.split(text, sep), lambda part: part.try_cast("double"))
