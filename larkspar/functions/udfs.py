"""User-defined functions: Arrow-batched scalar and table functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


@F.pandas_udf(StringType())
def dollars(amount: pd.Series) -> pd.Series:
    """An integer amount as text with a leading dollar sign."""
    return "$" + amount.astype("Int64").astype("string")


@F.udtf(returnType=StructType().add("word", StringType()))
class SpacedWords:
    """One row per word of a text, splitting like ``larkspar.functions.text.words``."""

    def eval(self, text: str | None):
        if text is None:
            return
        kept = text.rstrip(" ")
        if kept or not text:
            for word in kept.split(" "):
                yield (word,)
