"""One null model: absent, empty, 'nan' and NaN all become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for an absent value.
ABSENT_TEXT = ("", "nan", "NaN")


def clean_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.isin(*ABSENT_TEXT), c)


def clean_number(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def cast_clean(c: Column, to: T.DataType) -> Column:
    """Text to ``to``; absent or malformed values give NULL."""
    value = clean_text(c)
    if isinstance(to, T.StringType):
        return value
    if isinstance(to, (T.LongType, T.IntegerType)):
        # Columns with gaps are written as floats ("3.0").
        return value.try_cast("double").try_cast(to)
    if isinstance(to, (T.DoubleType, T.FloatType)):
        return clean_number(value.try_cast(to))
    return value.try_cast(to)


def normalise(df: DataFrame) -> DataFrame:
    """Apply the null model to every text and floating column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = clean_text(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = clean_number(c)
        out.append(c.alias(f.name))
    return df.select(*out)
