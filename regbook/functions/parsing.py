"""Text to date and text to number. Bad input gives NULL under ANSI mode too."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SHORT_DATE = r"^\d{1,2}\.\d{1,2}\.(\d{2}|\d{4})$"
_DECIMAL = r"^[+-]?(\d+([.,]\d*)?|[.,]\d+)([eE][+-]?\d+)?$"


def short_date(text: Column, pivot: int = 45) -> Column:
    """``d.M.yy`` or ``d.M.yyyy`` as a date. Two-digit years above ``pivot`` are 19yy,
    the others 20yy. Trailing text and impossible dates give NULL."""
    text = F.trim(text)
    day, month, year = (F.split_part(text, F.lit("."), F.lit(i)) for i in (1, 2, 3))
    century = F.when(year > f"{pivot:02d}", "19").otherwise("20")
    full_year = F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year)
    return F.when(
        text.rlike(_SHORT_DATE),
        F.try_to_date(F.concat_ws(".", day, month, full_year), "d.M.yyyy"),
    )


def decimal_value(text: Column) -> Column:
    """A number with a decimal comma or point as double."""
    text = F.trim(text)
    return F.when(
        text.rlike(_DECIMAL), F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    )


def parse_short_date(df: DataFrame, column: str, pivot: int = 45) -> DataFrame:
    return df.withColumn(column, short_date(F.col(column), pivot))


def parse_decimal(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: decimal_value(F.col(c)) for c in columns})
