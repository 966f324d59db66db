from .columns import as_numbers, is_missing, numeric_columns, text_columns
from .parsing import decimal_value, parse_decimal, parse_short_date, short_date

__all__ = [
    "as_numbers",
    "decimal_value",
    "is_missing",
    "numeric_columns",
    "parse_decimal",
    "parse_short_date",
    "short_date",
    "text_columns",
]
