from movrec.functions.formatting import as_text, format_movements, movement_text_columns
from movrec.functions.predicates import (
    all_truthy,
    column_or_null,
    is_blank,
    strip_leading_zeros,
    truthy,
)

__all__ = [
    "all_truthy",
    "as_text",
    "column_or_null",
    "format_movements",
    "is_blank",
    "movement_text_columns",
    "strip_leading_zeros",
    "truthy",
]
