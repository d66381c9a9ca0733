"""Currency text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnLike, as_column

_STARTS = [*"0123456789.-"]


def currency(text: ColumnLike, strict: bool = False) -> Column:
    """``$1,234.50`` as 1234.5: one leading sign is dropped, commas are removed.

    Text without a sign is read as it stands. Text that is no number gives null,
    or raises in strict mode.
    """
    price = as_column(text)
    digits = F.when(F.left(price, F.lit(1)).isin(_STARTS), price).otherwise(
        F.substring(price, F.lit(2), F.length(price))
    )
    number = F.translate(digits, ",", "")
    return number.cast("double") if strict else number.try_cast("double")
