from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Union[Column, str]


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value
