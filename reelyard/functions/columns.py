"""Column-expression helpers (all JVM-side built-ins, no Python on the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType


def empty_array(element_type: DataType) -> Column:
    """A typed, empty array literal (constant-folded by Catalyst)."""
    return F.array().cast(ArrayType(element_type))


def or_empty(column: str, element_type: DataType) -> Column:
    """The array itself, or a typed empty array when the array is null.

    The check is on the array, not on its elements: ``[1, null]`` stays as is.
    """
    return F.coalesce(F.col(column), empty_array(element_type))


def iso_day(column: Column) -> Column:
    """A date as an ISO ``yyyy-MM-dd`` string."""
    return F.date_format(column, "yyyy-MM-dd")
