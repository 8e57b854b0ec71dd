"""Publishing the star: narrowed types and a layout for serving."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T


def narrow(df, contract):
    """Cast to a published contract; a value that does not fit fails the job."""
    return df.select(*[_fitted(field).alias(field.name) for field in contract.fields])


def layout(df):
    """Rows of a region side by side, and in date order within each file.

    Range partitions split a region that is too large for one of them.
    """
    return df.repartitionByRange("state_code", "date_id").sortWithinPartitions(
        "date_id", "state_code"
    )


def _fitted(field):
    column = F.col(field.name)
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        size = field.dataType.length
        fits = column.isNull() | (F.length(column) <= size)
        value = F.when(fits, column.cast("string")).otherwise(
            F.raise_error(F.lit(f"{field.name} is longer than {size}"))
        )
    elif isinstance(field.dataType, T.IntegralType):
        value = column.try_cast(field.dataType)
        value = F.when(column.isNull() | value.isNotNull(), value).otherwise(
            F.raise_error(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}"))
        )
    else:
        value = column.cast(field.dataType)
    if field.nullable:
        return value
    return F.when(column.isNotNull(), value).otherwise(
        F.raise_error(F.lit(f"{field.name} is missing"))
    )
