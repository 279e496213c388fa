"""Combining columns of different reliability into one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_data_sources(
    df: DataFrame, order_of_preference: Sequence[str], new_column_name: str = "new"
) -> DataFrame:
    """Take the first known value of the columns, in order of preference.

    Adds the value and ``source_<name>``, the column it came from. A row in which
    no column is known carries the name of the last column.
    """
    unknown = [c for c in order_of_preference if c not in df.columns]
    if unknown or not order_of_preference:
        raise ValueError(f"These sources are not columns of the table: {', '.join(unknown) or 'none given'}.")
    source = F.lit(order_of_preference[-1])
    for name in reversed(order_of_preference[:-1]):
        source = F.when(F.col(name).isNotNull(), F.lit(name)).otherwise(source)
    return df.withColumns({
        new_column_name: F.coalesce(*[F.col(c) for c in order_of_preference]),
        f"source_{new_column_name}": source,
    })
