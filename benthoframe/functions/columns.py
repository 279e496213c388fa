"""Small column helpers that carry the null rules of the survey data model.

A missing measurement is NULL; zero is a measured zero. NaN never survives a
source, and a condition that is itself unknown gives an unknown result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def if_known(condition: Column, then: Column, otherwise: Column | None = None) -> Column:
    """`then` / `otherwise`, or NULL when `condition` is NULL."""
    rest = F.lit(None) if otherwise is None else otherwise
    return F.when(condition, then).when(~condition, rest)


def any_missing(columns: Sequence[Column]) -> Column:
    """True when at least one column is NULL."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | column.isNull()
    return missing


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating point column."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(float("nan"))) for c in floating})


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equi-join condition in which a NULL key matches a NULL key."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def left_join_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], required: str, row_key: str = "EntryID"
) -> DataFrame:
    """Left join on `keys` with NULL matching NULL, keeping the left key columns.

    `required` is the text key that no row of the lookup lacks. Rows of the left side that lack it have no partner; they get
    keys of their own from `row_key`, so that they do not meet in one task when the lookup is too large to broadcast.
    """
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    mark = F.lit("\u0001")  # no text begins with it
    alone = F.concat(mark, left[row_key].cast("string")) if row_key in left.columns else mark
    condition = F.coalesce(left[required], alone) == renamed[f"__{required}"]
    for key in keys:
        if key != required:
            condition = condition & left[key].eqNullSafe(renamed[f"__{key}"])
    return left.join(renamed, condition, "left").drop(*[f"__{k}" for k in keys])


def end_method(df: DataFrame, name: str) -> DataFrame:
    """The same rows, at a place where Spark ends one generated method and begins the next.

    A stage of many joins and formulas otherwise becomes one method, and the JVM does not compile methods of more
    than 8,000 bytes. The rows are counted under `name` for query listeners. Filters are not pushed
    below this place; unused columns are pruned through it.
    """
    return df.observe(f"{name}-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def ensure_columns(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Add every field that `df` lacks as a typed NULL column (S3)."""
    present = set(df.columns)
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in present
    }
    return df.withColumns(missing) if missing else df
