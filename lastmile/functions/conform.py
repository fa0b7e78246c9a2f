"""Shape a DataFrame to a declared table schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in its order, cast to its types.

    Missing columns raise (a silent null column would hide a bug); extra columns are
    dropped. Casts run under the session's ANSI setting, so an overflow fails the job
    the way the warehouse would reject the insert. A frame that already has the
    schema's names and types in order is returned as is.
    """
    current = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in current]
    if missing:
        raise ValueError(f"Columns missing for the target schema: {missing}")
    if [(n, t) for n, t in current.items()] == [(f.name, f.dataType) for f in schema.fields]:
        return df
    return df.select(
        [
            F.col(f.name) if current[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double (for engine-neutral comparisons)."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
